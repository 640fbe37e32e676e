"""Hierarchical multi-length packing into sequences of at most ``context`` tokens.

Each task tokenizes the documents of its own input split and packs them there; nothing is
shuffled. Documents are routed by length: whole windows of the longest tier are cut off first, the
rest goes to the smallest tier that holds it. Every tier packs its rests into windows of its own
size (best fit by first descending length), long windows that still have a gap take pieces of the shorter tiers, and a
piece that is too long for a gap is cut to fit. What stays open at the end of a task is padded.
Finished windows are dealt to training steps so that the steps of a task hold equally many tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import narrow, through_arrow

END_TOKEN = 1
SPECIAL = "<|endoftext|>"
POOL = 4096  # rests a task holds before it packs them

# The white space of the vocabulary's pattern, and runs that tiktoken's regex engine is not given
# (it gives up beyond a million characters).
LONG_RUN = 1 << 16
_SPACE = r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_RUN = re.compile(rf"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}")


@dataclass(frozen=True)
class PackRules:
    context: int = 2048
    tiers: tuple[int, ...] = (256, 512, 1024, 2048)
    step_tokens: int = 65536
    vocabulary: str = ""  # ranks file of a byte-level BPE; empty: that of the public tokenizers package
    pattern: str = ""


_encoders: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoder(rules: PackRules) -> tiktoken.Encoding:
    """The vocabulary of ``byte_bpe_50k.json``, read as ranks: same ids, four times as fast."""
    import public_tokenizers

    path = rules.vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = rules.pattern or public_tokenizers.PATTERN
    if (path, pattern) not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        special = {SPECIAL: len(ranks)}
        _encoders[path, pattern] = tiktoken.Encoding(
            "byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )
    return _encoders[path, pattern]


def _ordinary(text: str, coder: tiktoken.Encoding) -> Iterator[list[int]]:
    """Ids of a text without special tokens; long white-space runs are cut out of it.

    The patterns take a run that ends the text whole, and leave the last character of any other run to what
    follows. What is taken is one piece for the vocabulary's merges.
    """
    at = 0
    for run in _LONG_RUN.finditer(text) if len(text) >= LONG_RUN else ():
        start, end = run.span()
        end -= end < len(text)
        yield coder.encode_ordinary(text[at:start])
        yield coder._core_bpe.encode_single_piece(text[start:end].encode())
        at = end
    yield coder.encode_ordinary(text[at:])


def token_ids(text: str, coder: tiktoken.Encoding) -> np.ndarray:
    """Ids of the text and the closing id, as little-endian unsigned 32-bit integers."""
    ids = []
    for place, part in enumerate(text.split(SPECIAL)):
        if place:
            ids.append(coder.encode_single_token(SPECIAL))
        for found in _ordinary(part, coder):
            ids += found
    ids.append(END_TOKEN)
    return np.array(ids, "<u4")


class _Packer:
    """Packs pieces ``(length, start, row)``; rows are kept by number, their ids in ``tokens``."""

    def __init__(self, rules: PackRules, first: int) -> None:
        self.rules, self.next, self.step = rules, first, first
        self.rests: list[tuple[int, int, int]] = []
        self.rows: dict[int, tuple[object, np.ndarray]] = {}
        self.windows: list[list[tuple[int, int, int]]] = []
        self.count = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        row, self.count = self.count, self.count + 1
        self.rows[row] = (doc_id, ids)
        whole = len(ids) // self.rules.context * self.rules.context
        for start in range(0, whole, self.rules.context):
            self.windows.append([(self.rules.context, start, row)])
        if whole < len(ids):
            self.rests.append((len(ids) - whole, whole, row))

    def pack(self, last: bool) -> None:
        """Turn the rests into windows; unless it is the last call, open ones wait for more."""
        tiers, pools = self.rules.tiers, {tier: [] for tier in self.rules.tiers}
        for piece in sorted(self.rests):
            pools[next(t for t in tiers if piece[0] <= t)].append(piece)
        self.rests = []
        open_windows = []
        for place in reversed(range(len(tiers))):
            shorter = [pools[t] for t in reversed(tiers[:place])]
            while pools[tiers[place]]:
                window, gap = self._fill(tiers[place], pools[tiers[place]], shorter)
                if gap:
                    open_windows.append((tiers[place], window))
                else:
                    self.windows.append(window)
        for tier, window in open_windows:
            used = sum(length for length, _, _ in window)
            if not last:
                self.rests += window
            elif used == self.rules.context or used & (used - 1) == 0:
                self.windows.append(window)
            else:
                self.rests += window
        if last:
            self._close()

    def _fill(self, size: int, own: list, shorter: list[list]) -> tuple[list, int]:
        """One window: its longest piece, then best fits of its tier, then of shorter tiers, then a cut."""
        window = [own.pop()]
        gap = size - window[0][0]
        for pool in [own, *shorter]:
            while gap and pool:
                at = bisect_left(pool, (gap + 1,)) - 1
                if at < 0:
                    break
                window.append(pool.pop(at))
                gap -= window[-1][0]
        for pool in [own, *shorter] if gap else []:
            if pool:  # every piece left is longer than the gap: cut the shortest
                length, start, row = pool.pop(0)
                window.append((gap, start, row))
                insort(pool, (length - gap, start + gap, row))
                return window, 0
        return window, gap

    def _close(self) -> None:
        """The very last pieces of the task: full windows in a row, one padded one at the end."""
        window, gap = [], self.rules.context
        for length, start, row in self.rests:
            while length:
                take = min(length, gap)
                window.append((take, start, row))
                length, start, gap = length - take, start + take, gap - take
                if not gap:
                    self.windows.append(window)
                    window, gap = [], self.rules.context
        if window:
            self.windows.append(window)
        self.rests = []

    def out(self) -> dict:
        """Rows of the finished windows, dealt to steps longest first to the lightest step."""
        sizes = [sum(p[0] for p in w) for w in self.windows]
        steps = max(1, -(-sum(sizes) // self.rules.step_tokens))
        order, step_of = sorted(range(len(sizes)), key=lambda i: -sizes[i]), {}
        for place, i in enumerate(order):  # back and forth, so that sums stay level
            turn, at = divmod(place, steps)
            step_of[i] = self.step + (at if turn % 2 == 0 else steps - 1 - at)
        columns = {name: [] for name in COLUMNS}
        for i, window in enumerate(self.windows):
            offset = 0
            for length, start, row in window:
                doc_id, ids = self.rows[row]
                piece = ids[start : start + length]
                values = (
                    doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids), self.next + i, offset, step_of[i], piece.tobytes(),
                )
                for name, value in zip(COLUMNS, values):
                    columns[name].append(value)
                offset += length
        self.next, self.step = self.next + len(self.windows), self.step + steps
        self.windows = []
        held = {row for _, _, row in self.rests}
        self.rows = {row: value for row, value in self.rows.items() if row in held}
        return columns


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "step_id", "ids")
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "step_id long, ids binary"
)


def pack(docs: DataFrame, rules: PackRules = PackRules(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: where it comes from, where it goes, and its ids (32-bit, little endian).

    Null and empty texts are the closing id alone. A null id is carried along; equal rows are
    packed once each; other columns are ignored; an empty table gives an empty table. Sequence and
    step numbers start at the task's number times 2**32, so that they never meet; a repeated task
    packs the same input in the same order and gives the same numbers.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches):
        import pyarrow as pa

        def batch(columns):
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

        packer, coder = _Packer(rules, TaskContext.get().partitionId() << 32), encoder(rules)
        for rows in batches:
            for doc_id, body in zip(rows.column(0), rows.column(1)):
                packer.add(doc_id.as_py(), token_ids(body.as_py() or "", coder))
                if len(packer.rests) >= POOL:
                    packer.pack(last=False)
                if len(packer.windows) >= POOL:
                    yield batch(packer.out())
        packer.pack(last=True)
        if packer.windows:
            yield batch(packer.out())

    return narrow(docs, doc_id=id, text=text).mapInArrow(run, SCHEMA)
