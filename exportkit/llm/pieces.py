"""SentencePiece BPE encoding with seeded merge-dropout, and its lossless decoding.

A unit (white space and the word behind it) starts as single characters. The agenda holds every
pair of neighbours whose join is a piece; the best score goes first, the leftmost of equal ones.
With dropout a candidate merge is skipped when a keyed hash of the seed, the document and the
candidate's three borders falls below the rate. The decision belongs to the candidate, not to the
order of events, so the same seed gives the same pieces on every machine and retry, and another
seed, document or place gives others.

The agendas of all units of a batch advance together: in each round every unit performs its best
merge, as array operations. Very long units keep a heap of their own instead.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from .common import narrow, rows_through_arrow

SPACE = "▁"
LONG_UNIT = 256  # characters; longer units use the heap
BLOCK_CHARS = 1 << 17
BLOCK_IDS = 1 << 16
_UNIT = re.compile(r"(?<! ) ")  # a unit begins here
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class PieceRules:
    model: str = ""  # model file; empty: the 32k BPE of the public tokenizers package
    dropout: float = 0.1
    seed: int = 1


def _mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * _M2
    value = (value ^ (value >> np.uint64(27))) * _M3
    return value ^ (value >> np.uint64(31))


class Vocabulary:
    """Pieces of a model as tables: characters to ids, pairs of ids to the id of their join."""

    def __init__(self, model: str) -> None:
        import public_tokenizers

        processor = sentencepiece.SentencePieceProcessor(model_file=model or public_tokenizers.path("piece_bpe_32k.model"))
        n = processor.get_piece_size()
        self.size = n
        plain = [
            i for i in range(n)
            if not (processor.is_unknown(i) or processor.is_control(i) or processor.is_byte(i) or processor.is_unused(i))
        ]
        self.piece = {i: processor.id_to_piece(i) for i in plain}
        ids = {text: i for i, text in self.piece.items()}
        scores = np.full(n, -np.inf)
        scores[plain] = [processor.get_score(i) for i in plain]
        # Rank of a merge: better scores first.
        self.rank = np.empty(n, np.int64)
        self.rank[np.argsort(-scores, kind="stable")] = np.arange(n)
        ordered = np.sort(-scores)
        self.rank = np.searchsorted(ordered, -scores)
        self.byte_id = {processor.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        self.of_byte = {b: i for i, b in self.byte_id.items()}
        self.char_id = np.full(0x110000, -1, np.int32)
        for text, i in ids.items():
            if len(text) == 1 and text != SPACE:
                self.char_id[ord(text)] = i
        self.space = ids[SPACE]
        spelled = [b""] * n
        for i, text in self.piece.items():
            spelled[i] = text.replace(SPACE, " ").encode()
        for i, byte in self.byte_id.items():
            spelled[i] = bytes([byte])
        self.byte_lengths = np.array([len(x) for x in spelled])
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        left, right, joined = [], [], []
        for text, i in ids.items():
            for cut in range(1, len(text)):
                if text[:cut] in ids and text[cut:] in ids:
                    left.append(ids[text[:cut]])
                    right.append(ids[text[cut:]])
                    joined.append(i)
        self.pairs = dict(zip(zip(left, right), joined))
        self._table(np.array(left, np.int64), np.array(right, np.int64), np.array(joined, np.int32))

    def _table(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> None:
        """An open hash table of all pairs, filled and probed with array operations."""
        bits = max(10, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        keys = left * self.size + right
        place, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.slots[place[todo]] < 0
            claim = todo[free]
            _, first = np.unique(place[claim], return_index=True)
            winners = claim[first]
            self.slots[place[winners]], self.values[place[winners]] = keys[winners], joined[winners]
            todo = np.setdiff1d(todo, winners, assume_unique=True)
            place[todo] = (place[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _M1) >> self.shift).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each pair's join, -1 where there is none."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo].astype(np.int64) * self.size + right[todo]
        place = self._slot(keys)
        while len(todo):
            there = self.slots[place]
            hit = there == keys
            out[todo[hit]] = self.values[place[hit]]
            going = ~hit & (there >= 0)
            todo, keys, place = todo[going], keys[going], (place[going] + 1) & self.mask
        return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    if model not in _vocabularies:
        _vocabularies[model] = Vocabulary(model)
    return _vocabularies[model]


def _parts(text: str, size: int | None = None) -> Iterator[tuple[str, int]]:
    """A text, with the space it is given in front, in parts that begin where units begin, and where each
    begins. Merges never cross such a border, so the parts have the ids that the whole has."""
    if not text:
        return
    whole, at, size = " " + text, 0, size or BLOCK_CHARS
    while len(whole) - at > size:
        cut = _UNIT.search(whole, at + size)
        if cut is None:
            break
        yield whole[at : cut.start()], at
        at = cut.start()
    yield whole[at:], at


class Encoder:
    def __init__(self, rules: PieceRules) -> None:
        self.rules, self.words = rules, vocabulary(rules.model)
        self.limit = np.uint64(min(max(rules.dropout, 0.0), 1.0) * float(1 << 63))

    def _document_key(self, doc_id: int | None) -> np.ndarray:
        key = np.array([(0 if doc_id is None else doc_id + 1) & ((1 << 64) - 1)], np.uint64)
        return _mix(key * _M1 + np.uint64(self.rules.seed & ((1 << 64) - 1)))[0]

    def _dropped(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Keyed decision about candidates given by their borders, counted from the document's start."""
        value = _mix(key + start.astype(np.uint64) * _M1)
        value = _mix(value + middle.astype(np.uint64) * _M2 + end.astype(np.uint64) * _M3)
        return (value >> np.uint64(1)) < self.limit

    def encode(self, documents: list[tuple[int | None, str]]) -> list[np.ndarray]:
        """Ids of each document; an empty text has none. Long texts are encoded part by part."""
        parts = ((n, doc_id, *part) for n, (doc_id, text) in enumerate(documents) for part in _parts(text))
        found: list[list[np.ndarray]] = [[] for _ in documents]
        block: list[tuple[int, int | None, str, int]] = []
        chars = 0
        for part in parts:
            if block and chars + len(part[2]) > BLOCK_CHARS:
                self._block(block, found)
                block, chars = [], 0
            block.append(part)
            chars += len(part[2])
        if block:
            self._block(block, found)
        return [ids[0] if len(ids) == 1 else np.concatenate([np.zeros(0, np.int32), *ids]) for ids in found]

    def _block(self, parts: list[tuple[int, int | None, str, int]], found: list[list[np.ndarray]]) -> None:
        """Encode parts ``(document, its id, characters, offset in it)`` together, and hand the ids out."""
        sizes = np.array([len(part[2]) for part in parts])
        points = np.frombuffer("".join(part[2] for part in parts).encode("utf-32-le", "surrogatepass"), "<u4")
        n = len(points)
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        owner = np.repeat(np.arange(len(parts)), sizes)
        keys = np.array([self._document_key(part[1]) for part in parts], np.uint64)[owner]
        offset = np.arange(n) + (np.array([part[3] for part in parts]) - begin)[owner]
        space = points == 32
        ids = np.where(space, self.words.space, self.words.char_id[points]).astype(np.int32)
        head = np.ones(n, bool)  # a unit begins with a space behind a non-space, or with the part
        head[1:] = (space[1:] & ~space[:-1]) | (owner[1:] != owner[:-1])
        unit = np.cumsum(head) - 1
        lengths = np.bincount(unit)
        symbols, starts = self._rounds(ids, unit, lengths, offset, keys)
        bounds = np.searchsorted(starts, np.concatenate((begin, [n])))
        for i, part in enumerate(parts):
            own, places = symbols[bounds[i] : bounds[i + 1]], starts[bounds[i] : bounds[i + 1]]
            found[part[0]].append(self._with_bytes(own, places, points))

    def _with_bytes(self, symbols: np.ndarray, places: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Characters without a piece become their UTF-8 bytes."""
        unknown = np.flatnonzero(symbols < 0)
        if not len(unknown):
            return symbols
        of_byte, parts, at = self.words.of_byte, [], 0
        for i in unknown:
            parts += [symbols[at:i], [of_byte[b] for b in chr(points[places[i]]).encode("utf-8", "surrogatepass")]]
            at = i + 1
        return np.concatenate([*parts, symbols[at:]]).astype(np.int32)

    def _rounds(self, ids, unit, lengths, offset, keys) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are left and the character each begins at."""
        n = len(ids)
        follow, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        end = offset + 1
        live = np.ones(n, bool)
        last = np.ones(n, bool)
        last[:-1] = unit[1:] != unit[:-1]
        follow[last] = n
        first = np.ones(n, bool)
        first[1:] = last[:-1]
        before[first] = -1
        joined = np.full(n, -1, np.int32)
        no_rank = np.int64(1) << 40
        score = np.full(n, no_rank)  # rank of the merge of a symbol with its successor

        def look(left: np.ndarray) -> None:
            right = follow[left]
            found = self.words.join(ids[left], ids[right])
            there = found >= 0
            if self.limit and there.any():
                at, to = left[there], right[there]
                skip = self._dropped(keys[at], offset[at], offset[to], end[to])
                found[np.flatnonzero(there)[skip]] = -1
            joined[left] = found
            score[left] = np.where(found >= 0, self.words.rank[found], no_rank)

        short = lengths <= LONG_UNIT
        look(np.flatnonzero(~last & short[unit]))
        # Candidates only, in text order; units stay contiguous.
        candidates, touched = np.flatnonzero(score < no_rank), np.zeros(n, bool)
        while len(candidates):
            owner = unit[candidates]
            edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(score[candidates], edge)
            counts = np.diff(np.concatenate((edge, [len(candidates)])))
            is_best = score[candidates] == np.repeat(best, counts)
            hits = np.flatnonzero(is_best)
            _, chosen = np.unique(owner[hits], return_index=True)
            left = candidates[hits[chosen]]
            right = follow[left]
            ids[left], end[left] = joined[left], end[right]
            live[right] = False
            beyond = follow[right]
            follow[left] = beyond
            inner = beyond < n
            before[beyond[inner]] = left[inner]
            score[right] = no_rank
            joined[left], score[left] = -1, no_rank
            look(left[inner])
            previous = before[left]
            look(previous[previous >= 0])
            touched[candidates] = touched[left[inner]] = touched[previous[previous >= 0]] = True
            # While many units are busy a pass over the block is cheaper than sorting places.
            if len(candidates) * 8 > n:
                places = np.flatnonzero(touched)
            else:
                places = np.unique(np.concatenate((candidates, left[inner], previous[previous >= 0])))
            touched[places] = False
            candidates = places[score[places] < no_rank]
        for u in np.flatnonzero(~short):
            self._heap(u, unit, ids, offset, end, keys, live)
        rest = np.flatnonzero(live)
        return ids[rest], rest

    def _heap(self, u, unit, ids, offset, end, keys, live) -> None:
        """The agenda of one long unit, in place."""
        a, b = np.searchsorted(unit, [u, u + 1])
        symbols = ids[a:b].tolist()
        n, pairs, rank = b - a, self.words.pairs, self.words.rank
        follow, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), (end[a:b]).tolist()
        starts, alive, version = offset[a:b].tolist(), [True] * n, [0] * n
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            found = []
            for left in lefts:
                right = follow[left]
                joined = pairs.get((symbols[left], symbols[right])) if right < n else None
                if joined is not None:
                    found.append((left, right, joined))
            if not found:
                return
            at = lambda values: np.array(values)
            skip = self._dropped(
                keys[a : a + 1], at([starts[x] for x, _, _ in found]), at([starts[y] for _, y, _ in found]), at([stop[y] for _, y, _ in found])
            )
            for (left, right, joined), gone in zip(found, skip):
                if not gone:
                    heapq.heappush(agenda, (int(rank[joined]), left, right, version[left], version[right], joined))

        offer(list(range(n - 1)))
        while agenda:
            _, left, right, mine, other, joined = heapq.heappop(agenda)
            if not (alive[left] and alive[right]) or version[left] != mine or version[right] != other:
                continue
            symbols[left], stop[left] = joined, stop[right]
            version[left] += 1
            alive[right] = False
            follow[left] = follow[right]
            if follow[left] < n:
                before[follow[left]] = left
            offer([x for x in (before[left], left) if x >= 0])
        ids[a:b], live[a:b] = symbols, alive

    def decode(self, ids: np.ndarray) -> str:
        """The text that was encoded."""
        words, parts = self.words, []
        for at in range(0, len(ids), BLOCK_IDS):
            part = ids[at : at + BLOCK_IDS]
            lengths = words.byte_lengths[part]
            behind = np.cumsum(lengths)
            inside = np.arange(int(behind[-1])) - np.repeat(behind - lengths, lengths)
            parts.append(words.bytes[np.repeat(words.byte_starts[part], lengths) + inside].tobytes())
        return b"".join(parts).decode("utf-8", "surrogatepass")[1:]


def encode(docs: DataFrame, rules: PieceRules = PieceRules(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (32-bit, little endian) and ``n_chars`` for every row.

    Null text has null ids, empty text none. Without dropout the ids are those of the library, but
    for the character U+2581, which is encoded as bytes here so that it survives decoding. A null id
    counts as a document of its own; rows with equal id and text get equal pieces; other columns
    are ignored; an empty table gives an empty table.
    """

    def each(columns):
        encoder = Encoder(rules)
        documents = [(i.as_py(), t.as_py()) for i, t in zip(columns["doc_id"], columns["text"])]
        for at in range(0, len(documents), 256):
            part = documents[at : at + 256]
            for (doc_id, body), ids in zip(part, encoder.encode([(i, t or "") for i, t in part])):
                yield doc_id, None if body is None else ids.astype("<i4").tobytes(), None if body is None else len(body)

    return rows_through_arrow(narrow(docs, doc_id=id, text=text), each, "doc_id long, ids binary, n_chars long")


def decode(encoded: DataFrame, rules: PieceRules = PieceRules()) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` they stand for."""

    def each(columns):
        encoder = Encoder(rules)
        for doc_id, ids in zip(columns["doc_id"], columns["ids"]):
            raw = ids.as_py()
            yield doc_id.as_py(), raw, None if raw is None else encoder.decode(np.frombuffer(raw, "<i4"))

    return rows_through_arrow(encoded.select("doc_id", "ids"), each, "doc_id long, ids binary, text string")
