"""Secret scan: fixed patterns, and novelty measured with a dictionary-primed compressor.

Besides the patterns, every long token near a sensitive word is a candidate; where the word stands inside
the token (``ACCESS_KEY=...``), what follows it is one. It is compressed with zstandard, primed with common code identifiers and the text around it. Names, words and numbers
that occur nearby cost almost nothing then; a random string costs nearly its full entropy. Copies of
the candidate behind a sensitive word are left out of the text around it: repeating a key does not make
it known. A copy that no such word precedes still does. A
candidate whose marginal cost stays above ``min_bits`` per character is reported as ``novel``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import carried, carried_schema, narrow, through_arrow

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|api[_-]?key|private[_-]?key|access[_-]?key|credential|authorization|"
    r"bearer|session|signature|client[_-]?id|webhook",
    re.IGNORECASE | re.ASCII,
)
_SHORTEST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{_SHORTEST},}}")
_JOINT = re.compile(r"(?<!=)=+(?=[^=])")  # between a name and its value; padding at the end is none

# Names that fill source code and configuration, as the compressor's first dictionary.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "function return const static public private protected class import export default include define "
    "string integer boolean double float object array list dict map set value values key keys name names "
    "index length size count number result response request handler callback listener controller service "
    "repository factory manager builder provider client server session connection transaction database "
    "username user_name password passwd secret token access_token refresh_token api_key apikey private_key "
    "public_key client_id client_secret authorization bearer credential credentials signature certificate "
    "configuration settings properties environment variable parameter argument options application system "
    "getValue setValue toString fromString isEmpty hasNext forEach onClick addEventListener getElementById "
    "created_at updated_at deleted_at description message content timestamp identifier http https localhost "
    "example placeholder changeme your_token_here your-api-key xxxxxxxxxxxxxxxx 1234567890123456"
).encode()

# First letter and second letters of the 240 commonest pairs in English, German, French, Spanish and code.
_PAIRS = frozenset(
    group[0] + second
    for group in (
        "aabcdegilmnopqrstuv beloy caehiklot daeiostu eabcdefghilmnopqrstuvwxz faeior gaes habcehilnorstuvw iacdefgilmnopqrstv "
        "ja ke laefilostuy maeiop nabcdeghiklmnopqrstuvwz oabcdefilmnoprstu paeflort qu rabceghilmnorstuv sabcdeghijlmoqrstu "
        "tabcehilorstuyz uacefilmnoprstx vaeio wahi xaceot ypt zeu"
    ).split()
    for second in group[1:]
)


@dataclass(frozen=True)
class NoveltyRules:
    reach: int = 80  # characters between a sensitive word and a candidate, at most
    around: int = 600  # characters on both sides that prime the compressor
    min_bits: float = 5.0  # marginal bits per character
    level: int = 6


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, in code points."""
    spans = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def marginal_bits(candidate: bytes, surroundings: bytes, level: int) -> float:
    """Bits per byte that ``candidate`` adds once identifiers and surroundings are known."""
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + surroundings, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    options = zstandard.ZstdCompressionParameters.from_level(
        level, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    compressor = zstandard.ZstdCompressor(dict_data=primed, compression_params=options)
    return 8.0 * (len(compressor.compress(candidate)) - len(compressor.compress(b""))) / len(candidate)


def _parts(text: str, start: int, end: int, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The long parts of a candidate between the sensitive ``words`` and the ``=`` inside it."""
    at = start
    for low, high in [*words, (end, end)]:
        between = text[at:low]
        cuts = [0, *(cut for m in _JOINT.finditer(between) for cut in m.span()), len(between)]
        for first, last in zip(cuts[::2], cuts[1::2]):
            if first == 0 and at > start:
                first = last - len(between[:last].lstrip("=/_-"))
            if last - first >= _SHORTEST:
                yield at + first, at + last
        at = high


def _runs(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover together."""
    starts, ends = [], []
    for start, end, _ in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _around(text: str, start: int, end: int, hints: list[int], around: int) -> str:
    """``around`` characters on both sides, with blanks for the candidate's copies that follow a sensitive word.

    The candidate itself follows one, and so do all copies after it.
    """
    token, blank = text[start:end], " " * (end - start)
    after = text[end : end + around + len(token)].replace(token, blank)[:around]
    low = max(0, start - around - len(token))
    before, at = text[low:start], text.find(token, low, start)
    while at >= 0:
        place = bisect_right(hints, at)
        if place and at - hints[place - 1] <= around:
            before = before[: at - low] + blank + before[at - low + len(token) :]
        at = text.find(token, at + len(token), start)
    return before[max(0, len(before) - around) :] + after


def novel_spans(text: str, taken: list[tuple[int, int, str]], rules: NoveltyRules) -> list[tuple[int, int, str]]:
    """A candidate behind a sensitive word is measured whole, and in its parts unless it is novel as a whole.

    Where neither is novel, copies of tokens that were found elsewhere in the text are looked for inside it.
    """
    found, known, words = [], [], [m.span() for m in _SENSITIVE.finditer(text)]
    if not words:
        return found
    hints, (covers, covered) = [end for _, end in words], _runs(taken)

    def near(start: int) -> bool:
        place = bisect_right(hints, start)
        return place > 0 and start - hints[place - 1] <= rules.reach

    def novel(start: int, end: int) -> bool:
        token, place = text[start:end], bisect_right(covered, start)
        if not near(start) or (place < len(covers) and covers[place] < end) or not _mixed(token):
            return False
        return marginal_bits(token.encode(), _around(text, start, end, hints, rules.around).encode(), rules.level) >= rules.min_bits

    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        if start > hints[-1] + rules.reach:
            break
        if novel(start, end):
            found.append((start, end, "novel"))
            continue
        inside = words[bisect_right(hints, start) : bisect_right(hints, end)]
        if inside or near(start):
            parts = [part for part in _parts(text, start, end, inside) if part != (start, end) and novel(*part)]
            found += [(*part, "novel") for part in parts]
            known += [] if parts else [(start, end)]
    if found and known:
        tokens = sorted({re.escape(text[start:end]) for start, end, _ in found}, key=len, reverse=True)
        copies = re.compile("|".join(tokens))
        found += [(*m.span(), "novel") for span in known for m in copies.finditer(text, *span)]
    return found


def _mixed(token: str) -> bool:
    """Keys mix digits and letters, or are letters that make no words, in whatever language."""
    if any(c.isdigit() for c in token):
        return any(c.isalpha() for c in token)
    pairs = [a + b for a, b in zip(token, token[1:]) if a.isalpha() and b.isalpha()]
    common = sum(pair.lower() in _PAIRS for pair in pairs)
    changes = sum(a.islower() != b.islower() for a, b in pairs)
    return len(pairs) >= _SHORTEST // 2 and (10 * common < 7 * len(pairs) or 10 * changes > 4 * len(pairs))


def scan_text(text: str, rules: NoveltyRules = NoveltyRules()) -> list[tuple[int, int, str]]:
    """All spans of one text, by start and then in the order of ``KINDS``."""
    spans = base_spans(text)
    return sorted(spans + novel_spans(text, spans, rules), key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(
    docs: DataFrame, rules: NoveltyRules = NoveltyRules(), id: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """``doc_id``, ``spans`` (array of start, end, kind; code points) and ``redacted`` text, per row.

    Null text is scanned as empty and stays null in ``redacted``. Each row is scanned by itself:
    ids may be null or repeat, other columns are ignored, an empty table gives an empty table. With ``carry`` the
    input's other columns come along in ``carried``.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def each(columns):
        spans, redacted = [], []
        for value in columns["text"]:
            body = value.as_py()
            found = scan_text(body or "", rules)
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k in found])
            redacted.append(None if body is None else redact(body, found) if found else body)
        out = {"doc_id": columns["doc_id"], "spans": pa.array(spans, kind), "redacted": redacted}
        yield out | {name: columns[name] for name in extra}

    rows = narrow(docs, carry, doc_id=id, text=text)
    extra = carried(rows)
    schema = "doc_id long, spans array<struct<start: long, end: long, kind: string>>, redacted string"
    return through_arrow(rows, each, schema + carried_schema(rows))
