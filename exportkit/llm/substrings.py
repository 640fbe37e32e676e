"""Duplicate word windows, found level by level with doubled lengths.

Lengths run up a ladder that ends at the window's own, each twice the one before. At each length a
window is represented by one gram of that many words inside it (its anchor, see ``anchors``). Only
windows whose gram occurs in a second document are extended to the next length, until none
survive or the full length is reached. There, whole runs of windows that share an anchor are
compared by their context first, and single windows only where contexts differ.

Counts are pre-aggregated and joins leave skewed keys to adaptive execution, so a passage that a
third of all documents share is one row per task and length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Runs, merged, runs, stretches, within
from .common import narrow, rows_through_arrow, same, texts, through_arrow, written

BLOCK_WORDS = 1 << 17  # words of documents that are laid end to end
_TAG_BITS = 16
_FIRST_BITS = 36


@dataclass(frozen=True)
class WindowRules:
    window: int = 13  # words
    shortest: int = 6  # words of the first level

    def ladder(self) -> list[int]:
        """Lengths before the last one: 6 for 13 words; 6, 12 and 25 for 50."""
        lengths, n = [], self.window
        while n // 2 >= self.shortest:
            n //= 2
            lengths.append(n)
        return lengths[::-1] or [max(1, n // 2)]


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows with a short text tag, which tells rows apart that share an id."""
    rows = narrow(docs, doc_id=id, text=text)
    return rows.withColumn("tag", F.xxhash64("text").bitwiseAND(F.lit((1 << _TAG_BITS) - 1)))


def _place(tag: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Tag, first window and number of further windows in one number."""
    return (tag << (_FIRST_BITS + 11)) | (first << 11) | (last - first)


def _unpacked(rows: DataFrame) -> DataFrame:
    place = F.col("place")
    return rows.select(
        "*",
        F.shiftright(place, _FIRST_BITS + 11).alias("tag"),
        F.shiftright(place, 11).bitwiseAND(F.lit((1 << _FIRST_BITS) - 1)).alias("first"),
        place.bitwiseAND(F.lit((1 << 11) - 1)).alias("more"),
    )


def _clipped(found: Runs, alive: list[tuple[int, int]] | None) -> Runs:
    """The parts of runs that lie inside the windows still alive."""
    if alive is None:
        return found
    keys, anchors, first, last = [], [], [], []
    at = 0
    for key, anchor, a, b in zip(*(x.tolist() for x in (found.key, found.anchor, found.first, found.last))):
        while at < len(alive) and alive[at][1] <= a:
            at += 1
        place = at
        while place < len(alive) and alive[place][0] <= b:
            keys.append(key)
            anchors.append(anchor)
            first.append(max(a, alive[place][0]))
            last.append(min(b, alive[place][1] - 1))
            place += 1
    whole = lambda x: np.array(x, np.int64)
    return Runs(np.array(keys, np.uint64), whole(anchors), whole(first), whole(last))


def entries(docs: DataFrame, rules: WindowRules, gram: int) -> DataFrame:
    """Runs of windows of all documents with an id; with a column ``alive``, only of those windows."""
    limited = "alive" in docs.columns

    def block(held):
        """Entries of some documents laid end to end."""
        sizes = np.array([len(codes) for _, _, codes, _ in held])
        codes, begin = np.concatenate([codes for _, _, codes, _ in held]), np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(held)), sizes)
        found = within(runs(codes, rules.window, gram), owner, rules.window)
        if limited:
            shifted = [(a + at, b + at) for at, (*_, spans) in zip(begin.tolist(), held) for a, b in spans]
            found = _clipped(found, shifted)
        of = owner[found.first]
        tags, ids = (np.array([row[i] for row in held], np.int64)[of] for i in (1, 0))
        context = stretches(codes, found.first, found.last + rules.window)
        place = _place(tags, found.first - begin[of], found.last - begin[of])
        return {"key": found.key.view(np.int64), "context": context.view(np.int64), "doc_id": ids, "place": place}

    def each(columns):
        held, size = [], 0
        alive = columns["alive"] if limited else columns["doc_id"]
        for doc_id, tag, body, spans in zip(columns["doc_id"], columns["tag"], texts(columns["text"]), alive):
            words = body.split()
            if len(words) < rules.window or doc_id.as_py() is None:
                continue
            kept = merged([(s["start"], s["end"]) for s in spans.as_py()]) if limited else None
            held.append((doc_id.as_py(), tag.as_py(), _codes(words), kept))
            size += len(words)
            if size >= BLOCK_WORDS:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    return through_arrow(docs, each, "key long, context long, doc_id long, place long")


def _survivors(rows: DataFrame, label: str) -> DataFrame:
    """Entries whose gram occurs in a second document."""
    seen = rows.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    seen = written(seen.where("low <> high").select("key"), f"{label}-keys")
    return written(rows.join(seen, "key", "left_semi"), label)


def _with_owner(docs: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    owner = found.withColumnsRenamed({"doc_id": "_doc_id", "tag": "_tag"})
    joined = docs.join(owner, same(docs["doc_id"], owner["_doc_id"]) & (docs["tag"] == owner["_tag"]), how)
    return joined.drop("_doc_id", "_tag")


def windows_of(spread: DataFrame, window: int) -> DataFrame:
    """Every window of the given runs, hashed, with its place inside its context."""

    def each(columns):
        for doc_id, body, places in zip(columns["doc_id"], texts(columns["text"]), columns["places"]):
            data, owner = _codes(body.split()).tobytes(), doc_id.as_py()
            for place in places.as_py():
                for step in range(place["more"] + 1):
                    at = 8 * (place["first"] + step)
                    value = xxhash.xxh3_64_intdigest(data[at : at + 8 * window])
                    yield place["key"], place["context"], step, value - (1 << 64) if value >> 63 else value, owner

    return rows_through_arrow(spread, each, "key long, context long, step long, window long, doc_id long")


def repeated_spans(docs: DataFrame, rules: WindowRules) -> DataFrame:
    """Spans ``(doc_id, tag, start, end)`` of words: windows that also start in an earlier document."""
    ladder = rules.ladder()
    shared = _survivors(entries(docs, rules, ladder[0]), f"windows-{ladder[0]}")
    for gram in ladder[1:]:
        alive = _unpacked(shared).groupBy("doc_id", "tag")
        span = F.struct(F.col("first").alias("start"), (F.col("first") + F.col("more") + 1).alias("end"))
        limited = _with_owner(docs, alive.agg(F.collect_set(span).alias("alive")))
        shared = _survivors(entries(limited, rules, gram), f"windows-{gram}")

    first = F.min(F.struct("doc_id", "place")).alias("at")
    contexts = written(shared.groupBy("key", "context").agg(first).select("key", "context", "at.*"), "windows-contexts")
    later = shared.alias("s").join(contexts.alias("c"), ["key", "context"])
    later = _unpacked(later.where("s.doc_id > c.doc_id").select("s.doc_id", "s.place"))
    later = later.select("doc_id", "tag", F.col("first").alias("start"), (F.col("first") + F.col("more")).alias("last"))

    several = contexts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    borders = _unpacked(contexts.join(several, "key", "left_semi"))
    places = F.collect_list(F.struct("key", "context", "first", "more")).alias("places")
    spread = _with_owner(docs, borders.groupBy("doc_id", "tag").agg(places))
    windows = written(windows_of(spread, rules.window), "windows-borders")
    earliest = windows.groupBy("key", "window").agg(F.min("doc_id").alias("earliest"))
    earliest = written(earliest, "windows-earliest")
    known = windows.join(earliest, ["key", "window"]).where("doc_id > earliest")
    known = known.select("key", "context", "step", F.col("doc_id").alias("owner")).distinct()
    again = _unpacked(known.join(shared, ["key", "context"]).where("doc_id = owner"))
    start = F.col("first") + F.col("step")
    again = again.select("doc_id", "tag", start.alias("start"), start.alias("last"))
    return later.unionByName(again).select("doc_id", "tag", "start", (F.col("last") + rules.window).alias("end"))


def deduplicate(
    docs: DataFrame, rules: WindowRules = WindowRules(), id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_words``, ``removed`` (maximal spans of words) and ``kept`` text, per row.

    A word goes when a window that covers it also starts in a document with a smaller id. Null and
    blank texts have no words. Rows that share an id are one document to each other and take
    nothing from one another; rows without an id neither lose words nor cause losses. Repeated rows
    give a row each, other columns are ignored, an empty table gives an empty table.
    """
    keyed = _keyed(docs, id, text)
    spans = repeated_spans(keyed, rules).groupBy("doc_id", "tag")
    spans = written(spans.agg(F.collect_set(F.struct("start", "end")).alias("spans")), "windows-spans")
    joined = _with_owner(keyed, spans, "left")

    def each(columns):
        for doc_id, body, spans in zip(columns["doc_id"], texts(columns["text"]), columns["spans"]):
            words, kept, at = body.split(), [], 0
            removed = merged([(s["start"], s["end"]) for s in spans.as_py() or ()])
            for start, end in removed:
                kept += words[at:start]
                at = end
            kept += words[at:]
            yield doc_id.as_py(), len(words), [{"start": s, "end": e} for s, e in removed], b" ".join(kept)

    return rows_through_arrow(
        joined, each, "doc_id long, n_words long, removed array<struct<start: long, end: long>>, kept binary"
    )
