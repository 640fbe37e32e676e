"""Duplicate byte strings, found with a logarithmic family of suffix arrays.

Suffixes are sampled at anchors (see ``anchors``): every string of ``length`` bytes holds one, and
equal strings hold it at the same place. Documents arrive in batches. The sampled suffixes of a
batch are sorted into its array, equal beginnings merged to one row with a count; the array is
merge-scanned against each level of the index for beginnings that occur there too; then levels of
equal rank merge geometrically, like the digits of a counter. Arrays are kept on the executors' disks,
dealt by the fingerprint of a suffix's first ``gram`` bytes and sorted by it, so scans run side by
side without a shuffle; a merge deals its rows once.

Only suffixes whose beginning occurs more than once go on. Their full contexts (all bytes of the
windows an anchor stands for) are compared: a context that occurs again is repeated throughout.
What remains are the borders of repeated passages, and there every window is looked up by itself:
the contexts of one key in one task, or, where a key has very many, every window as a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import merged, runs
from .common import carried, carried_schema, drop_written, fewer_tasks, narrow, rows_through_arrow, same, texts, through_arrow, written

_CODES = np.random.default_rng(0).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


ENTRIES_A_TASK = 1 << 16  # about 5 MB of text
TASK_CONTEXTS = 8192  # contexts compared at once
HOT_CONTEXTS = 20_000  # keys with more contexts are compared row by row


@dataclass(frozen=True)
class SuffixRules:
    length: int = 200  # bytes a repeated string has at least
    gram: int = 32  # bytes of a suffix's beginning that are indexed
    batches: int = 4


def _xx(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def _keyed(docs: DataFrame, id: str, text: str, carry: bool) -> DataFrame:
    """Rows with a text tag: together with the id it tells rows apart that share an id."""
    rows = narrow(docs, carry, doc_id=id, text=text)
    return rows.withColumn("tag", F.xxhash64("text"))


def entries(docs: DataFrame, rules: SuffixRules) -> DataFrame:
    """One row per sampled suffix: where its windows start, its beginning and its context, hashed."""

    def each(columns):
        out = {"key": [], "context": [], "doc_id": [], "tag": [], "first": [], "last": []}
        size = 0
        for doc_id, tag, body in zip(columns["doc_id"], columns["tag"], texts(columns["text"])):
            if len(body) < rules.length:
                continue
            found = runs(_CODES[np.frombuffer(body, np.uint8)], rules.length, rules.gram)
            n = len(found.key)
            spans = zip(found.first.tolist(), (found.last + rules.length).tolist())
            out["key"].append(found.key.view(np.int64))
            out["context"].append(np.fromiter((_xx(body[a:b]) for a, b in spans), np.int64, n))
            out["doc_id"] += [doc_id.as_py()] * n
            out["tag"] += [tag.as_py()] * n
            out["first"].append(found.first)
            out["last"].append(found.last)
            size += n
            if size >= 1 << 18:
                yield _flat(out)
                out, size = {name: [] for name in out}, 0
        if size:
            yield _flat(out)

    rows = through_arrow(docs, each, "key long, context long, doc_id long, tag long, first long, last long")
    batch = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(rules.batches)).cast("int")
    return rows.withColumn("batch", batch)


def _flat(out: dict) -> dict:
    return {
        name: np.concatenate(values) if isinstance(values[0], np.ndarray) else values for name, values in out.items()
    }


class IndexFamily:
    """Suffix arrays of geometrically growing size; ``add`` takes a batch and returns its matches.

    Matches are read from the arrays: use them before ``close``. An array is computed when it is first scanned,
    so what the last batch merges to never is; one that is lost with its executor is computed again.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label = spark, label
        self.levels: list[tuple[int, DataFrame]] = []  # (rank, array), highest rank first
        self.arrays: list[DataFrame] = []
        self.ready: set[int] = set()

    def _array(self, rows: DataFrame, count: str) -> DataFrame:
        counted = rows.groupBy("key").agg(F.expr(count).alias("n"))
        self.arrays.append(counted.sortWithinPartitions("key").persist(StorageLevel.DISK_ONLY))
        return self.arrays[-1]

    def _scanned(self, array: DataFrame) -> DataFrame:
        """The array, computed: a join sees how it is dealt and sorted only then."""
        if id(array) not in self.ready:
            array.count()
            self.ready.add(id(array))
        return array

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index the ``key`` column of a batch; the keys seen twice in it or in a level before it."""
        array, rank = self._array(suffixes.select("key"), "count(*)"), 0
        batch = self._scanned(array)
        found = batch.where("n > 1").select("key")
        for _, level in self.levels:
            found = found.unionByName(batch.join(self._scanned(level), "key", "left_semi").select("key"))
        while self.levels and self.levels[-1][0] == rank:
            _, equal = self.levels.pop()
            array, rank = self._array(equal.unionByName(array), "sum(n)"), rank + 1
        self.levels.append((rank, array))
        return found

    def close(self) -> None:
        for array in self.arrays:
            array.unpersist()


def contexts_of(spread: DataFrame, length: int) -> DataFrame:
    """The bytes of the given runs: all windows of a run, end to end."""

    def each(columns):
        owners = zip(columns["doc_id"], columns["tag"], texts(columns["text"]), columns["places"])
        for doc_id, tag, body, places in owners:
            owner = doc_id.as_py(), tag.as_py()
            for p in places.as_py():
                yield p["key"], p["hot"], p["n"], *owner, p["first"], body[p["first"] : p["last"] + length]

    return rows_through_arrow(
        spread, each, "key long, hot boolean, n long, doc_id long, tag long, first long, body binary"
    )


def _windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows, and how many each context has."""
    counts = np.array([len(body) - length + 1 for body in bodies])
    spots = ((body, s) for body, n in zip(bodies, counts.tolist()) for s in range(n))
    return np.fromiter((_xx(body[s : s + length]) for body, s in spots), np.int64, int(counts.sum())), counts


def _resolved(rows: pa.Table, length: int) -> dict:
    """Spans of the windows that occur again; all contexts of a key are here."""
    windows, counts = _windows([body.as_py() for body in rows["body"]], length)
    owner = np.repeat(np.arange(rows.num_rows), counts)
    offset = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts)
    n = rows["n"].to_numpy()[owner]
    _, same_window = np.unique(windows, return_inverse=True)
    again = np.flatnonzero((np.bincount(same_window, weights=n)[same_window] > 1) & (n == 1))
    owner, offset = owner[again], offset[again]
    edge = np.flatnonzero((np.diff(owner) != 0) | (np.diff(offset) != 1))
    start, stop = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(again) - 1]))
    if not len(again):
        start = stop = np.zeros(0, np.int64)
    first = rows["first"].to_numpy()[owner[start]]
    of = pa.array(owner[start])
    return {
        "doc_id": rows["doc_id"].take(of),
        "tag": rows["tag"].take(of),
        "start": first + offset[start],
        "end": first + offset[stop] + length,
    }


def _resolve_in_tasks(contexts: DataFrame, length: int) -> DataFrame:
    """Compare the contexts of each key where they arrive, sorted by key, some thousands at a time."""
    columns = ("doc_id", "tag", "start", "end")
    schema = pa.schema([(name, pa.int64()) for name in columns])
    at_once = TASK_CONTEXTS

    def run(batches):
        held, rows = [], 0

        def spans(table):
            out = _resolved(table, length)
            arrays = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else pa.array(x) for x in map(out.get, columns)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                held.append(batch.slice(at, at_once))
                rows += held[-1].num_rows
                if rows >= at_once:
                    table = pa.Table.from_batches(held)
                    keys = table["key"].to_numpy()
                    whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                    if whole:
                        yield spans(table.slice(0, whole))
                    held, rows = table.slice(whole).to_batches(), table.num_rows - whole
        if rows:
            yield spans(pa.Table.from_batches(held))

    ordered = contexts.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "doc_id long, tag long, start long, end long")


def _resolve_in_rows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for keys with too many contexts for one task: every window is a row."""

    def each(columns):
        bodies = list(texts(columns["body"]))
        windows, counts = _windows(bodies, length)
        owner = np.repeat(np.arange(len(bodies)), counts)
        offset = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts)
        of = pa.array(owner)
        start = columns["first"].to_numpy()[owner] + offset
        yield {"window": windows, "start": start} | {name: columns[name].take(of) for name in ("key", "n", "doc_id", "tag")}

    # Equal windows have the same anchor: they are compared within its key, never across all keys.
    rows = through_arrow(contexts, each, "key long, window long, start long, n long, doc_id long, tag long")
    twice = rows.groupBy("key", "window").agg(F.sum("n").alias("total")).where("total > 1").select("key", "window")
    again = rows.where("n = 1").join(twice, ["key", "window"], "left_semi")
    return again.select("doc_id", "tag", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, rules: SuffixRules) -> DataFrame:
    """``doc_id``, ``tag`` and ``spans`` (start, end) that cover every byte of a repeated string, and no other."""
    suffixes = written(entries(docs, rules), "suffix-entries")
    count = suffixes.count()

    def kept(rows: DataFrame, label: str) -> DataFrame:
        return written(fewer_tasks(rows, count, ENTRIES_A_TASK), label)

    family = IndexFamily(docs.sparkSession, "suffix-arrays")
    matches = [family.add(suffixes.where(F.col("batch") == batch).select("key")) for batch in range(rules.batches)]
    keys = matches[0]
    for found in matches[1:]:
        keys = keys.unionByName(found)
    keys = kept(keys.distinct(), "suffix-keys")  # a plain side, so that a skewed key can be split
    family.close()
    shared = written(suffixes.drop("batch").join(keys, "key", "left_semi"), "suffix-shared")
    drop_written(suffixes)

    place = F.struct("doc_id", "tag", "first", "last")
    contexts = shared.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    contexts = kept(contexts, "suffix-contexts")
    again = contexts.where("n > 1").select("key", "context")
    inside = shared.join(again, ["key", "context"], "left_semi")
    inside = inside.select("doc_id", "tag", F.col("first").alias("start"), (F.col("last") + rules.length).alias("end"))

    several = contexts.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1")
    several = several.select("key", (F.col("contexts") > HOT_CONTEXTS).alias("hot"))
    borders = contexts.join(several, "key").select("key", "hot", "n", "place.*")
    places = F.collect_list(F.struct("key", "hot", "first", "last", "n")).alias("places")
    spread = _with_owner(docs, borders.groupBy("doc_id", "tag").agg(places))
    bodies = kept(contexts_of(spread, rules.length), "suffix-borders")
    border = _resolve_in_tasks(bodies.where("not hot"), rules.length)
    border = kept(border.unionByName(_resolve_in_rows(bodies.where("hot"), rules.length)), "suffix-border-spans")
    spans = inside.unionByName(border).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return kept(spans, "suffix-spans")


def _with_owner(docs: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    owner = found.withColumnsRenamed({"doc_id": "_doc_id", "tag": "_tag"})
    joined = docs.join(owner, same(docs["doc_id"], owner["_doc_id"]) & (docs["tag"] == owner["_tag"]), how)
    return joined.drop("_doc_id", "_tag")


def deduplicate(
    docs: DataFrame, rules: SuffixRules = SuffixRules(), id: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (maximal spans of bytes) and what is left, per row.

    ``kept`` has the bytes left, ``kept_text`` the same as text without characters that were cut.

    A byte is removed when a string of ``length`` bytes that covers it starts anywhere else as
    well, in the same document or another. Null text counts as empty and texts shorter than
    ``length`` keep all bytes. Repeated rows are occurrences of their text like any other, so a
    row that occurs twice loses what it repeats; ids may be null; other columns are ignored; an
    empty table gives an empty table. With ``carry`` the
    input's other columns come along in ``carried``.
    """
    keyed = _keyed(docs, id, text, carry)
    extra = carried(keyed)
    spans = repeated_spans(keyed.drop("carried"), rules)
    joined = _with_owner(keyed, spans, "left")

    def each(columns):
        rows = zip(columns["doc_id"], texts(columns["text"]), columns["spans"], *(columns[name] for name in extra))
        for doc_id, body, spans, *rest in rows:
            removed = merged([(s["start"], s["end"]) for s in spans.as_py() or ()])
            kept, at = [], 0
            for start, end in removed:
                kept.append(body[at:start])
                at = end
            kept.append(body[at:])
            spans = [{"start": s, "end": e} for s, e in removed]
            left = b"".join(kept)
            yield doc_id.as_py(), len(body), spans, left, left.decode(errors="ignore"), *(row.as_py() for row in rest)

    schema = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary, kept_text string"
    return rows_through_arrow(joined, each, schema + carried_schema(keyed))
