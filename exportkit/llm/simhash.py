"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``3`` bits meet in a third one that lies within two bits of one of them
and within one bit of the other. So every fingerprint emits the variants around itself, variants
are shuffled, and the members of a variant that is close to one of them hang on that member.

Which of two emits the larger ball is fixed by parity: three differing bits make one fingerprint
even and the other odd, and one or two are bridged by single flips from both sides. Odd ones flip
two bits (both in the same half, as two of any three bits are), even ones one bit.

Joins are sort-merge joins by hint: no side has a size bound that would allow a broadcast.

Variants are only emitted for fingerprints that have another one nearby on one half, exactly or
with one bit flipped. A pair within three bits always agrees that far on one of its halves, so
nothing is lost, and lonely fingerprints cost 34 small rows instead of a thousand.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fewer_tasks, narrow, partitions, texts, through_arrow, written
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
HALF = 32
CHUNK = 1 << 16
NODES_A_TASK = 2048  # fingerprints a task compares by halves at least, up to 34 rows each
BALLS_A_TASK = 512  # the same for balls, up to 1,057 rows each
_KEYS = ("id", "no_id", "tag")

_SINGLE = [0] + [1 << bit for bit in range(64)]
_DOUBLE = [
    (1 << low) | (1 << high)
    for base in (0, HALF)
    for low, high in combinations(range(base, base + HALF), 2)
]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes) -> int:
    """Majority bits of the hashed word shingles of one text, as a signed 64-bit number."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < SHINGLE else list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), CHUNK):
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles[at : at + CHUNK]])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.frombuffer(np.packbits(ones * 2 > len(shingles)).tobytes(), ">i8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and a ``tag`` of the text, which tells rows apart that share an id."""

    def each(columns):
        prints = [fingerprint(t) for t in texts(columns["text"])]
        yield {"doc_id": columns["doc_id"], "tag": columns["tag"], "fp": prints}

    rows = narrow(docs, doc_id=id, text=text).withColumn("tag", F.xxhash64("text"))
    return through_arrow(rows, each, "doc_id long, tag long, fp long")


def _halves(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, HALF), fp.bitwiseAND(F.lit((1 << HALF) - 1))]


def near_on_a_half(nodes: DataFrame, count: int | None = None) -> DataFrame:
    """The fingerprints that share a half with another one, up to one bit.

    Halves that differ in one bit differ in parity: the even one emits all its flips, the odd one
    only itself, and they meet at the odd one. ``count`` is how many ``nodes`` there are at
    most, if that is known.
    """
    count = nodes.count() if count is None else count
    # Thousands of fingerprints fit a few bytes of a file, and each becomes many rows: the scan alone would
    # leave them to one task.
    nodes, keys = nodes.repartition(partitions(nodes.sparkSession), "fp"), []
    for side, half in enumerate(_halves(F.col("fp"))):
        flips = F.array(half, *(half.bitwiseXOR(F.lit(1 << bit).cast("long")) for bit in range(HALF)))
        even = F.bit_count(half) % 2 == 0
        key = F.explode(F.when(even, flips).otherwise(F.array(half))).alias("key")
        keys.append(nodes.select("fp", key).withColumn("side", F.lit(side)))
    rows = keys[0].unionByName(keys[1])
    shared = rows.groupBy("side", "key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    shared = fewer_tasks(shared.where("low <> high").select("side", "key"), count, NODES_A_TASK)
    shared = written(shared, "simhash-halves")
    near = rows.join(shared.hint("merge"), ["side", "key"], "left_semi").select("fp").distinct()
    return fewer_tasks(near, count, NODES_A_TASK)


def links(nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints that connect all pairs within ``RADIUS`` bits.

    A variant's members hang on its hub, the smallest of those within one bit; all of them are
    within three bits of it, which is checked once more. No group is expanded into pairs.
    """
    single = F.lit([_signed(m) for m in _SINGLE]).cast("array<long>")
    larger = F.lit([_signed(m) for m in _SINGLE + _DOUBLE]).cast("array<long>")
    odd = F.bit_count("fp") % 2 == 1
    count = nodes.count()
    nodes = nodes.repartition(partitions(nodes.sparkSession), "fp")
    balls = nodes.select("fp", F.explode(F.when(odd, larger).otherwise(single)).alias("mask"))
    balls = balls.select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), (F.bit_count("mask") <= 1).alias("close")
    )
    meets = balls.groupBy("variant").agg(
        F.min("fp").alias("low"), F.max("fp").alias("high"), F.min(F.when(F.col("close"), F.col("fp"))).alias("hub")
    )
    meets = fewer_tasks(meets.where("low <> high and hub is not null").select("variant", "hub"), count, BALLS_A_TASK)
    meets = written(meets, "simhash-meets")
    found = balls.join(meets.hint("merge"), "variant").where("fp <> hub")
    found = found.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= RADIUS)
    return fewer_tasks(found.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct(), count, BALLS_A_TASK)


def _labelled(prints: DataFrame) -> DataFrame:
    """``root`` for every fingerprint, with the smallest id and the ``best`` row (id and tag) that have it."""
    best = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "tag")).alias("best")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), best)
    near = written(near_on_a_half(nodes.select("fp"), prints.count()), "simhash-near")
    roots = components(links(near), "simhash-links")
    labelled = nodes.join(roots.hint("merge"), nodes["fp"] == roots["node"], "left")
    return labelled.select("fp", "first", "best", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``tag`` (hash of the text), ``fp`` and ``component_id`` for every row.

    Documents are linked when their fingerprints differ in at most three bits; ``component_id`` is
    the smallest id that can be reached. Null, empty and blank texts have fingerprint zero and are
    linked like any other. Rows without an id get the smallest id of their component, null if none
    has one. Repeated rows each give a row; other columns are ignored; an empty table gives an
    empty table.
    """
    prints = written(fingerprints(docs, id, text), "simhash-prints")
    labelled = _labelled(prints).select("fp", "first", "root")
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest.hint("merge"), "root").select("fp", "component_id")
    return prints.join(classes.hint("merge"), "fp").select("doc_id", "tag", "fp", "component_id")


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component is kept.

    The row with the component's smallest id stays; among rows that share it, or where none has an id,
    the one with the smallest tag. Rows that agree in id and text come down to one of them, before they
    are dealt by id and tag: to the one whose other columns have the smallest hash (maps are not hashed).
    """
    prints = written(fingerprints(docs, id, text), "simhash-prints")
    best = _labelled(prints).groupBy("root").agg(F.min("best").alias("best"))
    keys = (F.coalesce("best.doc_id", F.lit(0).cast("long")), F.col("best.none"), F.col("best.tag"))
    best = best.select(*(key.alias(name) for key, name in zip(keys, _KEYS))).distinct()
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if f.name != text and "map<" not in f.dataType.simpleString()]
    owner, row = F.col(f"`{id}`").cast("long"), F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    keys = (F.coalesce(owner, F.lit(0).cast("long")), F.isnull(owner), F.xxhash64(F.col(f"`{text}`")))
    keyed = docs.select(*(key.alias(name) for key, name in zip(keys, _KEYS)), F.xxhash64(*hashed).alias("order"), row.alias("row"))
    single = keyed.groupBy(*_KEYS).agg(F.min_by("row", "order").alias("row"))
    # an inner join: a semi-join would be moved below the aggregate, and all repeated rows through the exchange
    return single.join(best.hint("merge"), list(_KEYS)).select("row.*")
