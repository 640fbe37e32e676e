"""Conversation prefixes as a burst trie.

Every conversation becomes a sequence of turn ids (digests of role and text). Equal sequences are
merged first, so a group of copies is one entry with a weight. A container holds entries that share
a head. One that is too large bursts: the prefix that all its entries share becomes a chain of trie
nodes, and the next turn id deals the entries out to new containers. Containers that are small enough
are dealt over the tasks, sorted, and swept into nodes with a stack. What the nodes above a container
have to know of it (leaves, tokens saved) is summed along its path of burst containers.

A conversation is one row of turn ids, 32 characters a turn and without its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, drop_written, narrow, partitions, rows_through_arrow, written

#: Turns that a container may hold below its head before it bursts.
CONTAINER_TURNS = 1 << 16
#: Ids that are hashed together at once.
IDS_AT_ONCE = 512
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = ""
TURNS = "array<struct<turn_id: string, words: int>>"

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string"
)


def conversations(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id`` and ``turns`` (id and number of words of each, in order) per conversation.

    Turns are ordered by ``turn``, null first; equal ones by the digest of role and text. Null role and
    text are empty. Rows without an id belong to no conversation.
    """
    rows = narrow(turns, conv_id=id, turn=turn, role=role, text=text).where("conv_id is not null")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = rows.select("conv_id", "turn", digest.alias("turn_id"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "turn_id", "words"))).alias("all"))
    return found.select("conv_id", F.transform("all", lambda t: F.struct(t["turn_id"], t["words"])).cast(TURNS).alias("turns"))


def rebuilt(convs: DataFrame, block: int = 20, choices: int = 4) -> DataFrame:
    """Conversations that begin with the first turns of the first of their block.

    Conversation ``c`` gets the first ``crc32(c) % choices`` turns of ``c - c % block`` in place of its
    own; where that one is absent or shorter, what there is of it.
    """
    base = F.col("conv_id") - F.col("conv_id") % block
    heads = convs.where(F.col("conv_id") % block == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, choices - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % choices).cast("int")
    rows = convs.select("conv_id", "turns", base.alias("base"), taken.alias("taken")).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(TURNS)), F.lit(1), F.col("taken"))
    own = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, own).alias("turns"))


def _prefix_digest(turns, length):
    return F.md5(F.array_join(F.transform(F.slice(turns, F.lit(1), length), lambda t: t["turn_id"]), ""))


def _ends(convs: DataFrame) -> DataFrame:
    """``sequence`` and ``ends_sha256`` of the ids of its conversations, joined in ascending order.

    Ids are sorted over all tasks and joined some hundreds at a time, so that the one task which has to
    hash those of a sequence in order gets them in few rows, and holds few of them at once.
    """
    many = partitions(convs.sparkSession)
    dealt = convs.repartitionByRange(many, "sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")

    def join(columns):
        open_, first, ids = None, 0, []
        for sequence, conv_id in zip(columns["sequence"].to_pylist(), columns["conv_id"].to_pylist()):
            if sequence != open_ or len(ids) == IDS_AT_ONCE:
                if ids:
                    yield open_, first, ",".join(ids)
                open_, first, ids = sequence, conv_id, []
            ids.append(str(conv_id))
        if ids:
            yield open_, first, ",".join(ids)

    joined = rows_through_arrow(dealt, join, "sequence string, first long, ids string")
    dealt = joined.repartition(many, "sequence").sortWithinPartitions("sequence", "first")

    def run(batches):
        open_, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for sequence, ids in zip(batch.column("sequence").to_pylist(), batch.column("ids")):
                if sequence == open_:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((open_, state.hexdigest()))
                    open_, state = sequence, hashlib.sha256()
                state.update(ids.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (*zip(*done),) or ([], [])], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (open_, state.hexdigest())], names=names)

    names = ["sequence", "ends_sha256"]
    return dealt.mapInArrow(run, "sequence string, ends_sha256 string")


# -------------------------------------------------------------------------------- bursting


def _burst(entries: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """``(ready, burst, scratch)``: entries in containers that need no burst, and the containers that did.

    ``entries``: ``sequence``, ``n``, ``first`` (smallest id), ``turns``, and of their container: its
    ``head`` (a digest of the turns all its entries begin with), their number ``depth`` and the ``path`` of
    burst containers above.
    """
    now, ready, bursts, scratch = entries, [], [], []
    while True:
        sizes = now.groupBy("head").agg(
            F.sum(F.size("turns") - F.col("depth")).alias("held"),
            F.count(F.lit(1)).alias("entries"),
            F.min("turns").alias("low"),
            F.max("turns").alias("high"),
        )
        # The smallest and the largest sequence share what all of them share.
        agree = F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b))
        shared = F.array_position(agree, False).cast("int") - 1
        large = sizes.where((F.col("held") > limit) & (F.col("entries") > 1)).select("head", shared.alias("shared"))
        large = written(large, "trie-large")
        scratch.append(large)
        if large.isEmpty():
            ready.append(now)
            return ready, bursts, scratch
        split = written(now.join(large, "head", "left"), "trie-split")
        scratch.append(split)
        ready.append(split.where("shared is null").drop("shared"))
        inside = split.where("shared is not null")
        ended = F.size("turns") == F.col("shared")
        bursts.append(
            inside.groupBy("head", "depth", "shared", "path").agg(
                F.sum("n").alias("n"),
                F.min("first").alias("first"),
                F.max(F.when(ended, F.col("sequence"))).alias("ends"),
                F.min("turns").alias("turns"),
            )
        )
        now = inside.where(~ended).select(
            "sequence", "n", "first", "turns",
            _prefix_digest("turns", F.col("shared") + 1).alias("head"),
            (F.col("shared") + 1).alias("depth"),
            F.concat("path", F.array("head")).alias("path"),
        )


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -------------------------------------------------------------------------------- sweeping


class _Sweep:
    """Nodes of one container, from its entries in order."""

    def __init__(self, depth: int, path: list[str], words: int) -> None:
        self.path, self.before = path, []
        # Of each node: depth, words, smallest id, members, children, leaves, saved, sequence that ends, parent.
        self.nodes, self.stack = [], []
        self._open(depth, words, None)

    def _open(self, depth: int, words: int, parent: int | None) -> None:
        self.stack.append(len(self.nodes))
        self.nodes.append([depth, words, None, 0, 0, 0, 0, None, parent])

    def _close(self) -> None:
        node = self.nodes[self.stack.pop()]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[1]
        if node[8] is not None:
            above = self.nodes[node[8]]
            above[2] = node[2] if above[2] is None else min(above[2], node[2])
            above[3] += node[3]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]

    def add(self, turns: list[str], words: list[int], first: int, n: int, sequence: str) -> None:
        top, common = self.nodes[0][0], self.nodes[0][0]
        for a, b in zip(self.before[top:], turns[top:]):
            if a != b:
                break
            common += 1
        while len(self.stack) > common - top + 1:
            self._close()
        for depth in range(common, len(turns)):
            self._open(depth + 1, words[depth], self.stack[-1])
        node = self.nodes[self.stack[-1]]
        node[2] = first if node[2] is None else min(node[2], first)
        node[3] += n
        node[7] = sequence
        self.before = turns

    def rows(self) -> Iterator[tuple]:
        while self.stack:
            self._close()
        for depth, _, first, n, children, leaves, saved, ends, parent in self.nodes:
            above = None if parent is None else self.nodes[parent][2]
            yield first, depth, above, n, children, leaves, saved, ends, self.path if parent is None else None


def _swept(entries: DataFrame) -> DataFrame:
    """Nodes of all containers; ``path`` is set at the top of each."""
    columns = ("head", "depth", "path", "sequence", "n", "first", "turns")
    dealt = entries.select(*columns).repartition(partitions(entries.sparkSession), "head")
    dealt = dealt.sortWithinPartitions("head", "turns")

    def run(batches):
        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        head, sweep = None, None
        for batch in batches:
            turns = batch.column("turns")
            ids, words = (turns.flatten().field(i).to_pylist() for i in range(2))
            ends = np.cumsum(turns.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            places = zip([0, *ends], ends)
            rows = []
            others = (batch.column(c).to_pylist() for c in ("head", "depth", "path", "sequence", "n", "first"))
            for own, depth, path, sequence, n, first, (a, b) in zip(*others, places):
                if own != head:
                    if sweep is not None:
                        rows += sweep.rows()
                    head, sweep = own, _Sweep(depth, path, words[a + depth - 1] if depth else 0)
                sweep.add(ids[a:b], words[a:b], first, n, sequence)
                if len(rows) >= 4096:
                    yield pack(rows)
                    rows = []
            if rows:
                yield pack(rows)
        if sweep is not None:
            yield pack(list(sweep.rows()))

    names = [part.split()[0] for part in NODES.split(", ")] + ["path"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.string())]
    return dealt.mapInArrow(run, NODES + ", path array<string>")


def _chains(bursts: DataFrame) -> DataFrame:
    """Nodes of the burst containers: those of the prefix that all their entries share.

    ``bursts`` has the container's ``children``, and ``leaves`` and ``saved`` of what hangs below it.
    """

    def each(columns):
        for row in zip(*(columns[c].to_pylist() for c in wanted)):
            depth, shared, first, n, ends, words, children, leaves, saved, above = row
            own = [(n - 1) * (words[d - 1] if d else 0) for d in range(depth, shared + 1)]
            below = saved + sum(own)
            for d, cost in zip(range(depth, shared + 1), own):
                last = d == shared
                yield first, d, above if d == depth else first, n, children if last else 1, leaves, below, ends if last else None
                below -= cost

    wanted = ("depth", "shared", "first", "n", "ends", "words", "children", "leaves", "saved", "above")
    rows = bursts.withColumn("words", F.transform("turns", lambda t: t["words"])).select(*wanted)
    return rows_through_arrow(rows, each, NODES)


def trie(convs: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node of the trie over ``conv_id`` and ``turns`` (see :func:`conversations`).

    ``conv_id`` is the smallest member and ``depth`` the number of turns, which name a node together;
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` as in the module's query. Conversations without turns are members of the root. Copies
    count each; conversations are told apart by 128-bit digests; an empty table gives an empty table.
    """
    convs = convs.withColumn("sequence", _prefix_digest("turns", F.size("turns")))
    convs = written(convs, "trie-sequences")
    entries = convs.groupBy("sequence").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.first("turns").alias("turns")
    )
    entries = entries.withColumns(
        {"head": F.lit(ROOT), "depth": F.lit(0), "path": F.array().cast("array<string>")}
    )
    entries = written(entries, "trie-entries")
    ready, bursts, scratch = _burst(entries, container_turns)
    swept = written(_swept(_all(ready)), "trie-nodes")
    tops = swept.where("path is not null")
    scratch += [convs, entries, swept]
    parent = F.get("path", F.size("path") - 1)
    if bursts:
        burst = written(_all(bursts), "trie-burst")
        scratch.append(burst)
        costs = F.transform(F.sequence("depth", "shared"), lambda d: F.when(d > 0, F.get("turns", d - 1)["words"]).otherwise(0))
        own = (F.col("n") - 1) * F.aggregate(costs, F.lit(0).cast("long"), lambda a, b: a + b)
        sums = tops.select(F.explode("path").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        inner = burst.select(F.explode("path").alias("head"), F.lit(0).cast("long").alias("leaves"), own.alias("saved"))
        sums = sums.unionAll(inner).groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        hung = tops.where(F.size("path") > 0).select(parent.alias("head"))
        hung = hung.unionAll(burst.where(F.size("path") > 0).select(parent.alias("head")))
        hung = hung.groupBy("head").agg(F.count(F.lit(1)).alias("children"))
        names = burst.select(F.col("head").alias("parent"), F.col("first").alias("above"))
        linked = burst.withColumn("parent", F.coalesce(parent, F.lit("none"))).join(names, "parent", "left")
        chains = _chains(linked.join(sums, "head").join(hung, "head"))
        linked = tops.where(F.size("path") > 0).withColumn("parent", parent).join(names, "parent")
        linked = linked.withColumn("parent_conv_id", F.col("above")).select(chains.columns)
        plain = swept.where("path is null or size(path) = 0").select(chains.columns)
        nodes = plain.unionAll(linked).unionAll(chains)
    else:
        nodes = swept.drop("path")
    columns = [c for c in nodes.columns if c != "ends"]
    ending = nodes.where("ends is not null").withColumnRenamed("ends", "sequence").join(_ends(convs.select("sequence", "conv_id")), "sequence")
    passing = nodes.where("ends is null").withColumn("ends_sha256", F.lit(NO_ENDS))
    result = written(ending.select(*columns, "ends_sha256").unionAll(passing.select(*columns, "ends_sha256")), "trie")
    for frame in scratch:
        drop_written(frame)
    return result
