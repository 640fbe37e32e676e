"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, fewer_tasks, written

LINKS_A_TASK = 1 << 16


def _stars(links: DataFrame) -> DataFrame:
    """One large-star step and one small-star step over links ``(a, b)`` with ``a > b``."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every node but the roots.

    ``links`` has the long columns ``a`` and ``b``. Nodes hang on ever smaller neighbours until
    each hangs on the root of its component, which takes about log n rounds. Every round is
    written to the shared folder, by as many tasks as the links of the round before need; only a count
    and a checksum come to the driver.
    """
    now = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark[0] == 0 or mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, before = mark, now
        now = written(fewer_tasks(_stars(before), mark[0], LINKS_A_TASK), label)
        drop_written(before)
