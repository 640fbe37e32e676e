"""Shard layouts: which rows go to which output directory.

A layout turns a DataFrame into the same rows plus its partition columns. ``shard_index`` is
always derivable, rows that no shard claims are left out (as separate queries with one
predicate each would leave them out), and ``coverage`` counts how often each row is claimed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD = "shard_index"

# Characters Spark writes as %XX in a partition directory, besides control characters.
ESCAPED_IN_PATHS = "\"#%'*/:=?\\{[]^\x7f"


def hive_value(value) -> str:
    """``value`` as it appears behind ``column=`` in a partition directory."""
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_PATHS or ord(c) < 32 else c for c in text)


def sql_literal(value) -> str:
    """``value`` as SQL text, for predicates handed to a database."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, Decimal):
        return format(value, "f")
    return "'" + str(value).replace("'", "''") + "'"


class Shards:
    """Base layout. Subclasses give ``count``, ``predicates`` and ``assign``."""

    partition_columns: tuple[str, ...] = (SHARD,)

    @property
    def count(self) -> int:
        raise NotImplementedError

    def predicates(self) -> list[Column]:
        """One condition per shard, in shard order."""
        return [F.expr(text) for text in self.sql_predicates()]

    def sql_predicates(self) -> list[str]:
        """The same conditions as SQL text, for ``JdbcSource(predicates=...)``."""
        raise NotImplementedError

    def assign(self, df: DataFrame, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of the shards in ``only`` (default: all) with the partition columns added."""
        raise NotImplementedError

    def index(self) -> Column:
        """Shard number of a row that has the partition columns."""
        return F.col(SHARD)

    def directory(self, shard: int) -> str:
        """Relative directory a shard lands in."""
        return f"{SHARD}={shard}"

    def spec(self, spark: SparkSession) -> DataFrame:
        """All shard numbers, one row each."""
        return spark.range(self.count).select(F.col("id").cast("int").alias(SHARD))


def _keep(df: DataFrame, index: Column, only: Sequence[int] | None) -> DataFrame:
    df = df.withColumn(SHARD, index.cast("int")).filter(F.col(SHARD).isNotNull())
    return df if only is None else df.filter(F.col(SHARD).isin(*only))


@dataclass(frozen=True)
class SingleShard(Shards):
    """Everything in shard 0, written straight to the export path."""

    partition_columns: tuple[str, ...] = ()

    @property
    def count(self) -> int:
        return 1

    def sql_predicates(self) -> list[str]:
        return ["1 = 1"]

    def assign(self, df, only=None):
        return df if only is None or 0 in only else df.limit(0)

    def index(self) -> Column:
        return F.lit(0)

    def directory(self, shard: int) -> str:
        return ""


@dataclass(frozen=True)
class ModShards(Shards):
    """``key`` modulo ``shards``. Negative keys wrap upwards and NULL keys go to shard 0, so
    every row has a shard."""

    key: str
    shards: int

    def __post_init__(self):
        if self.shards < 1:
            raise ValueError("shards must be at least 1")

    @property
    def count(self) -> int:
        return self.shards

    def sql_predicates(self) -> list[str]:
        n, k = self.shards, self.key
        wrapped = f"MOD(MOD({k}, {n}) + {n}, {n})"
        return [f"{wrapped} = {i}" + (f" OR {k} IS NULL" if i == 0 else "") for i in range(n)]

    def assign(self, df, only=None):
        return _keep(df, F.coalesce(F.pmod(F.col(self.key), F.lit(self.shards)), F.lit(0)), only)


@dataclass(frozen=True)
class RangeShards(Shards):
    """Half-open key ranges ``[lo, hi)``; the last may be open-ended (``hi=None``).

    Ranges must be in order and touch: a gap would lose rows, an overlap would repeat them.
    """

    key: str
    ranges: Sequence[tuple]

    def __post_init__(self):
        if not self.ranges:
            raise ValueError("ranges must not be empty")
        for i, (lo, hi) in enumerate(self.ranges):
            if lo is None:
                raise ValueError(f"range {i} has no lower bound")
            if hi is None:
                if i != len(self.ranges) - 1:
                    raise ValueError("only the last range may be open-ended")
            elif hi <= lo:
                raise ValueError(f"range {i} is empty: [{lo}, {hi})")
            if i and self.ranges[i - 1][1] != lo:
                kind = "gap" if self.ranges[i - 1][1] < lo else "overlap"
                raise ValueError(f"{kind} between range {i - 1} and range {i}")

    @property
    def count(self) -> int:
        return len(self.ranges)

    def sql_predicates(self) -> list[str]:
        return [
            f"{self.key} >= {sql_literal(lo)}" + ("" if hi is None else f" AND {self.key} < {sql_literal(hi)}")
            for lo, hi in self.ranges
        ]

    def assign(self, df, only=None):
        wanted = range(self.count) if only is None else only
        key = F.col(self.key)
        # One plain comparison on each side first, so that the scan can skip row groups.
        if wanted:
            df = df.filter(key >= F.lit(self.ranges[min(wanted)][0]))
            top = self.ranges[max(wanted)][1]
            if top is not None:
                df = df.filter(key < F.lit(top))
        cases = reduce(
            lambda case, i: case.when(key < F.lit(self.ranges[i][1]), F.lit(i)),
            [i for i in range(self.count) if self.ranges[i][1] is not None],
            F.when(key < F.lit(self.ranges[0][0]), F.lit(None).cast("int")),
        )
        last_open = self.ranges[-1][1] is None
        index = cases.when(key.isNotNull(), F.lit(self.count - 1)) if last_open else cases
        return _keep(df, index, only)


class _KeyedShards(Shards):
    """Shards named by column values; the values become Hive directories."""

    def keys(self) -> list[tuple]:
        raise NotImplementedError

    @property
    def count(self) -> int:
        return len(self.keys())

    def sql_predicates(self) -> list[str]:
        return [
            " AND ".join(f"{c} = {sql_literal(v)}" for c, v in zip(self.partition_columns, key))
            for key in self.keys()
        ]

    def directory(self, shard: int) -> str:
        return "/".join(f"{c}={hive_value(v)}" for c, v in zip(self.partition_columns, self.keys()[shard]))


def _check_values(column: str, values: Sequence) -> None:
    # An empty text value would share the NULL directory and come back as NULL.
    if not values or len(set(values)) != len(values) or None in values or "" in values:
        raise ValueError(f"values of {column!r} must be a list of distinct, non-NULL, non-empty values")


@dataclass(frozen=True)
class ValueShards(_KeyedShards):
    """One shard per listed value of a column; other rows are left out."""

    column: str
    values: Sequence

    def __post_init__(self):
        _check_values(self.column, self.values)

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return (self.column,)

    def keys(self) -> list[tuple]:
        return [(v,) for v in self.values]

    def index(self) -> Column:
        return (F.array_position(F.array(*[F.lit(v) for v in self.values]), F.col(self.column)) - 1).cast("int")

    def assign(self, df, only=None):
        wanted = self.values if only is None else [self.values[i] for i in only]
        return df.filter(F.col(self.column).isin(*wanted))


@dataclass(frozen=True)
class CrossShards(_KeyedShards):
    """One shard per combination of the listed values of several columns.

    Membership is one ``IN`` list per column and the shard number is arithmetic on the list
    positions: no join, and every list reaches the scan as a pushed filter.
    """

    values: dict[str, Sequence]

    def __post_init__(self):
        if not self.values:
            raise ValueError("values must name at least one column")
        for column, listed in self.values.items():
            _check_values(column, listed)

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return tuple(self.values)

    def keys(self) -> list[tuple]:
        return list(product(*self.values.values()))

    def index(self) -> Column:
        total = F.lit(0).cast("bigint")
        for column, listed in self.values.items():
            place = F.array_position(F.array(*[F.lit(v) for v in listed]), F.col(column)) - 1
            total = total * len(listed) + place
        return total.cast("int")

    def assign(self, df, only=None):
        keys = self.keys()
        chosen = keys if only is None else [keys[i] for i in only]
        for place, (column, listed) in enumerate(self.values.items()):
            wanted = {key[place] for key in chosen}
            df = df.filter(F.col(column).isin(*[v for v in listed if v in wanted]))
        return df if only is None else df.filter(self.index().isin(*only))


@dataclass(frozen=True)
class PredicateShards(Shards):
    """One free SQL condition per shard: the general form of a list of shard queries.

    A row is exported once for every condition it meets, exactly as separate queries would,
    but in one pass over the source.
    """

    conditions: Sequence[str]

    def __post_init__(self):
        if not self.conditions:
            raise ValueError("conditions must not be empty")

    @property
    def count(self) -> int:
        return len(self.conditions)

    def sql_predicates(self) -> list[str]:
        return list(self.conditions)

    def assign(self, df, only=None):
        wanted = list(range(self.count)) if only is None else list(only)
        conditions = self.predicates()
        # Any of them, as one filter that the scan can use.
        df = df.filter(reduce(lambda a, b: a | b, [conditions[i] for i in wanted], F.lit(False)))
        hits =F.array_compact(F.array(*[F.when(conditions[i], F.lit(i)) for i in wanted]))
        return df.withColumn(SHARD, F.explode(hits))


def day_columns(df: DataFrame, column: str) -> DataFrame:
    """Zero-padded ``year`` / ``month`` / ``day`` text columns for Hive paths."""
    return df.withColumns(
        {
            "year": F.date_format(column, "yyyy"),
            "month": F.date_format(column, "MM"),
            "day": F.date_format(column, "dd"),
        }
    )


DAY_COLUMNS = ("year", "month", "day")


def day_slice(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one calendar day, as a half-open range that the scan can use."""
    start = F.lit(day).cast("date")
    kind = df.schema[column].dataType
    return df.filter((F.col(column) >= start.cast(kind)) & (F.col(column) < F.date_add(start, 1).cast(kind)))


def coverage(df: DataFrame, shards: Shards) -> DataFrame:
    """``(hits, rows)``: how many rows are claimed by 0, 1, 2 ... shards. Whole means only 1."""
    claimed = [F.coalesce(p.cast("int"), F.lit(0)) for p in shards.predicates()]
    hits = reduce(lambda a, b: a + b, claimed).alias("hits")
    return df.groupBy(hits).agg(F.count("*").alias("rows"))


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _quantiles(df: DataFrame, key: str, parts: int, accuracy: int) -> list:
    """Values of ``key`` that cut its rows into ``parts`` of about the same size; a value that holds
    several parts comes several times."""
    places = [i / parts for i in range(1, parts)]
    if not places:
        return []
    found = df.agg(F.percentile_approx(_column(key), places, accuracy)).first()[0]
    return list(found or [])


def equal_depth_shards(
    df: DataFrame, key: str, parts: int, then: str | None = None, quote: str = "`", accuracy: int = 10_000
) -> PredicateShards:
    """Range conditions on ``key`` that give each shard about the same number of rows.

    Borders are approximate quantiles, right to ``1 / accuracy`` of the rows. A value that holds several
    parts by itself gets a shard of its own, which ``then``, a numeric column, cuts into as many. Together
    the conditions take every row once: below the first border, NULL keys too. Names stand in ``quote``
    (a backtick for Spark, a double quote for most databases), so that the texts can be handed to a
    :class:`~exportkit.sources.JdbcSource` as they are. The key has to be a number.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    quoted = lambda name: quote + name.replace(quote, quote * 2) + quote

    def ranges(column: str, cuts: list, lone: Sequence = ()) -> list[tuple]:
        """``(cut, condition)`` of each half-open range; values in ``lone`` are left out of theirs."""
        found = []
        for low, high in zip([None, *cuts], [*cuts, None]):
            bounds = [] if low is None else [f"{column} {'>' if low in lone else '>='} {sql_literal(low)}"]
            bounds += [] if high is None else [f"{column} < {sql_literal(high)}"]
            text = " AND ".join(bounds) or "1 = 1"
            found.append((low, f"({text} OR {column} IS NULL)" if low is None and bounds else text))
        return found

    borders = _quantiles(df, key, parts, accuracy)
    heavy = {v: borders.count(v) for v in borders if borders.count(v) > 1}
    conditions = []
    for low, condition in ranges(quoted(key), sorted(set(borders)), heavy):
        if low in heavy:
            own = f"{quoted(key)} = {sql_literal(low)}"
            inner = []
            if then is not None:
                inner = sorted(set(_quantiles(df.where(_column(key) == F.lit(low)), then, heavy[low], accuracy)))
            conditions += [f"{own} AND {part}" for _, part in ranges(quoted(then), inner)] if inner else [own]
        conditions.append(condition)
    return PredicateShards(conditions)
