import hashlib
from datetime import datetime
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from exportkit.functions import (
    align,
    align_union,
    arrow_batches,
    audit,
    cast,
    chain,
    clamp,
    coerce_timestamps,
    derive,
    drift,
    drop,
    full_hash,
    redact,
    rename,
    short_hash,
)
from exportkit.session import conf_scope, small_table


@pytest.fixture
def people(spark):
    rows = [(1, "a@x", 5.0), (2, None, -3.0), (3, "", None), (4, "ü@x", 0.0)]
    return small_table(spark, rows, "id int, email string, balance double")


def values(df, column):
    return [r[column] for r in df.orderBy("id").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_redact_covers_nulls(people):
    assert values(redact(people, "email"), "email") == ["<redacted>"] * 4
    with pytest.raises(ValueError, match="no such column"):
        redact(people, "phone")


def test_short_hash_keeps_null_only(people):
    expected = [sha(v)[:16] + "@hashed" if v is not None else None for v in ("a@x", None, "", "ü@x")]
    assert values(short_hash(people, "email"), "email") == expected
    assert short_hash(people, "phone").columns == people.columns


def test_full_hash_empties_become_null(people):
    assert values(full_hash(people, "email"), "email") == [sha("a@x"), None, None, sha("ü@x")]
    assert full_hash(people, "phone").columns == people.columns


def test_clamp_turns_null_into_the_floor(people):
    assert values(clamp(people, "balance"), "balance") == [5.0, 0.0, 0.0, 0.0]
    assert clamp(people, "balance").schema["balance"].dataType == DoubleType()
    assert clamp(people, "debt").columns == people.columns


def test_drop_derive_rename_cast(people):
    assert drop(people, "email", "absent").columns == ["id", "balance"]
    assert values(derive(people, "twice", "id * 2"), "twice") == [2, 4, 6, 8]
    assert rename(people, {"id": "key"}).columns == ["key", "email", "balance"]
    assert cast(people, {"id": "string"}).schema["id"].dataType == StringType()
    assert values(cast(people, {"email": "int"}, lenient=True), "email") == [None] * 4


def test_chain_runs_in_order(people):
    steps = (partial(rename, names={"email": "mail"}), partial(full_hash, column="mail"), lambda df: drop(df, "balance"))
    result = chain(people, *steps)
    assert result.columns == ["id", "mail"]
    assert values(result, "mail")[0] == sha("a@x")


# ------------------------------------------------------------------ Arrow batches


def test_arrow_batch_changes_columns_and_rows(spark, people):
    def fn(batch):
        return batch.filter(pc.greater(batch["id"], 1)).append_column("n", pa.repeat("x", batch.filter(pc.greater(batch["id"], 1)).num_rows))

    result = arrow_batches(people, fn)
    assert result.columns == ["id", "email", "balance", "n"]
    assert values(result, "id") == [2, 3, 4]


def test_arrow_batches_see_every_row_over_many_batches(spark):
    def double_ids(batch):
        return batch.set_column(0, "id", pc.multiply(batch["id"], 2))

    with conf_scope(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        result = arrow_batches(spark.range(0, 1_000, 1, 5), double_ids).agg(F.sum("id")).first()[0]
    assert result == 2 * sum(range(1_000))


def test_arrow_none_and_empty_drop_the_batch(people):
    assert arrow_batches(people, lambda b: None, people.schema).count() == 0
    assert arrow_batches(people, lambda b: b.slice(0, 0)).count() == 0


def test_arrow_error_names_the_partition(people):
    def fail_on_values(batch):
        if batch.num_rows:
            raise KeyError("boom")
        return batch

    with pytest.raises(Exception, match="batch transform raised on partition"):
        arrow_batches(people, fail_on_values).collect()


def test_arrow_kept_columns_are_hidden_and_put_back(spark):
    df = spark.range(0, 60, 1, 3).withColumn("shard_index", (F.col("id") % 4).cast("int"))

    def fn(batch):
        assert batch.column_names == ["id"]
        return pa.table({"total": pa.array([pc.sum(batch["id"]).as_py() or 0], pa.int64())})

    result = arrow_batches(df, fn, StructType().add("total", LongType()), keep=["shard_index"])
    sums = {r[0]: r[1] for r in result.groupBy("shard_index").agg(F.sum("total")).collect()}
    assert sums == {k: sum(i for i in range(60) if i % 4 == k) for k in range(4)}


def test_arrow_visible_columns_may_be_read_but_not_altered(spark):
    df = small_table(spark, [(1, "a", 0), (2, "b", 0), (3, "a", 1)], "id int, k string, shard_index int")

    def label(batch):
        assert batch.column_names == ["id", "k"]
        return batch.append_column("label", pc.binary_join_element_wise(batch["k"], "x", "-"))

    result = arrow_batches(df, label, keep=["k", "shard_index"], hide=["shard_index"])
    assert result.columns == ["id", "label", "k", "shard_index"]
    assert [tuple(r) for r in result.orderBy("id").collect()] == [(1, "a-x", "a", 0), (2, "b-x", "b", 0), (3, "a-x", "a", 1)]

    def swap(batch):
        return batch.set_column(1, "k", pc.utf8_upper(batch["k"]))

    with pytest.raises(Exception, match="must come back unchanged"):
        arrow_batches(df, swap, keep=["k", "shard_index"], hide=["shard_index"]).collect()


def test_arrow_keeps_null_shards_apart(spark):
    df = small_table(spark, [(1, None), (2, "a"), (3, None)], "id int, k string")
    rows = arrow_batches(df, lambda b: b, keep=["k"]).orderBy("id").collect()
    assert [(r["id"], r["k"]) for r in rows] == [(1, None), (2, "a"), (3, None)]


# ---------------------------------------------------------------------- timestamps

MOMENTS = [
    "2024-03-31 02:30:00.123456",
    "1970-01-01 00:00:00.000999",
    "1969-12-31 23:59:59.999001",
    "1969-12-31 23:59:59.000000",
    "1900-05-05 05:05:05.555555",
    "2024-01-01 00:00:00",
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("unit", ["ms", "s"])
def test_coercion_equals_an_arrow_cast(spark, zone, kind, unit):
    """The result is what casting the column to a coarser Arrow unit would keep."""
    with conf_scope(spark, {"spark.sql.session.timeZone": zone}):
        df = small_table(spark, list(enumerate(MOMENTS)), "id int, t string").withColumn("ts", F.col("t").cast(kind))
        before = df.orderBy("id").toArrow()["ts"]
        after = coerce_timestamps(df, unit).orderBy("id").toArrow()["ts"]
    assert after.type == before.type
    expected = before.cast(pa.timestamp(unit, before.type.tz), safe=False).cast(before.type)
    assert after.to_pylist() == expected.to_pylist()


def test_coercion_off_is_a_no_op(spark, events):
    assert coerce_timestamps(events, None) is events
    assert coerce_timestamps(events, "us") is events
    assert coerce_timestamps(events.select("event_id"), "ms").columns == ["event_id"]
    with pytest.raises(ValueError):
        coerce_timestamps(events, "ns")


def test_coercion_keeps_nulls_and_other_columns(spark):
    df = small_table(spark, [(1, None), (2, datetime(2024, 1, 1, 1, 1, 1, 5678))], "id int, ts timestamp_ntz")
    rows = coerce_timestamps(df, "ms").orderBy("id").collect()
    assert rows[0]["ts"] is None and rows[1]["ts"] == datetime(2024, 1, 1, 1, 1, 1, 5000)


# -------------------------------------------------------------------------- schema


def test_align_casts_pads_and_drops(people):
    target = StructType().add("balance", StringType()).add("score", DoubleType()).add("id", LongType())
    result = align(people, target)
    assert result.schema.simpleString() == "struct<balance:string,score:double,id:bigint>"
    assert values(result, "score") == [None] * 4


def test_all_null_column_keeps_its_type(people):
    typed = people.withColumn("note", F.lit(None).cast("string"))
    assert align(typed, typed.schema).schema["note"].dataType == StringType()


def test_union_by_name(people):
    other = people.select(F.lit("z").alias("extra"), "id")
    result = align_union(people, other)
    assert result.columns == ["id", "email", "balance", "extra"]
    assert result.count() == 8


def test_audit_and_drift(spark, people):
    wide = people.withColumn("tags", F.array("email")).withColumn("m", F.create_map("email", "id"))
    found = {(r["column"], r["finding"]) for r in audit(spark, wide.schema).collect()}
    assert found == {("tags", "nested"), ("m", "nested"), ("m", "map")}
    assert audit(spark, people.schema).count() == 0
    changes = {r["column"]: r["change"] for r in drift(spark, people.schema, cast(wide, {"id": "bigint"}).drop("email").schema).collect()}
    assert changes == {"email": "removed", "tags": "added", "m": "added", "id": "retyped"}
    assert drift(spark, people.schema, people.schema).count() == 0
