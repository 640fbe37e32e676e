"""Registered queries: row transforms and schema rules."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from ..functions import (
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
from ..operators import footers, landed_schemas, write_export
from ..session import scratch_dir
from .tables import table


def _customer(spark, sf_dir):
    return table(spark, sf_dir, "customer")


def tf_redact(spark, sf_dir):
    customers = _customer(spark, sf_dir).withColumn("c_name", F.nullif("c_name", F.lit("Customer#000000007")))
    return redact(customers, "c_name")


def tf_redact_text(spark, sf_dir):
    """Redaction of whole document texts; the untouched length shows nothing else moved."""
    return redact(table(spark, sf_dir, "documents"), "text")


def tf_hash16(spark, sf_dir):
    return short_hash(_customer(spark, sf_dir), "c_name")


def tf_hash16_text(spark, sf_dir):
    """Short hash over whole document texts, whatever their length."""
    return short_hash(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def tf_sha256(spark, sf_dir):
    """NULL and empty segments both end as NULL."""
    segment = F.col("c_mktsegment")
    emptied = F.when(segment == "BUILDING", "").when(segment == "MACHINERY", None).otherwise(segment)
    return full_hash(_customer(spark, sf_dir).withColumn("c_mktsegment", emptied), "c_mktsegment")


def tf_drop(spark, sf_dir):
    return drop(_customer(spark, sf_dir), "c_name", "no_such_column")


def tf_clamp(spark, sf_dir):
    balance = F.nullif("c_acctbal", F.lit(0.0))
    missing = F.when(F.col("c_custkey") % 10 == 0, None).otherwise(balance)
    return clamp(_customer(spark, sf_dir).withColumn("c_acctbal", missing), "c_acctbal")


def tf_scale(spark, sf_dir):
    return derive(_customer(spark, sf_dir), "doubled", "c_acctbal * 2")


def tf_rename(spark, sf_dir):
    return rename(_customer(spark, sf_dir), {"c_custkey": "id", "c_name": "email"})


def tf_chain(spark, sf_dir):
    return chain(
        _customer(spark, sf_dir),
        partial(short_hash, column="c_name"),
        partial(full_hash, column="c_mktsegment"),
        partial(clamp, column="c_acctbal"),
        lambda df: drop(df, "c_nationkey"),
    )


def tf_cast(spark, sf_dir):
    """Strict casts of numbers, and a lenient one of text that mostly is no number."""
    orders = table(spark, sf_dir, "orders")
    strict = cast(orders, {"o_orderkey": "string", "o_custkey": "int"})
    lenient = strict.withColumn("priority_digit", F.substring("o_orderpriority", 1, 2))
    lenient = lenient.withColumn("priority_digit", F.regexp_replace("priority_digit", "[24]-", "$0x"))
    lenient = lenient.withColumn("priority_digit", F.regexp_replace("priority_digit", "-$", ""))
    return cast(lenient, {"priority_digit": "int"}, lenient=True)


def _score(batch: pa.Table) -> pa.Table:
    """Keep the larger values and add a scaled column, on a whole Arrow batch."""
    batch = batch.filter(pc.greater(batch["value"], 25.0))
    batch = batch.append_column("scaled", pc.multiply(batch["value"], 2.0))
    return batch.drop_columns(["props"])


def tf_arrow(spark, sf_dir):
    return arrow_batches(table(spark, sf_dir, "events"), _score)


def tf_drop_all(spark, sf_dir):
    return arrow_batches(table(spark, sf_dir, "events"), lambda batch: batch.slice(0, 0))


def ts_coerce_ms(spark, sf_dir):
    return coerce_timestamps(table(spark, sf_dir, "events"), "ms")


def ts_coerce_s(spark, sf_dir):
    return coerce_timestamps(table(spark, sf_dir, "events"), "s")


def ts_coerce_early(spark, sf_dir):
    """Times before 1970 are cut towards the epoch, as the later ones are."""
    events = table(spark, sf_dir, "events")
    shifted = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL '60' YEAR"))
    return coerce_timestamps(shifted, "ms").select("event_id", "ts")


ALIGNED = (
    StructType()
    .add("s_suppkey", StringType())
    .add("s_name", StringType())
    .add("s_rating", DoubleType())
    .add("s_nationkey", LongType())
)


def align_schema(spark, sf_dir):
    """Cast a key, widen another, add a missing column, drop one that is not wanted."""
    return align(table(spark, sf_dir, "supplier"), ALIGNED)


def align_two(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    customers = table(spark, sf_dir, "customer").selectExpr("c_name AS name", "c_custkey AS id", "c_mktsegment AS segment")
    return align_union(suppliers, customers)


def schema_audit(spark, sf_dir):
    """An export of embeddings with nested columns added: what its files hold that a reader may trip over."""
    embeddings = table(spark, sf_dir, "embeddings")
    wide = embeddings.withColumns(
        {
            "pair": F.struct("vec_id", "label"),
            "lookup": F.create_map(F.lit("label"), "label"),
            "span": F.expr("INTERVAL '1' DAY"),
        }
    )
    written = write_export(wide, scratch_dir(spark, "schema_audit"))
    return _audited(spark, written)


def _audited(spark, written):
    ((schema, _),) = landed_schemas(spark, written.path)
    counted = footers(spark, written.path).dropDuplicates(["uri", "row_group"]).agg(F.sum("group_rows")).scalar()
    return audit(spark, schema).withColumn("rows", counted)


def schema_audit_plain(spark, sf_dir):
    """An export of lineitem has nothing to trip over."""
    return _audited(spark, write_export(table(spark, sf_dir, "lineitem"), scratch_dir(spark, "schema_audit_plain")))


def schema_drift(spark, sf_dir):
    """An orders export against a later one, by the schemas that their files hold: a column dropped, one
    added, one retyped, and one field of a struct inside an array changed; with the rows on both sides."""
    orders = table(spark, sf_dir, "orders")
    status = lambda kind: F.array(F.struct(F.col("o_orderstatus").alias("code"), F.length("o_orderstatus").cast(kind).alias("size")))
    before = orders.withColumn("history", status("int"))
    after = orders.drop("o_orderpriority").withColumns(
        {"o_comment": F.lit(""), "o_custkey": F.col("o_custkey").cast(IntegerType()), "history": status("bigint")}
    )
    schemas, counts = [], []
    for label, df in (("before", before), ("after", after)):
        written = write_export(df, scratch_dir(spark, f"schema_drift_{label}"))
        schemas += [schema for schema, _ in landed_schemas(spark, written.path)]
        groups = footers(spark, written.path).dropDuplicates(["uri", "row_group"])
        counts.append(groups.agg(F.sum("group_rows")).scalar())
    return drift(spark, *schemas).withColumns({"before_rows": counts[0], "after_rows": counts[1]})


QUERIES = {
    "tf_redact": tf_redact,
    "tf_redact_text": tf_redact_text,
    "tf_hash16": tf_hash16,
    "tf_hash16_text": tf_hash16_text,
    "tf_sha256": tf_sha256,
    "tf_drop": tf_drop,
    "tf_clamp": tf_clamp,
    "tf_scale": tf_scale,
    "tf_rename": tf_rename,
    "tf_chain": tf_chain,
    "tf_cast": tf_cast,
    "tf_arrow": tf_arrow,
    "tf_drop_all": tf_drop_all,
    "ts_coerce_ms": ts_coerce_ms,
    "ts_coerce_s": ts_coerce_s,
    "ts_coerce_early": ts_coerce_early,
    "align_schema": align_schema,
    "align_union": align_two,
    "schema_audit": schema_audit,
    "schema_audit_plain": schema_audit_plain,
    "schema_drift": schema_drift,
}

ORACLE = {
    "tf_redact": "SELECT c_custkey, '<redacted>' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "tf_redact_text": "SELECT doc_id, '<redacted>' AS text, lang, source, n_chars FROM documents",
    "tf_hash16": """
        SELECT c_custkey, sha256(c_name)[1:16] || '@hashed' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
    "tf_hash16_text": "SELECT doc_id, sha256(text)[1:16] || '@hashed' AS text FROM documents",
    "tf_sha256": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE sha256(c_mktsegment) END AS c_mktsegment
        FROM customer
    """,
    "tf_drop": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "tf_clamp": """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE greatest(c_acctbal, 0.0) END AS c_acctbal, c_mktsegment
        FROM customer
    """,
    "tf_scale": "SELECT *, c_acctbal * 2 AS doubled FROM customer",
    "tf_rename": "SELECT c_custkey AS id, c_name AS email, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "tf_chain": """
        SELECT c_custkey, sha256(c_name)[1:16] || '@hashed' AS c_name, greatest(c_acctbal, 0.0) AS c_acctbal,
               sha256(c_mktsegment) AS c_mktsegment
        FROM customer
    """,
    "tf_cast": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               CASE WHEN o_orderpriority[1:1] IN ('2', '4') THEN NULL
                    ELSE CAST(o_orderpriority[1:1] AS INTEGER) END AS priority_digit
        FROM orders
    """,
    "tf_arrow": """
        SELECT event_id, ts, user_id, event_type, value, value * 2.0 AS scaled FROM events WHERE value > 25.0
    """,
    "tf_drop_all": "SELECT * FROM events WHERE 1 = 0",
    "ts_coerce_ms": """
        SELECT event_id, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS ts, user_id, event_type, value, props
        FROM events
    """,
    "ts_coerce_s": """
        SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events
    """,
    "ts_coerce_early": """
        SELECT event_id, make_timestamp(epoch_us(ts - INTERVAL 60 YEAR) // 1000 * 1000) AS ts FROM events
    """,
    "align_schema": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_rating,
               CAST(s_nationkey AS BIGINT) AS s_nationkey
        FROM supplier
    """,
    "align_union": """
        SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
        UNION ALL
        SELECT c_custkey, c_name, CAST(NULL AS DOUBLE), c_mktsegment FROM customer
    """,
    "schema_audit": """
        SELECT *, CAST((SELECT COUNT(*) FROM embeddings) AS BIGINT) AS rows FROM (VALUES
          ('embedding', 'array<float>', 'nested'), ('pair', 'struct<vec_id:bigint,label:int>', 'nested'),
          ('lookup', 'map<string,int>', 'nested'), ('lookup', 'map<string,int>', 'map'),
          ('span', 'interval day', 'interval')
        ) AS t("column", "type", finding)
    """,
    "schema_audit_plain": """
        SELECT 'a' AS "column", 'b' AS "type", 'c' AS finding, COUNT(*) AS rows FROM lineitem HAVING COUNT(*) < 0
    """,
    "schema_drift": """
        SELECT t.*, n AS before_rows, n AS after_rows FROM (VALUES
          ('o_orderpriority', 'string', NULL, 'removed'), ('o_comment', NULL, 'string', 'added'),
          ('o_custkey', 'bigint', 'int', 'retyped'), ('history.element.size', 'int', 'bigint', 'retyped')
        ) AS t("column", before_type, after_type, change), (SELECT COUNT(*) AS n FROM orders)
    """,
}
