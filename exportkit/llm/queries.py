"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exportkit.session import delete_path, scratch_dir

from . import (
    collocations, neighbours, packing, pieces, prefixtrie, quality, rulefit, secretscan, simhash, substrings, suffixes,
    urls, warc,
)
from .common import rows_through_arrow, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).drop("ids")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode with dropout, decode again, and digest both."""
    decoded = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(_table(spark, sf_dir, "documents")).select("doc_id", "spans")
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    archives = written(warc.write_archives(_table(spark, sf_dir, "pages"), folder), "warc-list")
    records = warc.read_archives(spark, folder, archives)
    records = written(records.drop("url", "payload"), "warc-records")
    warc.require_all(records, archives)
    delete_path(spark, folder)
    return records


def _sha(kept) -> str:
    return hashlib.sha256(kept.as_buffer()).hexdigest()


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def each(columns):
        for doc_id, n, spans, kept in zip(*(columns[c] for c in ("doc_id", "n_bytes", "removed", "kept"))):
            spans = spans.as_py()
            yield doc_id.as_py(), n.as_py(), sum(s["end"] - s["start"] for s in spans), len(spans), _sha(kept)

    found = suffixes.deduplicate(_table(spark, sf_dir, "documents"))
    return rows_through_arrow(found, each, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    def each(columns):
        for doc_id, n, spans, kept in zip(*(columns[c] for c in ("doc_id", "n_words", "removed", "kept"))):
            yield doc_id.as_py(), n.as_py(), sum(s["end"] - s["start"] for s in spans.as_py()), _sha(kept)

    found = substrings.deduplicate(_table(spark, sf_dir, "documents"))
    return rows_through_arrow(found, each, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefixtrie.conversations(_table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(prefixtrie.rebuilt(convs))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulefit.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules, op2_packing, op3_simhash, op4_sentencepiece, op5_neighbours, op6_secrets, op7_warc,
        op8_suffixes, op9_urls, op10_substrings, op11_prefix_trie, op12_collocations, op13_quality_classifier,
    )
}

_RULES = quality.LineRules()
_WORD = r"[^\x20\x09-\x0D]+"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


_LINE_FAILS = f"""(
    ({_count("l", _WORD)} < {_RULES.short_line} AND NOT regexp_matches(l, '{_sql(_RULES.sentence_end)}')
        AND NOT regexp_matches(l, '{_sql(_RULES.code)}'))
    OR {_count("l", _sql(_RULES.symbol_run))} * 100 > {_count("l", _WORD)} * {_RULES.max_symbol_run_pct}
    OR ({_count("l", _sql(_RULES.separator))} >= {_RULES.max_separators}
        AND {_count("l", _sql(_RULES.separator))} * 4 >= {_count("l", _WORD)})
    OR regexp_matches(l, '{_sql(_RULES.navigation)}')
    OR ({_count("l", _sql(_RULES.boilerplate))} > 0
        AND {_count("l", _WORD)} <= {_RULES.max_words_per_phrase} * {_count("l", _sql(_RULES.boilerplate))}))"""


def quality_sql(table: str = "documents") -> str:
    """DuckDB SQL for the rows of ``quality.judge``, cleaned text included."""
    return f"""
WITH d AS (
    SELECT doc_id, text, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
           string_split(coalesce(text, ''), chr(10)) AS ls
    FROM {table}
),
lines AS (
    SELECT doc_id, text, t, ws, list_filter(ls, lambda l: regexp_matches(l, '{_WORD}')) AS full_lines,
           array_to_string(list_filter(ls, lambda l: NOT regexp_matches(l, '{_WORD}') OR NOT {_LINE_FAILS}), chr(10)) AS cleaned
    FROM d
),
windows AS (
    SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
),
repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
),
covered AS (
    SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM repeated) GROUP BY doc_id
),
counts AS (
    SELECT doc_id, text, cleaned, len(ws)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
           {_count("t", "[#*$%&|<>]")}::BIGINT AS n_symbols,
           (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           length(t) AS n_chars, length(cleaned) AS cleaned_chars
    FROM lines LEFT JOIN covered USING (doc_id)
),
judged AS (
    SELECT *, (n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_pct} * n_words) AS base_failed
    FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND (n_chars - cleaned_chars) * 100 <= {_RULES.max_lost_pct} * n_chars) AS kept
FROM judged
"""


def _base32_of_sha1() -> str:
    digit = lambda place: f"(instr('0123456789abcdef', substr(sha, {place}, 1)) - 1)"
    letters = []
    for i in range(32):
        nibble, inside = divmod(5 * i, 4)
        both = f"({digit(nibble + 1)} * 16 + " + (f"{digit(nibble + 2)})" if nibble < 39 else "0)")
        letters.append(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({both} >> {3 - inside}) & 31)::INTEGER + 1, 1)")
    return " || ".join(letters)


_WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS sha FROM pages),
first AS (SELECT sha, min(page_id) AS first FROM p GROUP BY sha)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_base32_of_sha1()} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN first USING (sha)
"""


def _url_sql() -> str:
    rules = urls.UrlRules()

    def like(glob: str) -> str:
        literal = glob.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%").replace("?", "_")
        return f"('.' || host || path) LIKE '{literal}' ESCAPE '!'"

    fits = [
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}'"
        for _, h, p in sorted(rules.rules, key=lambda r: -len(r[1] + r[2]))
    ]
    verdicts = [f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in rules.rules]
    return f"""
WITH rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS r
    FROM pages
),
parts AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           CASE WHEN contains(r, '/') THEN substr(r, instr(r, '/')) ELSE '' END AS path
    FROM rest
),
ruled AS (SELECT page_id, host, path, CASE {" ".join(fits)} ELSE NULL END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE {" ".join(verdicts)} WHEN {" OR ".join(like(g) for g in rules.block_globs)} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


# CRC-32 of the decimal digits of conv_id: bit by bit, with the reflected polynomial.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda c, b: list_reduce(
        list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT)))
), 4294967295::UBIGINT)"""

_TRIE_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, md5(length(r)::VARCHAR || ':' || r || x)) AS q
    FROM turns GROUP BY conv_id
),
hashed AS (SELECT conv_id, q, ({_CRC} % 4)::BIGINT AS h FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(CASE WHEN b.q IS NULL THEN [] ELSE b.q[1:h] END, c.q[h + 1:]) AS q
    FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
),
prefixes AS (SELECT conv_id, q, d, q[1:d] AS p FROM (SELECT conv_id, q, unnest(range(0, len(q) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].x, '{_WORD}')) END AS own
    FROM prefixes GROUP BY p, d
),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
    SELECT p[1:k] AS p, sum(own) AS saved, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS leaves
    FROM (SELECT n.*, n_children, unnest(range(0, d + 1)) AS k FROM nodes n LEFT JOIN children USING (p)) GROUP BY 1
),
ends AS (SELECT q AS p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM rebuilt GROUP BY q)
SELECT n.conv_id, n.d::BIGINT AS depth, above.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes above ON n.d > 0 AND above.d = n.d - 1 AND above.p = n.p[1:n.d - 1]
LEFT JOIN children ON children.p = n.p JOIN below ON below.p = n.p LEFT JOIN ends ON ends.p = n.p
"""

_PHRASE_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    )
),
f AS (
    SELECT lang, k, phrase, count(*) AS n
    FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM pieces, (VALUES (1), (2), (3)) AS sizes(k)
    )
    GROUP BY lang, k, phrase
),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
cuts AS (
    SELECT c.lang, c.k, c.phrase, a, cut, l.n AS l, r.n AS r,
           (1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(ws[1:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(ws[cut + 1:], ' ')
),
scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
longer AS (
    SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
        UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM candidates WHERE k = 3
    ) GROUP BY lang, phrase
),
ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, encode(s.phrase)) AS rank
    FROM scored s LEFT JOIN longer g USING (lang, phrase)
    WHERE g.a IS NULL OR 100 * g.a < 50 * s.a
),
totals AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op1_quality_rules": quality_sql(),
    "op7_warc": _WARC_SQL,
    "op9_urls": _url_sql(),
    "op11_prefix_trie": _TRIE_SQL,
    "op12_collocations": _PHRASE_SQL,
}
