"""The registered queries and the pipeline, whole, against brute force; long texts and odd rows."""

import base64
import gzip
import hashlib
import io
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_documents import brute_bytes, brute_components, brute_fingerprint, brute_windows
from tokenizers import Tokenizer

import corpus_pipeline
from exportkit.llm import ORACLE, QUERIES, common, packing, pieces, quality, secretscan, simhash, substrings, suffixes, warc

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_simhash": "doc_id fingerprint component_id",
    "op5_neighbours": "query_id rank vec_id score",
    "op6_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op8_suffixes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_urls": "page_id host path rule verdict",
    "op10_substrings": "doc_id n_words n_removed kept_sha256",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_collocations": "lang rank phrase a l r n score",
    "op13_quality_classifier": "doc_id held_out score predicted",
}


def sort(rows):
    return sorted(rows, key=repr)


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# --- registered queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    from check_queries import compare

    db = duckdb.connect()
    for part in ("documents", "pages", "conversations", "labels"):
        db.execute(f"CREATE VIEW {part} AS SELECT * FROM read_parquet('{SMALL}/{part}.parquet')")
    got = QUERIES[name](spark, SMALL).toArrow()
    assert compare(got, db.execute(ORACLE[name]).to_arrow_table()) == ""
    assert set(CONTRACT[name].split()) <= set(got.column_names)


def test_digests_of_packing(spark):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in table(spark, "documents").collect()}
    rows = QUERIES["op2_packing"](spark, SMALL).collect()
    assert set(CONTRACT["op2_packing"].split()) <= set(rows[0].asDict())
    covered = dict.fromkeys(ids, 0)
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] += r["length"]
    assert covered == {i: len(v) for i, v in ids.items()}


def test_digests_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    sha = lambda data: hashlib.sha256(data).hexdigest()
    got = [tuple(r[c] for c in CONTRACT["op8_suffixes"].split()) for r in QUERIES["op8_suffixes"](spark, SMALL).collect()]
    assert sort(got) == sort((*r[:4], sha(r[4])) for r in brute_bytes(rows, 200))
    got = [tuple(r[c] for c in CONTRACT["op10_substrings"].split()) for r in QUERIES["op10_substrings"](spark, SMALL).collect()]
    assert sort(got) == sort((*r[:3], sha(r[3].encode())) for r in brute_windows(rows, 13))
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    roots = brute_components({f for _, f in prints})
    first = {}
    for i, f in prints:
        first[roots[f]] = min(i, first.get(roots[f], i))
    got = [tuple(r) for r in QUERIES["op3_simhash"](spark, SMALL).collect()]
    assert sort(got) == sort((i, f"{f:016x}", first[roots[f]]) for i, f in prints)


def test_digests_of_secrets(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    for r in QUERIES["op6_secrets"](spark, SMALL).collect():
        base = secretscan.base_spans(texts[r["doc_id"]])
        line = ",".join(f"{kind}:{start}:{end}" for start, end, kind in base)
        assert hashlib.sha256(line.encode()).hexdigest() == r["base_sha256"]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == kind for _, _, k in base) for kind in ("assign", "access", "hex")]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_decoded_pieces_and_neighbours(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    for r in QUERIES["op4_sentencepiece"](spark, SMALL).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    rows = QUERIES["op5_neighbours"](spark, SMALL).collect()
    assert list(rows[0].asDict()) == CONTRACT["op5_neighbours"].split() and len(rows) % 20 == 0


# --- line rules


def kept_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["kept"], r["cleaned_text"]) for r in quality.judge(df).collect()}


def test_prose_and_code_survive_the_line_rules(spark):
    long = "The agreement says that all rights reserved by the author stay with the author. " + " ".join(
        f"Then clause {i} speaks of matter {i * 7} and of nothing else." for i in range(8)
    )
    code = "\n".join(["def total(rows):", "    result = 0", "    for row in rows:", "        result += row.price * row.count", "    return result", "print(total(load()))", "x = [1, 2]", "return x"])
    footer = ["Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", "POLÍTICA DE PRIVACIDAD.", "Impressum.", "Startseite", "Accueil", "Menú"]
    prose = " ".join(f"Satz {i} hat {i * 3} Wörter und endet richtig." for i in range(8))
    found = kept_of(spark, [long.strip(), code, "\n".join([prose, *footer])])
    assert found[0] == (True, long.strip())
    assert found[1] == (True, code)
    assert found[2] == (True, prose)


# --- long texts


def test_ten_megabytes_in_one_text(spark):
    text = "".join(f"word{i % 9973} and more of it, line {i}.\n" for i in range(330_000))
    assert len(text) > 10_000_000
    df = spark.createDataFrame([(1, text), (2, "token=abcdefabcdef0123456789 " + text[:400])], "doc_id long, text string")
    judged = {r["doc_id"]: r for r in quality.judge(df).select("doc_id", "n_words", "kept").collect()}
    assert judged[1]["n_words"] == 7 * 330_000
    prints = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(df).collect()}
    assert prints[1] == brute_fingerprint(text)
    spans = {r["doc_id"]: r["spans"] for r in secretscan.scan(df).select("doc_id", "spans").collect()}
    assert spans[1] == [] and len(spans[2]) == 2
    decoded = pieces.decode(pieces.encode(df)).where("doc_id = 1").select(F.md5("text")).first()[0]
    assert decoded == hashlib.md5(text.encode()).hexdigest()
    total = packing.pack(df).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r["n"] == r["all"] for r in total)


def test_a_long_text_repeats_a_passage(spark):
    pick = np.random.default_rng(3)
    words = [f"w{i}" for i in pick.integers(0, 10**9, 300_000)]
    words[200_000:200_100] = words[1_000:1_100]
    rows = [(1, " ".join(words)), (2, " ".join(words[5_000:5_050]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert words[999][-1] != words[199_999][-1] and words[1_100][1] != words[200_100][1]
    passage = len(" ".join(words[1_000:1_100])) + 3  # with the blanks on both sides, and the next word's w
    removed = {r["doc_id"]: sum(s["end"] - s["start"] for s in r["removed"]) for r in suffixes.deduplicate(df).collect()}
    assert removed == {1: 2 * passage + len(rows[1][1]), 2: len(rows[1][1])}
    removed = {r["doc_id"]: sum(s["end"] - s["start"] for s in r["removed"]) for r in substrings.deduplicate(df).collect()}
    assert removed == {1: 0, 2: 50}


def test_parts_of_a_text_have_the_ids_of_the_whole():
    coder = pieces.Encoder(pieces.PieceRules(dropout=0.3))
    text = "some  words é☃ and\nlines " * 500 + " " * 300 + "x" * 900
    whole = coder.encode([(5, text)])[0]
    parts = list(pieces._parts(text, 100))
    assert len(parts) > 50 and "".join(p for p, _ in parts) == " " + text
    found = [[]]
    for part in parts:
        coder._block([(0, 5, *part)], found)
    assert np.array_equal(np.concatenate(found[0]), whole)


# --- archives


def test_archives_of_other_writers_and_seams():
    record = lambda i, body: warc._record(i, "u", body, "response", None, warc.digest(body))
    old = gzip.compress(record(1, b"a").replace(b"WARC/1.1", b"WARC/1.0", 1)) + gzip.compress(record(2, b"b"))
    part = lambda ids: b"".join(members(ids))

    def members(ids, at=0):
        for i in ids:
            yield (made := warc._member(record(i, b"x" * i), at))
            at += len(made)

    for data, ids in ((old, [1, 2]), (part([3, 4]) + part([5, 6, 7]), [3, 4, 5, 6, 7])):
        window = warc._Window(io.BytesIO(data), len(data))
        assert [warc.parse(r)["page_id"] for r in warc.records_of(window, 0, len(data))] == ids
    assert base64.b32encode(hashlib.sha1(b"a").digest()).decode() == warc.digest(b"a")


def test_missing_records_are_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(30)], "page_id long, url string, html string")
    listed = spark.createDataFrame(warc.write_archives(pages, str(tmp_path)).collect())
    records = warc.read_archives(spark, str(tmp_path), listed)
    warc.require_all(records, listed)
    with pytest.raises(ValueError, match="29 of 30"):
        warc.require_all(records.where("page_id <> 4"), listed)


def test_readers_and_balls_are_spread_over_tasks(spark):
    archives = spark.createDataFrame([(f"p{i}", 10, 1) for i in range(40)], "path string, bytes long, records long")
    assert "REPARTITION_BY_NUM" in warc.read_archives(spark, "x", archives)._jdf.queryExecution().executedPlan().toString()
    nodes = spark.createDataFrame([(i,) for i in range(9)], "fp long")
    plan = simhash.links(nodes)._jdf.queryExecution().analyzed().toString()
    assert "Repartition" in plan and "[fp#" in plan


# --- pipeline


def brute_pipeline(rows, judged):
    """Texts that reach packing: kept and cleaned, one of each component, repeats cut, secrets marked."""
    texts = [(i, judged[i][1]) for i, _ in rows if judged[i][0]]
    prints = [(i, brute_fingerprint(t)) for i, t in texts]
    roots = brute_components({f for _, f in prints})
    first = {}
    for i, f in prints:
        first[roots[f]] = min(i, first.get(roots[f], i))
    texts = [(i, t) for (i, t), (_, f) in zip(texts, prints) if first[roots[f]] == i]
    cut = [(r[0], r[4].decode(errors="ignore")) for r in brute_bytes(texts, 200)]
    return {i: secretscan.redact(t, secretscan.scan_text(t)) for i, t in cut}


def test_pipeline_against_brute_force(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    judged = {r["doc_id"]: (r["kept"], r["cleaned_text"]) for r in quality.judge(docs).collect()}
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: [*coder.encode(t, add_special_tokens=False).ids, 1] for i, t in brute_pipeline(rows, judged).items()}
    got = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got.setdefault(r["doc_id"], {})[r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    assert {i: sum((p[s] for s in sorted(p)), []) for i, p in got.items()} == expected
    assert 20 < len(expected) < len(rows)


CLASH = "key long, context long, tag long, fp long, spans string, kept string, carried string, ids binary, n_chars long, lang string, source string"


def stages(spark, docs):
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SMALL), "pipeline-test")
        assert docs.columns == columns, name
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_odd_rows_through_all_stages(spark):
    words = [hashlib.md5(str(i).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:7] for i in range(900)]
    body = lambda n: " ".join(f"{' '.join(words[n * 100 + i * 10 :][:10])}." for i in range(9))
    texts = [(1, body(1)), (1, body(1)), (None, body(2)), (None, None), (3, None), (4, ""), (5, "short"), (6, body(3) + " token=abcdefabcdef0123456789."), (7, body(1)), (8, body(5) + body(6) * 2)]
    rows = [(i, t, 1, 2, 3, 4, "s", "k", "c", b"x", len(t or ""), None, "src") for i, t in texts]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {CLASH}")
    left, packed = stages(spark, docs)
    by_id = {r["doc_id"]: r["text"] for r in left.collect()}
    assert set(by_id) == {1, None, 6}, by_id.keys()
    assert "[SECRET]" in by_id[6] and "abcdefabcdef" not in by_id[6]
    assert left.where(F.col("n_chars") != F.char_length("text")).count() == 0
    assert {r["doc_id"] for r in packed} == set(by_id)


def test_empty_table_through_all_stages(spark):
    left, packed = stages(spark, spark.createDataFrame([], f"doc_id long, text string, {CLASH}"))
    assert left.count() == 0 and packed == []


def test_entry_file_stands_without_the_add_on():
    """The guard takes any import error of the operators, such as a library that is not there."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = "import sys; sys.modules['tiktoken'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
