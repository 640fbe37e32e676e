"""Operators on document texts against brute force."""

import glob
import os
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from exportkit import session
from exportkit.llm import quality, simhash, substrings, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sort(rows):
    return sorted(rows, key=repr)


# --- quality rules


def quality_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_quality_counts(request, table):
    df = request.getfixturevalue(table)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = [tuple(r) for r in quality.judge(df).select(*columns).collect()]
    assert sort(got) == sort([(i, *quality_counts(t)) for i, t in pairs(df)])


def test_quality_verdicts(spark):
    clean = "This is a proper sentence of a clean document. It goes on for a while, as such texts do."
    menu = "Home | News | Sport | Contact | Imprint | More"
    texts = {
        1: "\n".join([clean, "Another line says something else and ends well.", "Read more"]),
        2: "\n".join([clean, menu, menu + " | A", menu + " | B", menu + " | C", menu + " | D"]),
        3: clean + "\n" + "All rights reserved.\n",
        4: "too short to keep.",
        5: "\n".join(f"W{i} stop### here*** and### there$$$ noise%%% again&&& x###" for i in range(20)),
        6: None,
        7: "",
    }
    rows = quality.judge(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    out = {r["doc_id"]: r for r in rows}
    assert {i: r["kept"] for i, r in out.items()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: False}
    assert out[1]["cleaned_text"] == "\n".join(texts[1].split("\n")[:2])
    assert out[3]["cleaned_text"] == clean + "\n"
    assert out[6]["cleaned_text"] is None and out[7]["cleaned_text"] == ""


def test_quality_is_native_and_without_shuffle(documents):
    plan = quality.judge(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


# --- SimHash


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = list(parent)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    return {f: find(f) for f in known}


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_simhash_against_all_pairs(request, table):
    rows = [(i, brute_fingerprint(t)) for i, t in pairs(request.getfixturevalue(table))]
    roots = brute_components({f for _, f in rows})
    first = {}
    for i, f in rows:
        if i is not None:
            first[roots[f]] = min(i, first.get(roots[f], i))
    got = simhash.near_duplicates(request.getfixturevalue(table)).collect()
    expected = [(i, f, first.get(roots[f])) for i, f in rows]
    assert sort((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == sort(expected)


def test_simhash_links_at_every_distance(spark):
    random = np.random.default_rng(5)
    prints = []
    for _ in range(60):
        base = int(random.integers(0, 1 << 63)) * 2 + int(random.integers(0, 2))
        prints.append(base)
        for distance in (1, 2, 3, 4, 5):
            bits = random.choice(64, distance, replace=False)
            prints.append(base ^ sum(1 << int(b) for b in bits))
    chain = prints[0]
    for bit in range(0, 60, 3):
        chain ^= 7 << bit
        prints.append(chain)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in set(prints)]
    nodes = spark.createDataFrame(signed, "fp long")
    from exportkit.llm.components import components

    near = simhash.near_on_a_half(nodes)
    found = {r["node"] % (1 << 64): r["root"] for r in components(simhash.links(near), "test-links").collect()}
    roots = brute_components(set(prints))
    groups = {}
    for p in set(prints):
        groups.setdefault(roots[p], set()).add(p)
    got = {}
    for p in set(prints):
        got.setdefault(found.get(p, p - (1 << 64) if p >> 63 else p), set()).add(p)
    assert sort(map(sorted, groups.values())) == sort(map(sorted, got.values()))


def test_keep_first_keeps_one_of_each_group(odd):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    found = simhash.near_duplicates(odd).collect()
    expected = sort(r["doc_id"] for r in found if r["doc_id"] == r["component_id"])
    assert sort(r["doc_id"] for r in kept.collect()) == expected
    assert {r["component_id"] for r in found} == set(expected)


def test_repeated_rows_leave_the_pipeline_once(spark):
    prose = lambda seed: " ".join(f"w{(seed * 7919 + i * i) % 9973}" for i in range(60))
    ids = [1, 1, 1, None, None, 3, 3, None, 5, 6]
    texts = [prose(s) for s in (1, 1, 1, 2, 2, 3, 4, 5, 5, 6)]
    rows = [(i, t, f"s{n}") for n, (i, t) in enumerate(zip(ids, texts))] + [(8, "", "s"), (8, None, "s"), (8, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(rows)
    expected = [(1, prose(1)), (None, prose(2)), (3, prose(3)), (3, prose(4)), (5, prose(5)), (6, prose(6))]
    found = pairs(suffixes.deduplicate(kept, carry=True).select("doc_id", F.col("kept_text").alias("text")))
    assert sort(row for row in found if row[0] != 8) == sort(expected) and len(found) == 7
    with_map = simhash.keep_first(docs.withColumn("m", F.create_map("source", "source")))
    assert with_map.count() == 7


# --- duplicate byte strings


def brute_bytes(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        starts = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(d) else 0
        yield i, len(d), int(gone.sum()), starts, bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])


@pytest.mark.parametrize("table, rules", [
    ("odd", suffixes.SuffixRules()),
    ("odd", suffixes.SuffixRules(length=40, gram=8, batches=7)),
    ("documents", suffixes.SuffixRules()),
])
def test_suffixes_against_brute_force(request, table, rules):
    df = request.getfixturevalue(table)
    got = [
        (r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"]))
        for r in suffixes.deduplicate(df, rules).collect()
    ]
    assert sort(got) == sort(brute_bytes(pairs(df), rules.length))


@pytest.mark.parametrize("at_once, hot", [(3, 10**9), (8192, 1)])
def test_suffix_borders_in_parts(odd, monkeypatch, at_once, hot):
    monkeypatch.setattr(suffixes, "TASK_CONTEXTS", at_once)
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", hot)
    rules = suffixes.SuffixRules(length=60, gram=8)
    got = [(r["doc_id"], bytes(r["kept"])) for r in suffixes.deduplicate(odd, rules).collect()]
    assert sort(got) == sort((row[0], row[4]) for row in brute_bytes(pairs(odd), 60))


def test_index_family_levels(spark):
    family = suffixes.IndexFamily(spark, "test-family")
    ranks, seen = [], []
    for batch in range(6):
        found = family.add(spark.createDataFrame([(k,) for k in range(batch, 40, batch + 1)], "key long"))
        seen.append({r["key"] for r in found.collect()})
        ranks.append([rank for rank, _ in family.levels])
    family.close()
    assert ranks == [[0], [1], [1, 0], [2], [2, 0], [2, 1]]
    before = set()
    for batch in range(6):
        now = set(range(batch, 40, batch + 1))
        assert seen[batch] == now & before
        before |= now


# --- duplicate word windows


def brute_windows(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[p : p + width])
            first[key] = min(i, first.get(key, i))
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - width + 1) if i is not None else ():
            if first[tuple(w[p : p + width])] < i:
                gone[p : p + width] = [True] * width
        yield i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)


@pytest.mark.parametrize("table, rules", [
    ("odd", substrings.WindowRules()),
    ("odd", substrings.WindowRules(window=50)),
    ("odd", substrings.WindowRules(window=3)),
    ("documents", substrings.WindowRules()),
])
def test_windows_against_brute_force(request, table, rules):
    df = request.getfixturevalue(table)
    got = [
        (r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), bytes(r["kept"]).decode())
        for r in substrings.deduplicate(df, rules).collect()
    ]
    assert sort(got) == sort(brute_windows(pairs(df), rules.window))


def test_ladder():
    assert substrings.WindowRules().ladder() == [6]
    assert substrings.WindowRules(window=50).ladder() == [6, 12, 25]


# --- empty tables


@pytest.mark.parametrize("operator", [quality.judge, simhash.near_duplicates, suffixes.deduplicate, substrings.deduplicate])
def test_empty_table(empty, operator):
    assert operator(empty).count() == 0


def test_carried_rows_come_back_whole(odd):
    for operator in (quality.judge, suffixes.deduplicate):
        back = operator(odd, carry=True).select("carried.*")
        assert sort(back.collect()) == sort(odd.drop("text").collect())
    assert odd.agg(F.count("*")).first()[0] == len(odd.collect())


# --- files of small tables


def _files(spark, folder, label):
    return [len([f for f in os.listdir(p) if f.endswith(".parquet")]) for p in glob.glob(f"{folder}/exportkit/{label}-*")]


def test_small_tables_are_not_cut_into_a_file_per_partition(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    tables = {t.name for t in spark.catalog.listTables()}
    with session.conf_scope(spark, settings):
        suffixes.deduplicate(odd, suffixes.SuffixRules(length=60, gram=8)).collect()
        simhash.near_duplicates(odd).collect()
    most = spark.sparkContext.defaultParallelism
    assert most < 40
    for label in ("suffix-keys", "suffix-contexts", "suffix-borders", "suffix-border-spans", "suffix-spans"):
        assert max(_files(spark, tmp_path, label)) <= most, label
    for label in ("simhash-halves", "simhash-near", "simhash-meets", "simhash-links"):
        assert max(_files(spark, tmp_path, label)) <= most, label
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_suffix_arrays_are_scanned_as_they_are_dealt(spark):
    settings = {"spark.sql.shuffle.partitions": "4", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    settings["spark.sql.adaptive.autoBroadcastJoinThreshold"] = "-1"
    with session.conf_scope(spark, settings):
        family = suffixes.IndexFamily(spark, "test-family")
        found = [family.add(spark.range(n, 300, n).repartition(3).select(F.col("id").alias("key"))) for n in (2, 3, 5)]
        rows = sorted(r["key"] for r in found[2].collect())
        plan = found[2]._jdf.queryExecution().executedPlan().toString()
        kept = len(spark.sparkContext._jsc.getPersistentRDDs())
        family.close()
    assert rows == [k for k in range(5, 300, 5) if k % 2 == 0 or k % 3 == 0]
    scans = [line.lstrip(" :+-") for line in plan.splitlines() if len(line) - len(line.lstrip(" :+-")) < 22]
    assert any("SortMergeJoin" in line for line in scans)
    assert not any(line.startswith("Exchange") for line in scans)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) < kept
