"""Conversation prefixes, phrases and the rule ensemble, against brute force and held-out rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from exportkit.llm import collocations, prefixtrie, rulefit

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sort(rows):
    return sorted(rows, key=repr)


# --- prefix trie


def ordered(rows):
    """``conv_id`` -> list of (role, text), from rows of conv_id, turn, role, text."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}


def rebuild(own):
    back = {}
    for conv in own:
        head = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(math.fmod(conv, 20))
        back[conv] = own.get(base, [])[:head] + own[conv][head:]
    return back


def brute_trie(sequences):
    members, ends, children = {}, {}, {}
    for conv, turns in sequences.items():
        turns = tuple(turns)
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
        ends.setdefault(turns, []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in below) or 1
        saved[node] = own + sum(saved[c] for c in below)
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children.get(n, [])),
            leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n in members
    )


def trie_rows(df, limit, again=True):
    convs = prefixtrie.conversations(df)
    return sorted(map(tuple, prefixtrie.trie(prefixtrie.rebuilt(convs) if again else convs, limit).collect()))


@pytest.mark.parametrize("limit", [prefixtrie.CONTAINER_TURNS, 30])
def test_trie_of_the_table(spark, limit):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = map(tuple, df.select("conv_id", "turn", "role", "text").collect())
    assert trie_rows(df, limit) == brute_trie(rebuild(ordered(rows)))


@pytest.fixture(scope="module")
def odd_turns(spark):
    pick = random.Random(6)
    words = ["yes", "no", "why not", "", None, "é ☃ x", "a\tb\nc"]
    rows = []
    for conv in [*range(-45, 70), None, 1000, 10**15]:
        for turn in range(pick.choice([1, 1, 2, 3, 5])):
            rows.append((conv, pick.choice([turn, turn, 0, None]), pick.choice(["user", "user", None, ""]), pick.choice(words)))
    for conv in range(200, 330):  # copies of one conversation
        rows += [(conv, t, "user", f"turn {t}") for t in range(6)]
    for conv in range(340, 343):  # long ones that part late
        rows += [(conv, t, "user", "same" if t < 700 else f"{conv}") for t in range(720)]
    rows += [(7, 0, "user", "yes")] * 3  # repeated rows
    clash = [(*r, "head", 1, "path", [1]) for r in rows]
    names = "conv_id long, turn long, role string, text string, head string, depth int, path string, turns array<int>"
    return rows, spark.createDataFrame(clash, names).repartition(5)


@pytest.mark.parametrize("limit", [prefixtrie.CONTAINER_TURNS, 200])
def test_trie_on_odd_rows(odd_turns, limit):
    rows, df = odd_turns
    assert trie_rows(df, limit) == brute_trie(rebuild(ordered(rows)))
    assert trie_rows(df, limit, again=False) == brute_trie(ordered(rows))


def test_trie_with_conversations_that_lose_all_turns(spark):
    """Of one conversation only the turns exist that its base would replace, and there is no base: it ends at
    the root."""
    one = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(one, t, "user", "x") for t in range(zlib.crc32(str(one).encode()) % 4)] + [(40, t, "user", "x") for t in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie_rows(df, 100)
    assert got == brute_trie(rebuild(ordered(rows)))
    assert got[0][:4] == (one, 0, None, 2) and got[0][7] == hashlib.sha256(str(one).encode()).hexdigest()


def test_trie_with_one_long_text_and_no_rows(spark):
    rows = [(1, 0, "user", "word " * 2_000_000), (2, 0, "user", "word " * 2_000_000), (3, 0, "user", "other")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(df, 10, again=False) == brute_trie(ordered(rows))
    assert trie_rows(df.limit(0), 10) == []


def test_ends_are_hashed_in_parts(spark):
    """A group of copies larger than one part of ids."""
    many = 3 * prefixtrie.IDS_AT_ONCE + 5
    df = spark.range(many).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("t").alias("text"))
    got = trie_rows(df.repartition(7), 1 << 16, again=False)
    assert got[1][7] == hashlib.sha256(",".join(map(str, range(many))).encode()).hexdigest()


# --- phrases


def brute_phrases(rows, rules):
    counts, totals, out = {}, Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(rb"[.,;:!?\n-\r]", (text or "").encode().lower()):
            words = [w for w in re.split(rb"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                own.update(zip(*(words[i:] for i in range(k))))
    for lang, own in counts.items():
        longer = Counter()
        for phrase, a in own.items():
            if len(phrase) == 3 and a >= rules.min_count:
                for part in (phrase[:2], phrase[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for phrase, a in own.items():
            if len(phrase) > 1 and a >= rules.min_count and not (longer[phrase] and 100 * longer[phrase] >= rules.cover_pct * a):
                score, k = min((10**6 * a * a // (own[phrase[:k]] * own[phrase[k:]]), k) for k in range(1, len(phrase)))
                found.append((-score, -a, b" ".join(phrase), own[phrase[:k]], own[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: rules.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(df, rules):
    return sorted(map(tuple, collocations.mine(df, rules).collect()))


@pytest.mark.parametrize("rules", [
    collocations.PhraseRules(min_count=3),
    collocations.PhraseRules(min_count=3, top=25, first=30),
    collocations.PhraseRules(min_count=2, top=3, first=1, cover_pct=90),
])
def test_phrases_of_the_table(documents, rules):
    expected = brute_phrases(documents.select("lang", "text").collect(), rules)
    assert expected and mined(documents, rules) == expected


def test_phrases_on_odd_rows(spark):
    pick = random.Random(9)
    kinds = ["Be", "be", "é", "É", "x\x1cy", " ", "z\x85", "İ", "#", "ss", "ß"]
    gaps = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", " \r", "!?"]
    rows = []
    for i in range(400):
        text = "".join(pick.choice(kinds[: 4 + i % 8]) + pick.choice(gaps if pick.random() < 0.3 else gaps[:3]) for _ in range(30))
        rows.append((pick.choice([None, "und", "en", ""]), text))
    rows += [(None, None), ("en", ""), ("xx", None), ("yy", " \t"), ("en", "alone")] + [rows[0]] * 30
    clash = [(*r, 1, "w") for r in rows]
    df = spark.createDataFrame(clash, "lang string, text string, n long, word string").repartition(4)
    for rules in (collocations.PhraseRules(), collocations.PhraseRules(top=7, first=2)):
        assert mined(df, rules) == brute_phrases(rows, rules)
    assert mined(df.limit(0), rules) == []


def test_phrases_of_one_long_text(spark):
    """Ten megabytes in one text, most of it one piece, so that parts end inside pieces."""
    pick = random.Random(2)
    words = [f"w{pick.randrange(300)}" for _ in range(2_000_000)]
    text = " ".join(words[:1_900_000]) + ". " + ", ".join(words[1_900_000:])
    rules = collocations.PhraseRules(min_count=20, top=50)
    df = spark.createDataFrame([("en", text), (None, "w1 w2 w3 " * 30)], "lang string, text string")
    assert mined(df, rules) == brute_phrases([("en", text), (None, "w1 w2 w3 " * 30)], rules)


@pytest.mark.parametrize("size", [5, 17, 64, 1000])
def test_segments_count_every_phrase_once(size):
    pick = random.Random(size)
    gaps = [b" ", b" ", b" ", b"\t ", b". ", b"\n"]
    for trial in range(30):
        few = gaps if trial % 3 else gaps[:2]
        body = b"".join(f"w{pick.randrange(9)}".encode() * pick.choice([1, 1, 9]) + pick.choice(few) for _ in range(200))
        for length in (1, 2, 3):
            expected, got = Counter(), Counter()
            for piece in re.split(rb"[.,;:!?\n-\r]", body):
                words = piece.split()
                expected.update(zip(*(words[i:] for i in range(length))))
            for part, lead in collocations.segments(body, size):
                place = 0
                for piece in re.split(rb"[.,;:!?\n-\r]", part):
                    words = piece.split()
                    for i in range(len(words) - length + 1):
                        if place + i + length > lead:
                            got[tuple(words[i : i + length])] += 1
                    place += len(words)
            assert got == expected


def test_ratios_are_exact(spark):
    pick = random.Random(1)
    rows = []
    for _ in range(500):
        a = pick.randrange(1, 10 ** pick.choice([2, 7, 13]))
        rows.append((a, pick.randrange(a, 10**13), pick.randrange(a, 10**13)))
    rows += [(10**13, 10**13, 10**13), (10**13 - 1, 10**13, 10**13 - 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("a", "l", "r", collocations.exact_ratio(F.col("a"), (F.col("l"), F.col("r"))).alias("s"))
    assert [r["s"] for r in got.collect()] == [10**6 * a * a // (b * c) for a, b, c in rows]


def test_sieve_misses_nothing(spark):
    words = [f"word {i}" for i in range(3000)]
    sieve = collocations.sieve_of(spark.createDataFrame([(w,) for w in words], "word string"), "word")
    assert collocations._inside(sieve, collocations.word_hashes(words)).all()
    others = collocations.word_hashes([f"other {i}" for i in range(3000)])
    assert collocations._inside(sieve, others).mean() < 0.01


def test_pair_hashes_know_order_and_language():
    a, b, en, de = (collocations.word_hashes([w]) for w in ("a", "b", "en", "de"))
    found = {int(collocations.pair_hashes(*p)[0]) for p in ((en, a, b), (en, b, a), (de, a, b), (de, b, a), (en, a, a))}
    assert len(found) == 5


# --- rule ensemble


def test_classifier_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = rulefit.classify(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    unseen = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert len(unseen) > 80
    for quality in (0, 1):
        hits = [r["predicted"] == quality for r in unseen if r["quality"] == quality]
        assert np.mean(hits) >= 0.95


def test_held_out_labels_change_nothing(spark):
    """Turned labels of held-out rows, and other sources and languages, leave every score as it was."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(rulefit.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    others = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "words": F.lit(3)})
    first = sorted(map(tuple, rulefit.classify(docs, labels).collect()))
    assert sorted(map(tuple, rulefit.classify(others, turned).collect())) == first


def test_classifier_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 1), (4, 0), (8, 0), (9, 0), (10, None), (11, 7), (None, 1)], "doc_id long, quality int")
    rows = rulefit.classify(odd, labels).collect()
    assert sort(r["doc_id"] for r in rows) == sort(r["doc_id"] for r in odd.select("doc_id").collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    one = rulefit.classify(odd, labels.where("quality = 1 and doc_id = 1")).select("score").distinct().collect()
    assert len(one) == 1 and 0.5 < one[0]["score"] < 1
    none = rulefit.classify(odd, labels.limit(0)).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert rulefit.classify(empty, labels).count() == 0


def test_classifier_on_a_long_text(spark):
    text = "This is a long but proper text. " * 320_000
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    long, none = (r for r in rulefit.counts(docs).orderBy("doc_id").collect())
    assert long["chars"] == len(text) and long["words"] == 7 * 320_000 and long["kinds"] == 7
    assert {none[c] for c in none.asDict() if c not in ("doc_id", "lines", "line_kinds")} == {0.0}


def test_rules_are_plain_columns(spark):
    """A rule ensemble scored by hand, and its plan."""
    rules = (
        (rulefit.Rule((("symbols", 0.1, None),)), -3.0),
        (rulefit.Rule((("digits", None, 0.5), ("log_words", 1.0, 4.0))), 2.0),
    )
    model = rulefit.RuleModel(rules, 0.25)
    docs = spark.createDataFrame([(1, "### ##"), (2, "some plain words in a row"), (3, "1234 5678 1"), (4, "")], "doc_id long, text string")
    scored = rulefit.statistics(rulefit.counts(docs)).select("doc_id", model.score().alias("score"))
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    assert got == pytest.approx({1: sigmoid(0.25 - 3 + 2), 2: sigmoid(2.25), 3: sigmoid(0.25), 4: sigmoid(0.25)})
    assert not re.search("Exchange|Python|Arrow", scored._jdf.queryExecution().executedPlan().toString())
    assert str(rules[1][0]) == " < digits <= 0.5 and 1 < log_words <= 4"


def test_paths_become_rules(spark):
    """Two statistics decide together; the ensemble has to use both."""
    pick = random.Random(5)
    rows = [(i, pick.random(), pick.random(), pick.random()) for i in range(2000)]
    labelled = spark.createDataFrame([(*r, int(r[1] > 0.4 and r[2] <= 0.7)) for r in rows], "doc_id long, a double, b double, c double, label int")
    model = rulefit.fit(labelled, rulefit.RuleSettings(trees=20))
    assert 0 < len(model.rules) < 200 and model.learnt_from == 2000
    wrong = labelled.where((model.score() >= 0.5) != (F.col("label") == 1)).count()
    assert wrong <= 40
    assert any({n for n, _, _ in rule.bounds} >= {"a", "b"} for rule, _ in model.rules)
    few = rulefit.fit(labelled, rulefit.RuleSettings(trees=5, max_rows=200))
    assert 120 < few.learnt_from < 300


def test_words_are_split_as_the_contract_says():
    """Only blanks and tabs separate words inside a piece; other control characters belong to them."""
    got = collocations._words(["x\x1cy z\u0085\u00a0q \td. e".encode()], [0], [0])
    assert got.kinds.to_pylist() == ["x\x1cy", "z\u0085\u00a0q", "d", "e"]
    assert got.piece.tolist() == [0, 0, 0, 1] and got.own.all()
