"""Phrase collocations by best-first branch and bound.

Words are counted first, then pairs of words that are frequent enough. A phrase that begins with
the pair ``(x, y)`` occurs at most as often as the pair, so no cut of it can score above
``f(x y) / f(x)``: that bound orders the frontier. The best pairs are grown by a third word, on either
side, until every language has enough surviving phrases at or above the bound of the pairs that were
left alone. Those cannot change the result, ties included.

Each count is one pass over the whole texts: tasks count inside a megabyte of text at a time, Spark
adds the counts up. What a pass may leave out is decided by a bit array of fixed size that is never
wrong about a phrase that matters; its false alarms only cost time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, narrow, texts, through_arrow, written

NO_LANGUAGE = "und"
# Characters that end a piece, and the blanks between its words.
BREAKERS = b".,;:!?\n\x0b\x0c\r"
BREAK = re.compile(rb"[.,;:!?\n-\r]")
GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
SEGMENT_BYTES = 512 << 10
CHUNK_BYTES = 1 << 20
SIEVE_BITS = 25
#: Counts have up to 14 digits, so that a product of two of them and the scale fits 38.
COUNT, SCALED = "decimal(14,0)", "decimal(7,0)"
SCALE = 1_000_000


@dataclass(frozen=True)
class PhraseRules:
    """``first`` pairs per language are grown in the first round, eight times as many in each next one."""

    min_count: int = 10
    top: int = 2000
    cover_pct: int = 50
    first: int = 8000


# ---------------------------------------------------------------------------- counting


def segments(body: bytes, size: int = SEGMENT_BYTES) -> Iterator[tuple[bytes, int]]:
    """``body`` in parts of about ``size`` bytes, each with how many of its first words are context.

    Parts end where pieces end. Where none does for long, a part ends between two words, and the next
    one starts with the two words before, which are not its own.
    """
    start, lead = 0, []
    while len(body) - start > 2 * size:
        cut = BREAK.search(body, start + size, start + 2 * size) or GAP.search(body, start + 2 * size)
        if cut is None:
            break
        part = b" ".join([*lead, body[start : cut.start()]])
        yield part, len(lead)
        tail = part[max(part.rfind(c) for c in (BREAKERS[i : i + 1] for i in range(len(BREAKERS)))) + 1 :]
        lead = [] if cut.group() in BREAKERS else tail.rsplit(None, 2)[-2:]
        start = cut.end()
    yield b" ".join([*lead, body[start:]]), len(lead)


def word_hashes(words: list[bytes | str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def pair_hashes(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash for a language and two words, of their hashes; the order matters."""
    with np.errstate(over="ignore"):
        mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ lang
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) ^ second
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def _inside(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - SIEVE_BITS)
    return (sieve[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def sieve_of(phrases: DataFrame, *words: str) -> np.ndarray:
    """A bit array of fixed size with the bits of all ``phrases``: of ``word``, or of ``lang`` and two words.

    The driver gets one number per 64 bits at most, whatever the size of the table.
    """

    def each(columns):
        hashes = [word_hashes(columns[w].to_pylist()) for w in words]
        place = (hashes[0] if len(hashes) == 1 else pair_hashes(*hashes)) >> np.uint64(64 - SIEVE_BITS)
        yield {"slot": (place >> np.uint64(6)).astype(np.int64), "bit": (place & np.uint64(63)).astype(np.int32)}

    bits = through_arrow(phrases.select(*words), each, "slot long, bit int")
    filled = bits.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    sieve = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    sieve[filled["slot"].to_numpy()] = filled["bits"].to_numpy()
    return sieve.view(np.uint64)


@dataclass(frozen=True)
class _Words:
    """Words of a chunk: their kinds, and for each word its kind, language, piece, and whether it is own."""

    kinds: pa.Array
    kind: np.ndarray
    lang: np.ndarray
    piece: np.ndarray
    own: np.ndarray


def _words(parts: list[bytes], leads: list[int], langs: list[int]) -> _Words:
    body = pa.array(parts, pa.large_binary()).cast(pa.large_string())
    pieces = pc.split_pattern_regex(body, pattern=r"[.,;:!?\n-\r]")
    part_of_piece = np.repeat(np.arange(len(parts)), pieces.value_lengths().to_numpy(zero_copy_only=False))
    words = pc.ascii_split_whitespace(pieces.flatten())
    piece = np.repeat(np.arange(len(part_of_piece)), words.value_lengths().to_numpy(zero_copy_only=False))
    flat = words.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    flat, piece = flat.filter(full), piece[full.to_numpy(zero_copy_only=False)]
    encoded = flat.dictionary_encode()
    part = part_of_piece[piece]
    rank = np.arange(len(part)) - np.searchsorted(part, part)
    return _Words(
        encoded.dictionary,
        encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.asarray(langs, np.int64)[part],
        piece,
        rank >= np.asarray(leads)[part],
    )


def _chunks(columns: dict, limit: int = CHUNK_BYTES) -> Iterator[tuple[_Words, list[str]]]:
    names: dict[str, int] = {}
    parts, leads, langs, size = [], [], [], 0
    for lang, body in zip(columns["lang"].to_pylist(), texts(columns["text"])):
        for part, lead in segments(body.lower()):  # bytes: only A-Z change
            parts.append(part)
            leads.append(lead)
            langs.append(names.setdefault(lang, len(names)))
            size += len(part) + 1
            if size >= limit:
                yield _words(parts, leads, langs), list(names)
                parts, leads, langs, size = [], [], [], 0
    if parts:
        yield _words(parts, leads, langs), list(names)


def count_phrases(rows: DataFrame, length: int, known: np.ndarray | None = None, grown: np.ndarray | None = None) -> DataFrame:
    """``lang``, ``phrase`` and ``n``: how often each phrase of ``length`` words occurs.

    Phrases with a word outside the sieve ``known`` are left out, and so are those of three words
    with neither their first nor their last pair in the sieve ``grown``.
    """
    session = rows.sparkSession.sparkContext
    known_at, grown_at = (None if s is None else session.broadcast(s) for s in (known, grown))

    def each(columns):
        for words, names in _chunks(columns):
            if not len(words.kind):
                continue
            last = np.flatnonzero(words.own)
            last = last[last >= length - 1]
            last = last[words.piece[last] == words.piece[last - (length - 1)]]
            spell = words.kinds.to_pylist() if length > 1 else []
            hashes = word_hashes(spell)
            if known_at is not None:
                common = _inside(known_at.value, hashes)[words.kind]
                last = last[np.logical_and.reduce([common[last - i] for i in range(length)])]
            if not len(last):
                continue
            many = len(words.kinds)
            key, at = words.lang[last] * many + words.kind[last - (length - 1)], None
            if length == 3:
                lang_hashes = word_hashes(names)
                spots = [words.kind[last - i] for i in (2, 1, 0)]
                pairs = [pair_hashes(lang_hashes[words.lang[last]], hashes[a], hashes[b]) for a, b in zip(spots, spots[1:])]
                near = _inside(grown_at.value, pairs[0]) | _inside(grown_at.value, pairs[1])
                last, key = last[near], key[near]
            for place in range(length - 2, -1, -1):
                _, at, key = np.unique(key, return_index=True, return_inverse=True)
                key = key * many + words.kind[last - place]
            _, at, counts = np.unique(key, return_index=True, return_counts=True)
            first = last[at]
            out = {"lang": pa.array(names, pa.string()).take(pa.array(words.lang[first])), "n": counts}
            parts = [words.kinds.take(pa.array(words.kind[first - (length - 1) + i])) for i in range(length)]
            out["phrase"] = pc.binary_join_element_wise(*parts, pa.scalar(" ", parts[0].type)) if length > 1 else parts[0]
            yield out

    # One key per phrase: words hold no blanks, so it can be taken apart again.
    found = through_arrow(rows, each, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame, length: int, min_count: int) -> DataFrame:
    """``lang``, ``w1`` .. and ``n`` of the phrases that occur often enough."""
    words = F.split("phrase", " ")
    return counted.where(F.col("n") >= min_count).select(
        "lang", *(words[i].alias(f"w{i + 1}") for i in range(length)), "n"
    )


# ------------------------------------------------------------------------------ scoring


def exact_ratio(count: Column, below: tuple[Column, Column], times: Column | None = None) -> Column:
    """``floor(SCALE * count * times / (below[0] * below[1]))``, exactly; ``times`` is ``count`` unless given."""
    above = count.cast(COUNT) * (count if times is None else times).cast(COUNT) * F.lit(SCALE).cast(SCALED)
    return F.call_function("div", above, below[0].cast(COUNT) * below[1].cast(COUNT))


def scored_pairs(rows: DataFrame, common: DataFrame, known: np.ndarray, min_count: int) -> DataFrame:
    """Candidates of two words: ``a``, ``l``, ``r``, ``score``, and the ``bound`` of every phrase they begin."""
    pairs = frequent(count_phrases(rows, 2, known), 2, min_count).withColumnRenamed("n", "a")
    for word, name in (("w1", "l"), ("w2", "r")):
        pairs = pairs.join(common.select("lang", F.col("word").alias(word), F.col("n").alias(name)), ["lang", word])
    a, left, right = F.col("a"), F.col("l"), F.col("r")
    bound = exact_ratio(a, (left, F.lit(1)), F.lit(1))
    return pairs.select("lang", "w1", "w2", "a", "l", "r", exact_ratio(a, (left, right)).alias("score"), bound.alias("bound"))


def scored_triples(triples: DataFrame, common: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same for three words: the cut that scores lowest counts, the first one of equals."""
    word = lambda place, name: common.select("lang", F.col("word").alias(place), F.col("n").alias(name))
    pair = lambda i, name: pairs.select(
        "lang", F.col("w1").alias(f"w{i}"), F.col("w2").alias(f"w{i + 1}"), F.col("a").alias(name)
    )
    rows = triples.withColumnRenamed("n", "a").join(pair(1, "head"), ["lang", "w1", "w2"])
    rows = rows.join(pair(2, "tail"), ["lang", "w2", "w3"])
    rows = rows.join(word("w1", "first"), ["lang", "w1"]).join(word("w3", "last"), ["lang", "w3"])
    early = exact_ratio(F.col("a"), (F.col("first"), F.col("tail")))
    late = exact_ratio(F.col("a"), (F.col("head"), F.col("last")))
    rows = rows.withColumns({"early": early, "late": late})
    one = F.col("early") <= F.col("late")
    return rows.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(one, F.col("first")).otherwise(F.col("head")).alias("l"),
        F.when(one, F.col("tail")).otherwise(F.col("last")).alias("r"),
        F.least("early", "late").alias("score"),
    )


def frontier(pairs: DataFrame, grow: int) -> DataFrame:
    """``tau`` per language: the largest bound that at least ``grow`` pairs reach, 0 where there are fewer.

    Bounds are whole numbers up to ``SCALE``, so no language has more than that many rows here.
    """
    steps = pairs.groupBy("lang", "bound").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("lang").orderBy(F.desc("bound")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = steps.withColumn("reached", F.sum("n").over(down))
    best = F.max(F.when(F.col("reached") >= grow, F.col("bound")))
    return reached.groupBy("lang").agg(F.coalesce(best, F.lit(0).cast("long")).alias("tau"))


def surviving(grown: DataFrame, triples: DataFrame, scored: DataFrame, taus: DataFrame, cover_pct: int) -> DataFrame:
    """Phrases that score at least ``tau`` and lie in no longer one that is nearly as frequent."""
    ends = [
        triples.select("lang", F.col(a).alias("w1"), F.col(b).alias("w2"), "n") for a, b in (("w1", "w2"), ("w2", "w3"))
    ]
    longer = ends[0].unionAll(ends[1]).groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    free = F.coalesce(F.col("longer") * 100 < F.col("a") * cover_pct, F.lit(True))
    two = grown.join(longer, ["lang", "w1", "w2"], "left").where(free & (F.col("score") >= F.col("tau")))
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
    three = scored.join(taus, "lang").where("score >= tau").select(two.columns)
    return two.unionAll(three)


def mine(docs: DataFrame, rules: PhraseRules = PhraseRules(), lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's best phrases.

    Phrases of two and three words are counted inside pieces of whole lower-cased texts. Null texts are
    empty, a null language is ``und``; repeated rows count each; other columns are ignored; a language
    without candidates has no row, and an empty table gives an empty table. Counts are exact below 1e14,
    beyond that the cast fails instead of wrapping.
    """
    rows = narrow(docs, lang=lang, text=text).withColumn("lang", F.coalesce("lang", F.lit(NO_LANGUAGE)))
    words = written(count_phrases(rows, 1).withColumnRenamed("phrase", "word"), "phrases-words")
    common = words.where(F.col("n") >= rules.min_count)
    known = sieve_of(common, "word")
    pairs = written(scored_pairs(rows, common, known, rules.min_count), "phrases-pairs")
    scratch, settled, pending, grow = [words, pairs], [], pairs, rules.first
    while True:
        taus = written(frontier(pending, grow), "phrases-frontier")
        grown = pending.join(taus, "lang").where("bound >= tau")
        triples = count_phrases(rows, 3, known, sieve_of(grown, "lang", "w1", "w2"))
        triples = written(frequent(triples, 3, rules.min_count), "phrases-triples")
        best = surviving(grown, triples, scored_triples(triples, common, pairs), taus, rules.cover_pct)
        best = written(best, "phrases-best")
        reached = best.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        done = (F.col("tau") == 0) | (F.coalesce("found", F.lit(0)) >= rules.top)
        state = written(taus.join(reached, "lang", "left").select("lang", done.alias("done")), "phrases-state")
        settled.append(best.join(state.where("done").select("lang"), "lang", "left_semi"))
        scratch += [taus, triples, best, state]
        if state.where("not done").isEmpty():
            break
        pending = pending.join(state.where("not done").select("lang"), "lang", "left_semi")
        grow *= 8
    found = settled[0]
    for more in settled[1:]:
        found = found.unionAll(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= rules.top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    result = written(ranked, "phrases")
    for frame in scratch:
        drop_written(frame)
    return result
