"""Line-first quality rules: clean line by line, then judge what is left of the document.

Every line that holds a word passes three rules: punctuation (a short line has to end like a
sentence or read like a line of code, and few words may carry runs of symbols), navigation (menus,
breadcrumbs, tables of links) and boilerplate (lines that consist of legal and cookie notices). Failing lines are removed. A document that
loses more than ``max_lost`` of its characters that way is rejected.

Only built-in functions are used and nothing is shuffled: each document is judged inside its own
row, so a hot source or a group of copies costs what its rows cost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, carried, narrow

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Thresholds and patterns; the patterns are read alike by Java and RE2.

    Navigation and boilerplate are known in the four languages of the corpus. A phrase of boilerplate
    fails a line only where it is most of what the line says: a line with more
    than ``max_words_per_phrase`` words to a phrase is prose that mentions one.
    """

    min_words: int = 20
    max_repeat_pct: int = 30
    max_lost_pct: int = 50
    short_line: int = 12
    max_symbol_run_pct: int = 30
    max_separators: int = 3
    max_words_per_phrase: int = 25
    sentence_end: str = r"[.!?:;,…。！？)\]\"'”’»]\s*\z"
    code: str = r"(\A[ \t]+\S|[A-Za-z0-9_]\(|[\])A-Za-z0-9_] ?[-+*/:]?= ?[\[({A-Za-z0-9_\"'-]|[{};]\s*\z|\A\s*(//|/\*|import |return\b|def |class |else\b|end\b))"
    symbol_run: str = r"[!?*#$%&|<>~=_+^-]{2,}"
    separator: str = r"[|>»·•]"
    navigation: str = (
        r"(?i)\A\s*(home|menu|next|previous|back to top|read more|more|log ?in|sign (in|up)|search|share|tweet|"
        r"skip to content|contact( us)?|about( us)?|"
        r"startseite|men[üÜ]|weiter(lesen)?|zur[üÜ]ck|mehr (lesen|erfahren)|anmelden|suche|teilen|kontakt|[üÜ]ber uns|"
        r"accueil|suivant|pr[éÉ]c[éÉ]dent|lire la suite|(se )?connecter|connexion|rechercher?|partager|contactez[- ]nous|[àÀ] propos|"
        r"inicio|men[úÚ]|siguiente|anterior|leer m[áÁ]s|iniciar sesi[óÓ]n|buscar|compartir|cont[áÁ]cto?|sobre nosotros)"
        r"\s*[|>».]*\s*\z"
    )
    boilerplate: str = (
        r"(?i)(all rights reserved|licensed under|privacy policy|terms of (use|service)|cookie policy|"
        r"uses? cookies|enable javascript|lorem ipsum|unsubscribe|subscribe to our|copyright (\(c\)|©|[0-9]{4})|"
        r"alle rechte vorbehalten|datenschutzerkl[äÄ]rung|impressum|nutzungsbedingungen|verwende[nt] cookies|"
        r"newsletter (abonnieren|abbestellen)|"
        r"tous droits r[éÉ]serv[éÉ]s|politique de confidentialit[éÉ]|mentions l[éÉ]gales|conditions d['’]utilisation|"
        r"utilise(nt)? des cookies|abonnez-vous|se d[éÉ]sabonner|"
        r"todos los derechos reservados|pol[íÍ]tica de (privacidad|cookies)|aviso legal|(t[éÉ]rminos|condiciones) de uso|"
        r"utiliza(mos)? cookies|suscr[íÍ]bete|darse de baja)"
    )


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _settled(rows: DataFrame) -> DataFrame:
    """The same rows, with columns that later filters and projections read instead of repeating them."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def line_fails(line: Column, rules: LineRules) -> Column:
    """One boolean per line that holds a word."""
    words = F.regexp_count(line, F.lit(WORD))
    unfinished = (words < rules.short_line) & ~line.rlike(rules.sentence_end) & ~line.rlike(rules.code)
    noisy = F.regexp_count(line, F.lit(rules.symbol_run)) * 100 > words * rules.max_symbol_run_pct
    links = F.regexp_count(line, F.lit(rules.separator))
    menu = ((links >= rules.max_separators) & (links * 4 >= words)) | line.rlike(rules.navigation)
    phrases = F.regexp_count(line, F.lit(rules.boilerplate))
    legal = line.rlike(rules.boilerplate) & (words <= phrases * rules.max_words_per_phrase)
    return unfinished | noisy | menu | legal


def judge(
    docs: DataFrame, rules: LineRules = LineRules(), id: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """One row per row of ``docs``: counts, both verdicts, and the cleaned text.

    ``base_failed`` holds for fewer than ``min_words`` words or too many words inside repeated
    windows of eight words; ``kept`` is false then, and also when the lines that were removed held
    more than ``max_lost_pct`` of the characters. Null text has no words: ``base_failed``, cleaned
    text null. Empty text has no words and stays empty. Null ids, equal rows and further columns
    have no influence; an empty table gives an empty table. With ``carry`` the
    input's other columns come along in ``carried``.
    """
    rows = narrow(docs, carry, doc_id=id, text=text)
    extra = carried(rows)
    body = F.coalesce(F.col("text"), F.lit(""))
    bare = F.trim(body, F.lit(SPACES))
    no_words = F.array().cast("array<string>")
    rows = rows.select(
        "doc_id",
        *extra,
        "text",
        F.when(bare == "", no_words).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("words"),
        F.split(body, "\n").alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        *extra,
        "text",
        F.size("words").alias("n"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("h1"),
        F.transform(
            "lines",
            lambda line: F.struct(
                line.alias("line"),
                line.rlike(WORD).alias("full"),
            ),
        ).alias("lines"),
    )
    for step in (1, 2, 4):
        hashes = F.col(f"h{step}")
        shifted = F.slice(hashes, F.lit(step + 1), F.greatest(F.col("n"), F.lit(1)))
        joined = F.zip_with(hashes, shifted, lambda a, b: F.xxhash64(a, b))
        rows = rows.select("doc_id", *extra, "text", "n", "lines", joined.alias(f"h{2 * step}"))
    windows = F.slice("h8", F.lit(1), F.greatest(F.col("n") - (WINDOW - 1), F.lit(0)))
    full = F.transform(F.filter("lines", lambda x: x["full"]), lambda x: x["line"])
    passed = F.filter("lines", lambda x: ~x["full"] | ~line_fails(x["line"], rules))
    rows = rows.select(
        "doc_id",
        *extra,
        "text",
        "n",
        windows.alias("windows"),
        full.alias("full"),
        F.array_join(F.transform(passed, lambda x: x["line"]), "\n").alias("cleaned"),
    )
    rows = _settled(rows)
    rows = rows.withColumn("repeats", F.size("windows") > F.size(F.array_distinct("windows")))
    numbered = F.when(
        F.col("repeats"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    rows = rows.withColumn("ordered", numbered)
    rows = rows.withColumn("at", F.when(F.col("repeats"), _repeated_positions("ordered")))
    gaps = F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    repeated = F.when(F.col("repeats"), covered).otherwise(F.lit(0))
    length = F.char_length(body)
    rows = rows.select(
        "doc_id",
        *extra,
        F.col("n").cast("long").alias("n_words"),
        F.char_length(_without(body, SPACES)).cast("long").alias("word_chars"),
        (length - F.char_length(_without(body, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        length.cast("long").alias("n_chars"),
        F.when(F.col("text").isNotNull(), F.col("cleaned")).alias("cleaned_text"),
        F.char_length("cleaned").cast("long").alias("cleaned_chars"),
    )
    rows = _settled(rows)
    base = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_pct
    )
    lost = (F.col("n_chars") - F.col("cleaned_chars")) * 100 > F.col("n_chars") * rules.max_lost_pct
    return rows.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~lost)


def _repeated_positions(ordered: str) -> Column:
    """Ascending positions of the windows whose hash also stands next to them in sorted order."""

    def twice(entry, i):
        before, after = F.get(F.col(ordered), i - 1)["h"], F.get(F.col(ordered), i + 1)["h"]
        return F.coalesce(before == entry["h"], F.lit(False)) | F.coalesce(after == entry["h"], F.lit(False))

    return F.sort_array(F.transform(F.filter(ordered, twice), lambda entry: entry["i"]))
