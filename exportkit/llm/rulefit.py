"""Quality classifier: a sparse ensemble of rules over text statistics.

A forest of shallow trees is grown on statistics of labelled texts. Every path from a root becomes
a rule, a conjunction of bounds on statistics; a logistic regression with a lasso penalty weighs
the rules and drops most of them. What is left is compiled into one Spark column expression, so
that scoring is a projection without Python and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, narrow, written

UPPER = "[A-Z]"
DIGITS = "[0-9]"
SYMBOLS = r"[#*$%&|<>{}\[\]~^_=+\\/@]"
ENDS = "[.!?…。！？]"
COMMAS = "[,;:]"

ROWS_PER_TASK = 10_000

# Frequent function words of the languages at hand.
FUNCTION_WORDS = (
    "the of and to in is that it for was on are as with be at by this have from or an they which not but "
    "der die das und ist nicht ein eine zu den von mit für auf dem sich auch als an wie "
    "le la les des un une et est que qui dans pour pas sur par plus au avec "
    "el los las de del y en por con para su lo se al una"
).split()


@dataclass(frozen=True)
class RuleSettings:
    """How the ensemble is grown. At most about ``max_rows`` labelled rows are learnt from, picked
    by a hash of their id; all documents are scored."""

    trees: int = 30
    depth: int = 3
    penalty: float = 0.001
    iterations: int = 30
    max_rows: int = 200_000
    seed: int = 13


@dataclass(frozen=True)
class Rule:
    """``low < statistic <= high`` for each statistic named; either bound may be missing."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def sql(self) -> str:
        parts = []
        for name, low, high in self.bounds:
            parts += [] if low is None else [f"`{name}` > {low!r}D"]
            parts += [] if high is None else [f"`{name}` <= {high!r}D"]
        return " AND ".join(parts)

    def __str__(self) -> str:
        text = lambda v: "" if v is None else f"{v:.4g}"
        return " and ".join(f"{text(low)} < {name} <= {text(high)}" for name, low, high in self.bounds)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``prior`` is the score when there was nothing to tell apart."""

    rules: tuple[tuple[Rule, float], ...] = ()
    intercept: float = 0.0
    prior: float | None = None
    learnt_from: int = field(default=0, compare=False)

    def score(self) -> Column:
        """The probability of label 1, over the columns of :func:`statistics`."""
        if self.prior is not None:
            return F.lit(self.prior)
        terms = [f"CASE WHEN {rule.sql()} THEN {weight!r}D ELSE 0D END" for rule, weight in self.rules]
        total = " + ".join([f"{self.intercept!r}D", *terms])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.expr(total)))


def counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What is counted in each whole text, in one pass; null is empty."""
    rows = narrow(docs, doc_id=id, text=text)
    body = F.coalesce("text", F.lit(""))
    bare = F.trim(body, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    rows = rows.select("doc_id", body.alias("t"), words.alias("words"), F.split(body, "\n").alias("lines"))
    made = {
        "chars": F.char_length("t"),
        "words": F.size("words"),
        "kinds": F.size(F.array_distinct("words")),
        "longest": F.coalesce(F.array_max(F.transform("words", lambda w: F.char_length(w))), F.lit(0)),
        "known": F.size(F.filter("words", lambda w: w.isin(FUNCTION_WORDS))),
        "blanks": F.char_length("t") - F.char_length(F.array_join("words", "")),
        "capitals": F.regexp_count("t", F.lit(UPPER)),
        "digits": F.regexp_count("t", F.lit(DIGITS)),
        "symbols": F.regexp_count("t", F.lit(SYMBOLS)),
        "ends": F.regexp_count("t", F.lit(ENDS)),
        "commas": F.regexp_count("t", F.lit(COMMAS)),
        "runs": F.regexp_count("t", F.lit(r"[!?#*$%&|<>=_~-]{2,}")),
        "lines": F.size("lines"),
        "line_kinds": F.size(F.array_distinct("lines")),
        "short_lines": F.size(F.filter("lines", lambda line: F.char_length(line).between(1, 40))),
    }
    return rows.select("doc_id", *(column.cast("double").alias(name) for name, column in made.items()))


def statistics(counted: DataFrame) -> DataFrame:
    """Ratios of the counts: what the rules speak about."""
    words, chars, lines = (F.greatest(F.col(n), F.lit(1.0)) for n in ("words", "chars", "lines"))
    letters = F.greatest(F.col("chars") - F.col("blanks"), F.lit(1.0))
    return counted.select(
        "doc_id",
        F.log1p("words").alias("log_words"),
        ((F.col("chars") - F.col("blanks")) / words).alias("word_length"),
        F.col("longest").alias("longest_word"),
        (F.col("kinds") / words).alias("distinct_words"),
        (F.col("known") / words).alias("function_words"),
        (F.col("capitals") / letters).alias("capitals"),
        (F.col("digits") / letters).alias("digits"),
        (F.col("symbols") / letters).alias("symbols"),
        (F.col("ends") / words).alias("sentence_ends"),
        (F.col("commas") / words).alias("commas"),
        (F.col("runs") / words).alias("symbol_runs"),
        (words / lines).alias("words_per_line"),
        (F.col("line_kinds") / lines).alias("distinct_lines"),
        (F.col("short_lines") / lines).alias("short_lines"),
        (F.col("blanks") / chars).alias("blanks"),
    )


def _paths(node, names: list[str], bounds: dict, found: dict) -> None:
    """All conjunctions on the way down from ``node``, one for each node below the root."""
    if not node.getClass().getSimpleName().endswith("InternalNode"):
        return
    split = node.split()
    name, threshold = names[split.featureIndex()], round(split.threshold(), 6)
    for child, side in ((node.leftChild(), 1), (node.rightChild(), 0)):
        tighter = dict(bounds)
        low, high = tighter.get(name, (None, None))
        if side:
            high = threshold if high is None else min(high, threshold)
        else:
            low = threshold if low is None else max(low, threshold)
        tighter[name] = (low, high)
        found[Rule(tuple((n, *tighter[n]) for n in sorted(tighter)))] = None
        _paths(child, names, tighter, found)


def fit(labelled: DataFrame, settings: RuleSettings = RuleSettings()) -> RuleModel:
    """Grow trees, take their paths as rules, weigh the rules. ``labelled`` holds the columns of
    :func:`statistics` and a ``label`` of 0 or 1."""
    names = [n for n in labelled.columns if n not in ("doc_id", "label")]
    total = labelled.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, settings.max_rows / max(1, total)))
    kept = labelled.where(share).select(array_to_vector(F.array(*names)).alias("x"), *names, F.col("label").cast("double"))
    # Every pass of the fit is a job of its own: as many tasks as the bounded rows need, not as the corpus has.
    kept = kept.repartition(max(1, -(-min(total, settings.max_rows) // ROWS_PER_TASK))).persist()
    try:
        seen = {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()}
        rows, good = sum(seen.values()), seen.get(1.0, 0)
        if len(seen) < 2:
            return RuleModel(prior=(good + 1.0) / (rows + 2.0), learnt_from=rows)
        forest = RandomForestClassifier(
            featuresCol="x", numTrees=settings.trees, maxDepth=settings.depth, maxBins=64, subsamplingRate=0.6,
            featureSubsetStrategy="onethird", seed=settings.seed,
        ).fit(kept)
        found: dict[Rule, None] = {}
        for tree in forest.trees:
            _paths(tree._call_java("rootNode"), names, {}, found)
        rules = list(found)
        if not rules:
            return RuleModel(prior=(good + 1.0) / (rows + 2.0), learnt_from=rows)
        fired = F.expr("array(" + ", ".join(f"CASE WHEN {rule.sql()} THEN 1D ELSE 0D END" for rule in rules) + ")")
        matrix = kept.select(array_to_vector(fired).alias("x"), "label")
        lasso = LogisticRegression(
            featuresCol="x", elasticNetParam=1.0, regParam=settings.penalty, maxIter=settings.iterations
        ).fit(matrix)
        weighed = tuple((rule, float(w)) for rule, w in zip(rules, lasso.coefficients) if w)
        return RuleModel(weighed, float(lasso.intercept), learnt_from=rows)
    finally:
        kept.unpersist()


def held_out(id: str = "doc_id") -> Column:
    """Rows that are never learnt from: one in three, by the checksum of the id's decimal digits."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, settings: RuleSettings = RuleSettings(), id: str = "doc_id", text: str = "text",
    label_id: str = "doc_id", label: str = "quality",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Only labels 0 and 1 of rows that are not held out are learnt from; ids that carry both are left
    out, and repeated rows of a document or a label count once per document row. With one label or
    none to learn from, every score is the same, between 0 and 1. Null and empty texts are scored by
    their statistics, which are zero; null ids are not held out and have no label. Other columns are
    ignored; an empty table gives an empty table.
    """
    counted = written(counts(docs, id, text), "rulefit-counts")
    measured = statistics(counted)
    marks = narrow(labels, doc_id=label_id, label=label).where(F.col("label").isin(0, 1) & ~held_out())
    marks = marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    marks = marks.where("label = other").select("doc_id", "label")
    model = fit(measured.join(marks, "doc_id"), settings)
    scored = measured.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
