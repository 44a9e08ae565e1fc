"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on the statistics of labelled documents; their paths
become conjunctive rules, a lasso logistic regression weighs the rules, and the
rules with a weight are compiled into one Spark column expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import cut, once

#: Labelled ids that a fit uses at most (those of the smallest hashes), so
#: that trees and weights fit in memory at any corpus size.
FIT_ROWS = 50_000
TREES = 16
DEPTH = 3
LASSO = 2e-3


#: Counted in every text: matches of a pattern.
PATTERNS = {
    "upper": r"\p{Lu}",
    "shouts": r"\p{Lu}{2,}",
    "digits": "[0-9]",
    "symbols": r"[^\p{L}\p{N}\s.,;:'\"-]",
    "lone": r"(?:^|(?<=\s))[^\p{L}\p{N}\s]+(?:$|(?=\s))",
    "stops": "[.!?]",
    "markup": r"[<>{}\[\]@/\\_=]",
}
NAMES = [
    "words", "word_length", "upper", "shouted", "digits", "symbols", "lone_symbols", "stops", "line_length", "same_lines", "distinct_words", "markup",
]


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the struct ``_stats`` of NAMES: statistics of the whole
    text, all zero for an empty one.  Every count is taken once per text; the
    ratios are built on the counts."""
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    filled = docs.withColumn("_tokens", once(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda x: x != "")))
    filled = filled.withColumn("_lines", once(F.split(t, "\n")))
    counts = {
        "chars": F.length(t),
        "words": F.size("_tokens"),
        "kinds": F.size(F.array_distinct("_tokens")),
        "lines": F.size("_lines"),
        "filled": F.size(F.filter("_lines", lambda x: x != "")),
        "distinct": F.size(F.array_distinct(F.filter("_lines", lambda x: x != ""))),
    } | {n: F.regexp_count(t, F.lit(p)) for n, p in PATTERNS.items()}
    counted = filled.withColumn("_n", once(F.struct(*[c.cast("double").alias(n) for n, c in counts.items()]))).drop("_tokens", "_lines")

    def per(a: str, b: str) -> Column:
        return F.when(F.col(f"_n.{b}") > 0, F.col(f"_n.{a}") / F.col(f"_n.{b}")).otherwise(0.0)

    stats = {
        "words": F.col("_n.words"),
        "word_length": per("chars", "words"),
        "upper": per("upper", "chars"),
        "shouted": per("shouts", "words"),
        "digits": per("digits", "chars"),
        "symbols": per("symbols", "chars"),
        "lone_symbols": per("lone", "words"),
        "stops": per("stops", "words"),
        "line_length": per("words", "lines"),
        "same_lines": F.when(F.col("_n.filled") > 0, 1.0 - F.col("_n.distinct") / F.col("_n.filled")).otherwise(0.0),
        "distinct_words": per("kinds", "words"),
        "markup": per("markup", "chars"),
    }
    return counted.withColumn("_stats", once(F.struct(*[stats[n].alias(n) for n in NAMES]))).drop("_n"), NAMES


@dataclass(frozen=True)
class Rule:
    """A conjunction: each statistic lies above its lower and up to its upper
    bound (None: unbounded)."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self, prefix: str = "_stats") -> Column:
        parts = []
        for name, low, high in self.bounds:
            if low is not None:
                parts.append(F.col(f"{prefix}.{name}") > low)
            if high is not None:
                parts.append(F.col(f"{prefix}.{name}") <= high)
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out.cast("double")


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """Every path from the root of a described tree, as a rule."""
    rules: list[Rule] = []
    path: list[tuple[int, str, bool, float]] = []
    for line in description.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(m[2])], m[3] == ">", float(m[4]))]
        bounds: dict[str, list[float | None]] = {}
        for _, name, above, at in path:
            b = bounds.setdefault(name, [None, None])
            if above:
                b[0] = at if b[0] is None else max(b[0], at)
            else:
                b[1] = at if b[1] is None else min(b[1], at)
        rules.append(Rule(tuple((n, *b) for n, b in sorted(bounds.items()))))
    return list(dict.fromkeys(rules))


@dataclass(frozen=True)
class RuleModel:
    """Intercept and weighted rules; ``score`` is a column over ``_stats``."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule.column() * weight
        return 1.0 / (1.0 + F.exp(-total))


def fit_rules(
    labelled: DataFrame,
    *,
    label_col: str = "quality",
    text_col: str = "text",
    id_col: str = "doc_id",
    fit_rows: int = FIT_ROWS,
    seed: int = 7,
) -> RuleModel:
    """Fit on rows with a label 0 or 1 (others are ignored); only statistics of
    the text are inputs.  The rows of at most ``fit_rows`` ids are used,
    those with the smallest hashes.  With no rows, or rows of one label only, the model is
    that label's smoothed share and has no rules.
    """
    known = labelled.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"), F.col(f"`{text_col}`").alias("text")
    )
    ids = _drawn(known.select("id").distinct(), fit_rows, seed).select(F.col("id").alias("_id"))
    return _fit(known.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi"), seed)


def _drawn(ids: DataFrame, fit_rows: int, seed: int) -> DataFrame:
    """The rows of the ``fit_rows`` smallest id hashes (marked for broadcast:
    so many small rows at most)."""
    return F.broadcast(ids.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(fit_rows))


def fit_labels(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    text_col: str = "text",
    id_col: str = "doc_id",
    fit_rows: int = FIT_ROWS,
    seed: int = 7,
) -> RuleModel:
    """Fit on the texts of ``docs`` whose ids ``labels`` marks 0 or 1.

    The ids are drawn before any text is read: labels meet the ids of the
    documents alone, at most ``fit_rows`` of them are kept, and the texts are
    picked by that broadcast list, so no text is shuffled at any size.  An id
    with both labels is ignored, and so is a null id; of rows that repeat an
    id one (of the smallest statistics) is used.
    """
    one = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).cast("double").alias("label"), F.max(label_col).cast("double").alias("_most")
    )
    present = one.filter(F.col("label") == F.col("_most")).select("id", "label").join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    drawn = _drawn(present, fit_rows, seed).withColumnRenamed("id", "_id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(f"`{text_col}`").alias("text"))
    return _fit(texts.join(drawn, F.col("id") == F.col("_id")).drop("_id"), seed)


def _fit(known: DataFrame, seed: int) -> RuleModel:
    """The model of rows ``id, label, text``, one per id and label."""
    stats, names = with_statistics(known)
    stats = stats.groupBy("id", "label").agg(F.min("_stats").alias("_stats"))  # numbers only
    data = cut(stats.select("label", *[F.col(f"_stats.{n}").alias(n) for n in names]))
    share = data.agg(F.sum("label").alias("ones"), F.count("*").alias("rows")).first()
    ones, rows = share["ones"] or 0.0, share["rows"]
    if ones in (0.0, float(rows)):
        from math import log

        return RuleModel(log((ones + 1.0) / (rows - ones + 1.0)), ())
    grown = VectorAssembler(inputCols=names, outputCol="features").transform(data)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, bootstrap=False, featureSubsetStrategy="onethird", maxBins=64, seed=seed
    ).fit(grown)
    rules = list(dict.fromkeys(r for t in forest.trees for r in tree_rules(t.toDebugString, names)))
    if not rules:
        from math import log

        return RuleModel(log((ones + 1.0) / (rows - ones + 1.0)), ())
    marked = data.select("label", F.struct(*[F.col(n) for n in names]).alias("_stats"))
    marked = marked.select("label", *[r.column().alias(f"r{k}") for k, r in enumerate(rules)])
    vectors = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(marked)
    vectors = vectors.select("label", "features").persist()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60, tol=1e-6)
    fitted = lasso.fit(vectors)
    vectors.unpersist()
    weights = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if w]
    return RuleModel(float(fitted.intercept), tuple(weights))


def classify(docs: DataFrame, model: RuleModel, *, text_col: str = "text") -> DataFrame:
    """The input's columns as a struct ``row``, with ``score`` (0 to 1) and
    ``predicted`` (1 from 0.5).  Null and empty texts get the score of
    all-zero statistics; repeated rows get equal scores."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("_text"))
    stats, _ = with_statistics(rows, "_text")
    return stats.select("row", once(model.score()).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )
