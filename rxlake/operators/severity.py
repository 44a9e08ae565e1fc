"""Narrative severity classification.

Pipeline: tokens/terms (SQLTransformer, M1) -> vocabulary (M2, terms in two
documents or more; counted by shuffle) -> tf * idf (M3: smooth idf
ln((1+n)/(1+df)) + 1) at length one -> multinomial logistic regression with
balanced class weights (M4, M5).  Terms, counts and weights lie in shards over
the executors (``termpacks``); the Newton steps are taken in the span of the
rows.  All rows are fitted: the driver holds rows x classes of a fit of up to
``DRIVER_ROWS``, of a larger one a few sums (``rangefit``), and nothing of the
vocabulary.

The stratified split (M6) is exact per class without ranking a whole class
in one task: the k-th of the keys ``md5(seed|id)`` is selected digit by digit.

Saved models (K6) are found by a fingerprint of the rows and parameters they
were fitted on, so changed rows are never scored by an old model.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxlake.functions.text import terms_statement
from rxlake.operators import rangefit, termpacks
from rxlake.operators.joins import bounded_broadcast
from rxlake.operators.newton import RowFit, fit_by_rows
from rxlake.schemas import SEVERITY_ORDER
from rxlake.session import ensure_checkpoint_dir, path_exists, scratch_path

LOG = logging.getLogger(__name__)

LABEL = "severity_label"
DEFAULT_SEED = 42
TEST_FRACTION = 0.2
TOL = 1e-4  # the reference solver's default tolerance
MIN_DF = 2
# distinct rows of a fit whose vectors (an entry per row and class) the driver holds;
# those of a larger fit lie over the executors
DRIVER_ROWS = 200_000
FORMAT = "weights by shard"  # of a saved model
HEAD = "at int, class string, intercept double, shards int"


def sample_key(id_col: str, seed: int) -> Column:
    """Reproducible pseudo-random key: md5 hex of ``seed|id``."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


# ---------------------------------------------------------------- M6
def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    id_col: str = "case_id",
    test_fraction: float = TEST_FRACTION,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Adds ``split`` = 'test' for the first ceil(f * n_class) rows of each
    class in ``md5(seed|id)`` order (ties by id), else 'train'.

    The k-th key of each class is selected digit by digit.  One read of the
    labels and ids counts rows per six-digit prefix (16.7 million a class);
    their sums by three digits say which 4,096 of them hold the cut, these say
    which prefix does, and only its keys (one in 16.7 million) are ranked.
    Each selection has one row per class and is broadcast, so nothing runs
    while the plan is built and no rows are shuffled for it; the rows
    themselves are read once and compared with their class's cut.  Rows that
    repeat the id at the cut stay together, in 'test'.
    """
    wide, narrow = 3, 6

    def holding(counts: DataFrame, before: Column, k: Column) -> DataFrame:
        """One row per class: where, within its counts, the k-th key lies."""
        upto = Window.partitionBy("_c").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counts.select("_c", "_p", "_n", (before + F.sum("_n").over(upto)).alias("_after"), k.alias("_k"))
        summed = summed.withColumn("_before", F.col("_after") - F.col("_n")).filter("_before < _k and _after >= _k")
        return F.broadcast(summed.select(F.col("_c").alias("_of"), F.col("_p").alias("_in"), F.col("_before").alias("_from"), F.col("_k").alias("_kth")))

    of_class = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))
    keys = df.select(of_class.alias("_c"), sample_key(id_col, seed).alias("_u"), F.col(id_col).alias("_id"))
    fine = keys.groupBy("_c", F.substring("_u", 1, narrow).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    coarse = fine.groupBy("_c", F.substring("_p", 1, wide).alias("_p")).agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("_c"))
    first = holding(coarse, F.lit(0), F.ceil(total * F.lit(test_fraction)))
    inner = fine.join(first, (F.col("_c") == F.col("_of")) & (F.substring("_p", 1, wide) == F.col("_in")))  # 4,096 counts a class
    second = holding(inner, F.col("_from"), F.col("_kth"))
    edge = keys.join(second, (F.col("_c") == F.col("_of")) & (F.substring("_u", 1, narrow) == F.col("_in")))
    rank = F.row_number().over(Window.partitionBy("_c").orderBy("_u", "_id")) + F.col("_from")
    cut = edge.withColumn("_r", rank).filter(F.col("_r") == F.col("_kth")).select("_c", F.col("_u").alias("_cut_u"), F.col("_id").alias("_cut_id"))
    key = sample_key(id_col, seed)
    test = (key < F.col("_cut_u")) | ((key == F.col("_cut_u")) & (F.col(id_col) <= F.col("_cut_id")))
    judged = df.join(F.broadcast(cut), of_class == F.col("_c"), "left")
    return judged.select(*df.columns, F.when(test, "test").otherwise("train").alias("split"))


# ---------------------------------------------------------------- M8
def sample_cases(df: DataFrame, n: int = 10, id_col: str = "case_id", seed: int = 1) -> DataFrame:
    """min(n, count) reproducible sample (top-n by md5 key; the limit is the
    sampling operator itself)."""
    return df.withColumn("_u", sample_key(id_col, seed)).orderBy("_u", id_col).limit(n).drop("_u")


# ---------------------------------------------------------------- M4
def balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """n / (k * n_class) per class (k = classes present)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # total rows and class count as scalar subqueries (computed once, inlined)
    total = counts.select(F.sum("n_class")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_class", (total.cast("double") / (k * F.col("n_class"))).alias("weight"))


def with_balanced_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    w = bounded_broadcast(balanced_weights(df, label).select(label, "weight"))
    return df.join(w, on=label, how="inner")


# ---------------------------------------------------------------- M1-M3, M5
def label_index(label: str = LABEL, order: Sequence[str] = SEVERITY_ORDER) -> Column:
    """Fixed label order -> 0-based double index (null if outside the order)."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(label))
    return F.when(pos > 0, (pos - 1).cast("double"))


def known_rows(train: DataFrame, text_col: str = "narrative", label: str = LABEL, order: Sequence[str] = SEVERITY_ORDER) -> DataFrame:
    """Rows with a text and one of the labels; adds ``label`` (its index)."""
    # a filter for each column, so that counting rows carries no text through a join
    rows = train.filter(F.col(text_col).isNotNull()).filter(F.col(label).isNotNull()).withColumn("label", label_index(label, order))
    return rows.filter(F.col("label").isNotNull())


@dataclass(frozen=True)
class Features:
    """Fitted text features: ``vocabulary`` (``term, doc_freq, idf``; it stays
    distributed), the number of rows it was fitted on, and these themselves
    where each stands for one document."""

    vocabulary: DataFrame
    rows: int
    text_col: str = "narrative"
    fitted: DataFrame | None = None
    min_df: int = MIN_DF


def fit_features(data: DataFrame, text_col: str = "narrative", min_df: int = MIN_DF, copies: Column | None = None) -> Features:
    """M1-M3: vocabulary of the terms in ``min_df`` documents, smooth idf
    ln((1 + n) / (1 + df)) + 1.  Terms are counted by shuffle, so that the
    vocabulary may be of any size.  A row stands for ``copies`` documents."""
    fitted = data if copies is None else None
    data = data.select(text_col, (F.lit(1) if copies is None else copies).cast("bigint").alias("_copies"))
    rows = data.agg(F.sum("_copies")).first()[0] or 0
    terms = SQLTransformer(statement=terms_statement(text_col)).transform(data)
    found = terms.select(F.explode(F.array_distinct("terms")).alias("term"), "_copies").groupBy("term").agg(F.sum("_copies").alias("doc_freq"))
    idf = F.log(F.lit(1.0 + rows) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)
    return Features(found.filter(F.col("doc_freq") >= min_df).withColumn("idf", idf), rows, text_col, fitted, min_df)


def weighted_terms(features: Features, df: DataFrame, id_col: str = "case_id") -> DataFrame:
    """M3: ``id, term, weight`` of every document's feature vector.

    The rows that the features were fitted on are counted and weighed in one
    exchange (``termpacks``).  Terms of others are counted by id and text: rows
    that repeat both have one vector (their number falls out of its length),
    returned once for each."""
    if df is features.fitted:
        return termpacks.fitted_vectors(df, features.rows, features.min_df, id_col, features.text_col)
    text = F.unhex(F.sha2(F.col(features.text_col), 256))
    terms = SQLTransformer(statement=terms_statement(features.text_col)).transform(df.select(id_col, features.text_col))
    each = terms.select(id_col, text.alias("_text"), F.posexplode("terms").alias("_at", "term"))
    counts = each.groupBy(id_col, "_text", "term").agg(F.count("*").alias("_tf"), F.count_if(F.col("_at") == 0).alias("_first"))
    doc = Window.partitionBy(id_col, "_text")
    weighted = counts.join(features.vocabulary.select("term", "idf"), "term", "left").withColumn("_w", F.col("_tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(doc))
    vectors = weighted.select(id_col, "term", (F.col("_w") / length).alias("weight"), F.sum("_first").over(doc).alias("_rows"))
    vectors = vectors.filter("weight is not null")
    return vectors.select(id_col, "term", "weight", F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).select(id_col, "term", "weight")


@dataclass(frozen=True)
class SeverityModel:
    """A fitted model: ``weights`` holds one row per shard of the terms (hashes,
    idf, idf x weight per class; see ``termpacks``), files in the shared folder.
    The driver has the intercepts and the classes only."""

    weights: DataFrame
    intercepts: tuple[float, ...]
    classes: tuple[str, ...]
    shards: int


def train_severity(
    train: DataFrame,
    text_col: str = "narrative",
    label: str = LABEL,
    order: Sequence[str] = SEVERITY_ORDER,
    min_df: int = MIN_DF,
    driver_rows: int = DRIVER_ROWS,
    reg_c: float = 1.0,
) -> SeverityModel:
    """M5: fit features and classifier; rows with null text or label are dropped
    (P17).  The strength ``1 / C`` acts on the summed, weighted loss (balanced
    weights sum to n).  Rows of the same text and label are one row of their
    summed weight, and all of them are fitted; the vectors of the fit have an entry
    per such row and class.  Up to ``driver_rows`` the driver holds these, beyond
    they lie in ranges of rows over the executors (``rangefit``).  Nothing of the
    vocabulary's size leaves the tasks."""
    data = known_rows(train, text_col, label, order)
    spark = data.sparkSession
    ensure_checkpoint_dir(spark)
    same = with_balanced_weight(data, label).groupBy(F.col(text_col).alias("text"), "label").agg(F.sum("weight").alias("weight"), F.count("*").alias("copies"))
    held = same.checkpoint().withColumn("a", F.monotonically_increasing_id())
    n, chars = held.agg(F.count("*"), F.sum(F.length("text").cast("bigint"))).first()
    few = n <= driver_rows or len(order) < 2
    shards = termpacks.shards_for(chars or 0, *(() if few else (rangefit.SHARD_CHARS, 16)))
    features = fit_features(held, "text", min_df, F.col("copies"))
    packs = termpacks.packed_texts(held.withColumn("b", F.lit(0).cast("bigint")), "text", shards)
    path = scratch_path(spark, "severity-weights")
    if few:
        fit = _fit_on_driver(held, features, packs, shards, len(order), 1.0 / reg_c, path)
    else:
        fit, weights, ranges = rangefit.fit_terms(held, features.vocabulary, packs, shards, len(order), 1.0 / reg_c, TOL / 10)
        try:
            spark.createDataFrame(weights, termpacks.MODEL).write.parquet(path)
        finally:
            ranges.release()
    LOG.info("severity fit: %d rows, %d distinct, objective %.6f, gradient norm %.3g, %d Newton steps, %d products",
             features.rows, n, fit.objective, fit.gradient_norm, fit.newton_steps, fit.products)
    return SeverityModel(spark.read.schema(termpacks.MODEL).parquet(path), tuple(fit.intercepts.tolist()), tuple(order), shards)


def _fit_on_driver(held: DataFrame, features: Features, packs: DataFrame, shards: int, classes: int, l2: float, path: str) -> RowFit:
    """The fit of few rows; writes its weights to ``path``."""
    spark = held.sparkSession
    rows = held.select("a", "label", "weight").toArrow().sort_by("a")
    ids, label, weight = (np.array(rows[c], dtype=t) for c, t in (("a", np.int64), ("label", np.int32), ("weight", np.float64)))
    n = len(ids)
    del rows
    blocks = termpacks.fit_blocks(termpacks.packed_vocabulary(features.vocabulary, shards), packs, shards, ids).persist()
    try:
        length = np.sqrt(termpacks.over_blocks(blocks, 1, n, lambda x: x.squares(n))[0])
        scale = np.divide(1.0, length, out=np.zeros(n), where=length > 0)

        def gram(m: np.ndarray) -> np.ndarray:
            given = spark.sparkContext.broadcast(m.T * scale)
            out = termpacks.over_blocks(blocks, m.shape[1], n, lambda x: x.up(x.down(given.value), n))
            given.destroy()  # its copy on the driver too
            out *= scale
            return out.T

        fit = fit_by_rows(gram, label, weight, classes, l2, tolerance=TOL / 10)
        termpacks.block_weights(blocks, fit.by_row.T * scale).write.parquet(path)
    finally:
        blocks.unpersist()
    return fit


def score_severity(model: SeverityModel, df: DataFrame, text_col: str = "narrative") -> DataFrame:
    """M7: add ``predicted_severity`` (null where the narrative is null, T18).

    Every distinct text is packed by shards of its terms; a shard's packs meet
    its weights in one of ``parts`` lots, and the sums per text meet the rows."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) // model.shards)
    known, (a, b) = F.col(text_col).isNotNull(), termpacks.text_key(text_col)
    texts = df.filter(known).select(a.alias("a"), b.alias("b"), F.col(text_col).alias("text")).distinct()
    sums = termpacks.weighed(model.weights, termpacks.packed_texts(texts, "text", model.shards, parts), model.shards, parts, len(model.classes))
    margins = [F.col(f"w{k}") / F.sqrt("sq") + F.lit(x) for k, x in enumerate(model.intercepts)]
    best = lambda each: F.element_at(  # noqa: E731 - the first of the highest
        F.array(*[F.lit(c) for c in model.classes]), F.array_position(F.array(*each), F.greatest(*each)).cast("int"))
    told = sums.select(F.col("a").alias("_key_a"), F.col("b").alias("_key_b"), best(margins).alias("_told"))
    without = best([F.lit(x) for x in model.intercepts])  # texts of unknown terms
    # rows without a text are spread by their other columns
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != text_col], F.lit(0))
    keyed = df.withColumn("_a", a).withColumn("_b", F.when(known, b).otherwise(spread))
    scored = keyed.join(told, (F.col("_a") == F.col("_key_a")) & (F.col("_b") == F.col("_key_b")), "left")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.when(known, F.coalesce("_told", without)).alias("predicted_severity"))


def fingerprint(rows: DataFrame, *parameters) -> str:
    """Names a table's rows whatever their order: their number, and the sum
    and XOR of their hashes, from one aggregate (with ``parameters``)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], *[F.lit(c) for c in rows.columns])
    got = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")
    ).first()
    text = "|".join(map(str, (got["n"], got["s"], got["x"], *parameters)))
    return hashlib.sha256(text.encode()).hexdigest()[:24]


@dataclass(frozen=True)
class ModelRegistry:
    """K6: fitted pipelines under ``root``, one folder per fingerprint of their
    training rows and parameters.  A folder counts once its mark is written,
    behind the model, so a save cut short is done again."""

    root: str

    def path(self, train: DataFrame, **parameters) -> str:
        return f"{self.root.rstrip('/')}/severity-{fingerprint(train, FORMAT, *sorted(parameters.items()))}"

    def save(self, path: str, model: SeverityModel) -> None:
        spark = model.weights.sparkSession
        model.weights.write.mode("overwrite").parquet(f"{path}/weights")
        head = [(k, name, x, model.shards) for k, (name, x) in enumerate(zip(model.classes, model.intercepts, strict=True))]
        spark.createDataFrame(head, HEAD).coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/saved")

    def load(self, path: str) -> SeverityModel | None:
        spark = SparkSession.active()
        if not path_exists(spark, f"{path}/saved/_SUCCESS"):
            return None
        head = spark.read.schema(HEAD).parquet(f"{path}/classes").orderBy("at").collect()
        weights = spark.read.schema(termpacks.MODEL).parquet(f"{path}/weights")
        return SeverityModel(weights, tuple(r.intercept for r in head), tuple(r["class"] for r in head), head[0].shards)

    def load_or_train(self, train: DataFrame, **parameters) -> SeverityModel:
        """The model of exactly these rows, trained and saved when missing."""
        path = self.path(train, **parameters)
        model = self.load(path)
        if model is None:
            model = train_severity(train, **parameters)
            self.save(path, model)
        return model


def train_with_report(
    labelled: DataFrame, label: str = LABEL, id_col: str = "case_id", text_col: str = "narrative", **kw
) -> tuple[SeverityModel, DataFrame]:
    """M6 + M5 + A10: fit on the stratified 80 % of the labelled narratives;
    returns the model and its report on the held-out 20 %."""
    known = labelled.dropna(subset=[text_col, label])
    split = stratified_split(known, label, id_col)
    model = train_severity(split.filter("split = 'train'").drop("split"), text_col, label, **kw)
    scored = score_severity(model, split.filter("split = 'test'").drop("split"), text_col)
    return model, classification_report(scored, label)


# ---------------------------------------------------------------- A9, A10
def label_agreement(scored: DataFrame, label: str = LABEL, pred: str = "predicted_severity") -> DataFrame:
    """Share of scored, labelled rows whose prediction equals the label."""
    # conditional aggregates, not a filter: a filter on the prediction would be
    # pushed below the model stages and re-evaluate the feature pipeline
    both = F.col(label).isNotNull() & F.col(pred).isNotNull()
    hits = F.count_if(both & (F.col(label) == F.col(pred)))
    n = F.count_if(both)
    return scored.agg(
        F.when(n > 0, hits.cast("double") / n.cast("double")).alias("agreement"),
        n.alias("scored_rows"),
    )


def classification_report(
    df: DataFrame,
    y_true: str = LABEL,
    y_pred: str = "predicted_severity",
    labels: Sequence[str] = SEVERITY_ORDER,
    digits: int = 4,
) -> DataFrame:
    """A10: per-class precision/recall/F1/support plus accuracy (or micro avg
    when other labels occur), macro and weighted averages; zero division -> 0.

    Only the k x k confusion counts are aggregated (partial aggregation),
    so the cost is one scan and a tiny shuffle.
    """
    conf = df.groupBy(F.col(y_true).alias("t"), F.col(y_pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    lab = F.array(*[F.lit(x) for x in labels])
    per = []
    for c in labels:
        per += [
            F.sum(F.when((F.col("t") == c) & (F.col("p") == c), F.col("n")).otherwise(0)).alias(f"tp_{c}"),
            F.sum(F.when(F.col("p") == c, F.col("n")).otherwise(0)).alias(f"pp_{c}"),
            F.sum(F.when(F.col("t") == c, F.col("n")).otherwise(0)).alias(f"tt_{c}"),
        ]
    extra = F.sum(F.when(~F.array_contains(lab, F.col("t")) | ~F.array_contains(lab, F.col("p"))
                         | F.col("t").isNull() | F.col("p").isNull(), F.col("n")).otherwise(0))
    tot = conf.agg(*per, F.sum("n").alias("n_all"), extra.alias("n_extra"))

    def div(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))

    def f1(p: Column, r: Column) -> Column:
        return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))

    rows = []
    precs, recs, f1s, sups = [], [], [], []
    for c in labels:
        p = div(F.col(f"tp_{c}"), F.col(f"pp_{c}"))
        r = div(F.col(f"tp_{c}"), F.col(f"tt_{c}"))
        precs.append(p)
        recs.append(r)
        f1s.append(f1(p, r))
        sups.append(F.col(f"tt_{c}"))
        rows.append((F.lit(c), p, r, f1(p, r), F.col(f"tt_{c}")))
    k = float(len(labels))
    support = sum(sups[1:], sups[0])
    tp_all = sum((F.col(f"tp_{c}") for c in labels[1:]), F.col(f"tp_{labels[0]}"))
    pp_all = sum((F.col(f"pp_{c}") for c in labels[1:]), F.col(f"pp_{labels[0]}"))
    micro_p = div(tp_all, pp_all)
    micro_r = div(tp_all, support)
    is_acc = F.col("n_extra") == 0
    rows.append((
        F.when(is_acc, F.lit("accuracy")).otherwise(F.lit("micro avg")),
        F.when(is_acc, F.lit(None).cast("double")).otherwise(micro_p),
        F.when(is_acc, F.lit(None).cast("double")).otherwise(micro_r),
        F.when(is_acc, div(tp_all, F.col("n_all"))).otherwise(f1(micro_p, micro_r)),
        F.when(is_acc, F.col("n_all")).otherwise(support),
    ))
    mean = lambda xs: sum(xs[1:], xs[0]) / k
    rows.append((F.lit("macro avg"), mean(precs), mean(recs), mean(f1s), support))

    def wavg(xs):
        num = sum((x * s for x, s in zip(xs[1:], sups[1:])), xs[0] * sups[0])
        return div(num, support)

    rows.append((F.lit("weighted avg"), wavg(precs), wavg(recs), wavg(f1s), support))
    structs = [
        F.struct(a.alias("label"), F.round(b, digits).alias("precision"), F.round(c, digits).alias("recall"),
                 F.round(d, digits).alias("f1_score"), e.cast("bigint").alias("support"))
        for a, b, c, d, e in rows
    ]
    return tot.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
