"""Registered queries: narrative severity.

Deterministic text and sampling operators carry DuckDB oracles; model
fitting/scoring (M5, M7, A9, D4 and the model's A10) are rows-only.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from rxlake.functions.text import terms_select_duckdb, terms_statement
from rxlake.functions.triage import triage_signal_sql
from rxlake.operators import severity as sev
from rxlake.plans.registry import register
from rxlake.plans.staged import Staged, with_ctes
from rxlake.schemas import SEVERITY_ORDER
from rxlake.sources import adapters
from rxlake.sources.tables import Tables
from rxlake.streaming.triage_stream import with_signal

NARR = f"({adapters.LABELLED_NARRATIVES_SQL})"
TERMS_SQL = f"({terms_select_duckdb(NARR)})"
ALL_TERMS_SQL = f"({terms_select_duckdb(f'({adapters.NARRATIVES_SQL})')})"
SEED = sev.DEFAULT_SEED


def _narratives(spark, sf_dir):
    return adapters.labelled_narratives(Tables(spark, sf_dir))


def _terms(spark, sf_dir):
    return SQLTransformer(statement=terms_statement("narrative")).transform(_narratives(spark, sf_dir))


@register(
    "m1_tokenize",
    f"SELECT case_id, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(len(terms) AS INTEGER) AS n_terms, "
    f"md5(array_to_string(terms, ' ')) AS terms_md5 FROM {ALL_TERMS_SQL} x",
)
def m1_tokenize(spark, sf_dir):
    """Terms of every document, labelled or not."""
    docs = adapters.narratives(Tables(spark, sf_dir))
    return SQLTransformer(statement=terms_statement("narrative")).transform(docs).select(
        "case_id", F.size("tokens").alias("n_tokens"), F.size("terms").alias("n_terms"),
        F.md5(F.concat_ws(" ", "terms")).alias("terms_md5"),
    )


def _features(spark, sf_dir):
    """The model's own text features, fitted on the labelled narratives."""
    return sev.fit_features(sev.known_rows(_narratives(spark, sf_dir)))


DF_SQL = f"SELECT term, count(*) AS doc_freq FROM (SELECT DISTINCT case_id, unnest(terms) AS term FROM {TERMS_SQL} x) GROUP BY 1"


IDF_SQL = f"""SELECT term, doc_freq, ln((1 + (SELECT count(*) FROM {NARR} n WHERE narrative IS NOT NULL)) / (1 + doc_freq)) + 1 AS idf
  FROM ({DF_SQL}) WHERE doc_freq >= {sev.MIN_DF}"""


@register("m2_vocabulary", f"SELECT * FROM ({DF_SQL}) WHERE doc_freq >= {sev.MIN_DF}")
def m2_vocabulary(spark, sf_dir):
    """Vocabulary and document frequencies of the fitted features."""
    return _features(spark, sf_dir).vocabulary.select("term", "doc_freq")


@register("m3_smooth_idf", f"SELECT term, doc_freq, round(idf, 6) AS idf FROM ({IDF_SQL})")
def m3_smooth_idf(spark, sf_dir):
    """Weights of the fitted features (to 6 decimals: JVM and C ``ln`` may
    differ in the last bit)."""
    return _features(spark, sf_dir).vocabulary.select("term", "doc_freq", F.round("idf", 6).alias("idf"))


WEIGHTED_SQL = f"""SELECT case_id, term, count(*) * any_value(idf) AS w FROM
  (SELECT case_id, unnest(terms) AS term FROM {TERMS_SQL} x) t JOIN ({IDF_SQL}) i USING (term) GROUP BY 1, 2"""


@register("m3_tfidf_vectors", f"SELECT case_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY case_id)), 6) AS weight FROM ({WEIGHTED_SQL})")
def m3_tfidf_vectors(spark, sf_dir):
    """The vectors that the model is fitted on: tf x idf at length one."""
    known = sev.known_rows(adapters.labelled_narratives(Tables(spark, sf_dir), checked=True))
    rows = sev.weighted_terms(sev.fit_features(known), known)
    return rows.select("case_id", "term", F.round("weight", 6).alias("weight"))


@register(
    "m4_balanced_weights",
    f"SELECT severity_label, count(*) AS n_class, "
    f"CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight FROM {NARR} n GROUP BY 1",
)
def m4_balanced_weights(spark, sf_dir):
    return sev.balanced_weights(_narratives(spark, sf_dir))


SPLIT_SQL = f"""SELECT case_id, narrative, severity_label,
       CASE WHEN rank() OVER (PARTITION BY severity_label
                 ORDER BY md5('{SEED}|' || CAST(case_id AS VARCHAR)), case_id)
                 <= ceil(count(*) OVER (PARTITION BY severity_label) * {sev.TEST_FRACTION})
            THEN 'test' ELSE 'train' END AS split
  FROM {NARR} n"""


@register("m6_stratified_split", f"SELECT case_id, severity_label, split FROM ({SPLIT_SQL}) s")
def m6_stratified_split(spark, sf_dir):
    return sev.stratified_split(_narratives(spark, sf_dir), seed=SEED).select("case_id", "severity_label", "split")


@register(
    "m8_sample_cases",
    f"SELECT case_id, severity_label, md5(narrative) AS narrative_md5 FROM {NARR} n ORDER BY md5('1|' || CAST(case_id AS VARCHAR)), case_id LIMIT 10",
)
def m8_sample_cases(spark, sf_dir):
    """Ten labelled narratives with their labels."""
    sample = sev.sample_cases(_narratives(spark, sf_dir), n=10, seed=1)
    return sample.select("case_id", "severity_label", F.md5(F.col("narrative").cast("binary")).alias("narrative_md5"))


@register("p17_training_rows", f"SELECT severity_label, count(*) AS n FROM {NARR} n WHERE narrative IS NOT NULL GROUP BY 1")
def p17_training_rows(spark, sf_dir):
    """What a fit is given: rows with a text and a known label, per class."""
    return sev.known_rows(_narratives(spark, sf_dir)).groupBy("severity_label").agg(F.count("*").alias("n"))


def _registry(spark) -> sev.ModelRegistry:
    """Saved models in the shared folder (K6)."""
    from rxlake.session import ensure_checkpoint_dir

    return sev.ModelRegistry(f"{ensure_checkpoint_dir(spark).rstrip('/')}/models")


def _split(spark, sf_dir):
    """The split rows, written once: texts meet their labels in one shuffle for
    all passes over them."""
    from rxlake.session import scratch_path

    path = scratch_path(spark, "severity-split")
    rows = sev.stratified_split(_narratives(spark, sf_dir), seed=SEED)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _train_rows(split):
    return split.filter("split = 'train'").drop("split")


def _model(spark, split):
    """The saved model of these train rows, fitted when missing (score mode)."""
    return _registry(spark).load_or_train(_train_rows(split))


@register("m5_train_severity")
def m5_train_severity(spark, sf_dir):
    """Train (and save) on the train split; return holdout predictions."""
    split, registry = _split(spark, sf_dir), _registry(spark)
    train = _train_rows(split)
    model = sev.train_severity(train)
    registry.save(registry.path(train), model)
    return sev.score_severity(model, split.filter("split = 'test'")).select(
        "case_id", "severity_label", "predicted_severity"
    )


@register("k6_model_round_trip", "SELECT doc_id AS case_id, text IS NOT NULL AS predicted, TRUE AS same FROM documents")
def k6_model_round_trip(spark, sf_dir):
    """A model saved and loaded again predicts every document as before."""
    from rxlake.session import scratch_path

    split, copy = _split(spark, sf_dir), sev.ModelRegistry(scratch_path(spark, "models"))
    model, path = _model(spark, split), copy.path(_train_rows(split))
    copy.save(path, model)
    docs = adapters.narratives(Tables(spark, sf_dir))
    once = sev.score_severity(model, docs).withColumnRenamed("predicted_severity", "first")
    twice = sev.score_severity(copy.load(path), once)
    return twice.select(
        "case_id", F.col("first").isNotNull().alias("predicted"), F.col("first").eqNullSafe(F.col("predicted_severity")).alias("same")
    )


@register("a10_classification_report")
def a10_classification_report(spark, sf_dir):
    """Holdout report of the saved model (trained when missing)."""
    split = _split(spark, sf_dir)
    return sev.classification_report(sev.score_severity(_model(spark, split), split.filter("split = 'test'")))


def _scored_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    scored = sev.score_severity(_model(spark, _split(spark, sf_dir)), adapters.narratives(t))
    return scored.join(_narratives(spark, sf_dir).select("case_id", "severity_label"), "case_id", "left")


@register("m7_score_severity")
def m7_score_severity(spark, sf_dir):
    """Score every document with the saved model (trained first if missing)."""
    return _scored_all(spark, sf_dir).select("case_id", "severity_label", "predicted_severity")


@register("m7_scored_rows", f"""SELECT d.case_id, n.severity_label, d.narrative IS NOT NULL AS predicted, d.narrative IS NOT NULL AS known_class
  FROM ({adapters.NARRATIVES_SQL}) d LEFT JOIN {NARR} n ON d.case_id = n.case_id""")
def m7_scored_rows(spark, sf_dir):
    """Which rows M7 gives a class, and that it is one of the four (which one
    is the model's affair)."""
    rows = _scored_all(spark, sf_dir)
    known = F.coalesce(F.col("predicted_severity").isin(*SEVERITY_ORDER), F.lit(False))
    return rows.select("case_id", "severity_label", F.col("predicted_severity").isNotNull().alias("predicted"), known.alias("known_class"))


def _scored_labelled(spark, sf_dir):
    """Agreement only counts labelled rows, so only those are scored."""
    return sev.score_severity(_model(spark, _split(spark, sf_dir)), _narratives(spark, sf_dir))


@register("a9_label_agreement")
def a9_label_agreement(spark, sf_dir):
    return sev.label_agreement(_scored_labelled(spark, sf_dir))


@register("a9_agreement_rows", f"SELECT count(*) AS scored_rows, TRUE AS a_share FROM {NARR} n WHERE narrative IS NOT NULL")
def a9_agreement_rows(spark, sf_dir):
    """The rows that A9 and D4 judge; the agreement is a share of them."""
    got = sev.label_agreement(_scored_labelled(spark, sf_dir))
    return got.select("scored_rows", F.col("agreement").between(0.0, 1.0).alias("a_share"))


@register("a10_report_support", f"""WITH held AS (SELECT severity_label AS label FROM ({SPLIT_SQL}) s WHERE split = 'test')
SELECT l.label, count(h.label) AS support FROM (SELECT unnest({SEVERITY_ORDER!r}) AS label) l LEFT JOIN held h USING (label) GROUP BY 1
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM held)""")
def a10_report_support(spark, sf_dir):
    """The held-out report's rows and supports."""
    return a10_classification_report(spark, sf_dir).select("label", "support")


@register("d4_kpi_classifier_accuracy")
def d4_kpi_classifier_accuracy(spark, sf_dir):
    return sev.label_agreement(_scored_labelled(spark, sf_dir)).select(
        F.round(F.col("agreement") * 100, 1).alias("classifier_accuracy_pct")
    )


def _report_sql(true_col: str, pred_col: str, source: str, labels=SEVERITY_ORDER, digits: int = 4) -> str:
    labs = ", ".join(f"'{x}'" for x in labels)
    per = []
    for c in labels:
        per.append(
            f"SELECT '{c}' AS label, tp, pp, tt FROM (SELECT "
            f"count_if({true_col} = '{c}' AND {pred_col} = '{c}') AS tp, count_if({pred_col} = '{c}') AS pp, "
            f"count_if({true_col} = '{c}') AS tt FROM {source})"
        )
    per_sql = " UNION ALL ".join(per)
    return f"""WITH c AS ({per_sql}),
m AS (SELECT label, CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS p,
             CASE WHEN tt = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / tt END AS r, tt FROM c),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM m),
tot AS (SELECT count(*) AS n_all,
               count_if({true_col} IS NULL OR {pred_col} IS NULL OR {true_col} NOT IN ({labs})
                        OR {pred_col} NOT IN ({labs})) AS n_extra FROM {source}),
agg AS (SELECT sum(tp) AS tp, sum(pp) AS pp, sum(tt) AS tt FROM c),
mic AS (SELECT CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS p,
               CASE WHEN tt = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / tt END AS r, tp, tt FROM agg)
SELECT label, round(p, {digits}) AS precision, round(r, {digits}) AS recall, round(f1, {digits}) AS f1_score,
       CAST(tt AS BIGINT) AS support FROM f
UNION ALL
SELECT CASE WHEN n_extra = 0 THEN 'accuracy' ELSE 'micro avg' END,
       CASE WHEN n_extra = 0 THEN NULL ELSE round(mic.p, {digits}) END,
       CASE WHEN n_extra = 0 THEN NULL ELSE round(mic.r, {digits}) END,
       round(CASE WHEN n_extra = 0 THEN (CASE WHEN n_all = 0 THEN 0.0 ELSE CAST(mic.tp AS DOUBLE) / n_all END)
             ELSE (CASE WHEN mic.p + mic.r = 0 THEN 0.0 ELSE 2 * mic.p * mic.r / (mic.p + mic.r) END) END, {digits}),
       CAST(CASE WHEN n_extra = 0 THEN n_all ELSE mic.tt END AS BIGINT)
  FROM (SELECT *, (SELECT n_all FROM tot) AS n_all, (SELECT n_extra FROM tot) AS n_extra FROM mic) mic
UNION ALL
SELECT 'macro avg', round(sum(p) / {len(labels)}, {digits}), round(sum(r) / {len(labels)}, {digits}),
       round(sum(f1) / {len(labels)}, {digits}), CAST(sum(tt) AS BIGINT) FROM f
UNION ALL
SELECT 'weighted avg',
       round(CASE WHEN sum(tt) = 0 THEN 0.0 ELSE sum(p * tt) / sum(tt) END, {digits}),
       round(CASE WHEN sum(tt) = 0 THEN 0.0 ELSE sum(r * tt) / sum(tt) END, {digits}),
       round(CASE WHEN sum(tt) = 0 THEN 0.0 ELSE sum(f1 * tt) / sum(tt) END, {digits}),
       CAST(sum(tt) AS BIGINT) FROM f"""


TRIAGE_PAIRS = f"(SELECT severity_label, {triage_signal_sql()} AS severity_signal FROM stg_ae)"


@register(
    "a10_report_triage_vs_label",
    with_ctes(f"SELECT * FROM ({_report_sql('severity_label', 'severity_signal', TRIAGE_PAIRS)}) r"),
)
def a10_report_triage_vs_label(spark, sf_dir):
    """A10 on the real-time rule vs the labelled severity of staged cases."""
    stg = Staged(spark, sf_dir).stg_cases
    return sev.classification_report(with_signal(stg), y_pred="severity_signal")


SIGNALLED_SQL = f"SELECT *, {triage_signal_sql()} AS severity_signal FROM ({adapters.DOCUMENT_REPORTS_SQL}) r"


def _reconciled(spark, sf_dir):
    from rxlake.streaming.triage_stream import alerts, reconcile_alerts

    t = Tables(spark, sf_dir)
    scored = sev.score_severity(_model(spark, _split(spark, sf_dir)), adapters.narratives(t))
    return reconcile_alerts(alerts(adapters.document_reports(t)), scored, label_col="predicted_severity")


@register("j5_reconcile_alerts_vs_model")
def j5_reconcile_alerts_vs_model(spark, sf_dir):
    """J5 against the nightly model: the real-time rule run over every
    document as a report, reconciled with the saved model's class of it."""
    return _reconciled(spark, sf_dir)


@register("j5_alert_side", f"SELECT case_id, severity_signal, TRUE AS agreed FROM ({SIGNALLED_SQL}) s WHERE severity_signal <> 'routine'")
def j5_alert_side(spark, sf_dir):
    """J5 against the model, the part that SQL can tell: every alert is in the
    result once, under ``both`` or ``alert_only``."""
    rows = _reconciled(spark, sf_dir).filter("severity_signal is not null")
    want = F.when(F.col("batch_class").isNotNull(), "both").otherwise("alert_only")
    return rows.select("case_id", "severity_signal", (F.col("agreement") == want).alias("agreed"))
