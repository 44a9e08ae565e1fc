"""Rules-based severity triage (P14) and alert message (P15) expressions.

The same Column expressions serve batch (``spark.read``) and streaming
(``readStream``) plans, so both paths give identical signals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxlake.schemas import (
    ALERT_FIELDS,
    ALERT_SUBJECT_MIDDLE,
    ALERT_SUBJECT_PREFIX,
    HIGH_RISK_TERMS,
    OUTCOME_RISK_TERMS,
)


def _any_contains(text: Column, terms: Sequence[str]) -> Column:
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [text.contains(F.lit(t.lower())) for t in terms])


def triage_signal(
    narrative="narrative",
    outcome="outcome",
    serious_flag="serious_flag",
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
) -> Column:
    """P14: 'life-threatening' if a risk stem is in the lower-cased narrative or
    an outcome term in the outcome; else 'severe' if serious_flag is exactly
    true; else 'routine'.  Plain substring match (``non-fatal`` hits ``fatal``)."""
    narrative, outcome, serious_flag = (F.col(c) if isinstance(c, str) else c for c in (narrative, outcome, serious_flag))
    narr = F.lower(F.coalesce(narrative, F.lit("")))
    out = F.lower(F.coalesce(outcome, F.lit("")))
    risky = _any_contains(out, outcome_terms) | _any_contains(narr, terms)
    return (
        F.when(risky, F.lit("life-threatening"))
        .when(F.coalesce(serious_flag, F.lit(False)), F.lit("severe"))
        .otherwise(F.lit("routine"))
    )


def alert_subject(signal="severity_signal", drug_name="drug_name") -> Column:
    """P15 subject: ``[PV ALERT] <SIGNAL> adverse event — <drug name>``
    (a missing name prints as ``None``, as the original f-string did)."""
    return F.concat(
        F.lit(ALERT_SUBJECT_PREFIX),
        F.upper(F.col(signal)),
        F.lit(ALERT_SUBJECT_MIDDLE),
        F.coalesce(F.col(drug_name), F.lit("None")),
    )


def alert_message(fields: Sequence[str] = ALERT_FIELDS) -> Column:
    """P15 body: the alert fields as a JSON object, nulls kept as ``null``."""
    return F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"})


def alert_message_sql(fields: Sequence[str] = ALERT_FIELDS) -> str:
    args = ", ".join(f"'{c}', {c}" for c in fields)
    return f"CAST(json_object({args}) AS VARCHAR)"


def triage_signal_sql(
    narrative="narrative",
    outcome="outcome",
    serious_flag="serious_flag",
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
) -> str:
    narr = f"lower(coalesce({narrative}, ''))"
    out = f"lower(coalesce({outcome}, ''))"
    hits = [f"contains({out}, '{t.lower()}')" for t in outcome_terms] + [
        f"contains({narr}, '{t.lower()}')" for t in terms
    ]
    cond = " OR ".join(hits) if hits else "FALSE"
    return (
        f"CASE WHEN {cond} THEN 'life-threatening' "
        f"WHEN coalesce({serious_flag}, FALSE) THEN 'severe' ELSE 'routine' END"
    )
