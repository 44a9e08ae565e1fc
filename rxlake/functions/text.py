"""Narrative tokenisation (M1) as one SQL expression.

Lower-case word tokens of two or more letters/digits/underscores, English
stop words removed, then unigrams followed by adjacent-pair bigrams (pairs
are formed after stop-word removal).  The same expression text runs as a
``SQLTransformer`` stage inside the Spark ML pipeline and, in DuckDB dialect,
in the oracle — one definition, no Python UDF.

The stop-word list is Spark's own English list (the one
``StopWordsRemover`` uses), loaded from Spark rather than restated here.
"""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
_RESOURCE = "org/apache/spark/ml/feature/stopwords/english.txt"


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark's English stop words (``StopWordsRemover.loadDefaultStopWords``)."""
    try:
        from pyspark import SparkContext
        from pyspark.ml.feature import StopWordsRemover

        if SparkContext._active_spark_context is not None:  # noqa: SLF001
            return tuple(StopWordsRemover.loadDefaultStopWords("english"))
    except Exception:  # noqa: BLE001 - fall back to reading the jar resource
        pass
    import pyspark

    dirs = [os.path.join(os.path.dirname(pyspark.__file__), "jars")]
    if os.environ.get("SPARK_HOME"):
        dirs.append(os.path.join(os.environ["SPARK_HOME"], "jars"))
    for d in dirs:
        for jar in glob.glob(os.path.join(d, "spark-mllib_*.jar")):
            with zipfile.ZipFile(jar) as z:
                return tuple(z.read(_RESOURCE).decode("utf-8").split())
    raise RuntimeError("Spark's English stop-word list not found")


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def tokens_sql_spark(text_col: str = "narrative") -> str:
    """Spark SQL: lower-cased tokens with stop words removed (``array<string>``)."""
    stop = _quoted(english_stop_words())
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")  # SQL literal escaping
    toks = f"regexp_extract_all(lower(coalesce({text_col}, '')), '{pattern}', 0)"
    # IN over literals is planned as a hash-set lookup (InSet), not a list scan
    return f"filter({toks}, t -> NOT (t IN ({stop})))"


def terms_sql_spark(tokens_col: str = "tokens") -> str:
    """Spark SQL: unigrams followed by adjacent-pair bigrams of ``tokens_col``."""
    k = tokens_col
    # zip_with over two slices: the lambda never references the token array,
    # so the plan stays linear even if Catalyst inlines the tokens expression
    bigrams = (
        f"CASE WHEN size({k}) >= 2 THEN zip_with(slice({k}, 1, size({k}) - 1), slice({k}, 2, size({k}) - 1), "
        f"(a, b) -> concat(a, ' ', b)) ELSE CAST(array() AS array<string>) END"
    )
    return f"concat({k}, {bigrams})"


def terms_statement(text_col: str = "narrative") -> str:
    """``SQLTransformer`` statement adding ``tokens`` and ``terms`` columns."""
    return (
        f"SELECT *, {terms_sql_spark('tokens')} AS terms "
        f"FROM (SELECT *, {tokens_sql_spark(text_col)} AS tokens FROM __THIS__)"
    )


def tokens_sql_duckdb(text_col: str = "narrative") -> str:
    stop = _quoted(english_stop_words())
    toks = f"regexp_extract_all(lower(coalesce({text_col}, '')), '{TOKEN_PATTERN}')"
    return f"list_filter({toks}, lambda t: NOT list_contains([{stop}], t))"


def terms_sql_duckdb(tokens_col: str = "tokens") -> str:
    k = tokens_col
    return (
        f"list_concat({k}, CASE WHEN len({k}) >= 2 THEN "
        f"list_transform(range(1, len({k})), lambda i: {k}[i] || ' ' || {k}[i + 1]) ELSE [] END)"
    )


def terms_select_duckdb(source: str, text_col: str = "narrative") -> str:
    """DuckDB twin of :func:`terms_statement` over ``source``."""
    return (
        f"SELECT *, {terms_sql_duckdb('tokens')} AS terms "
        f"FROM (SELECT *, {tokens_sql_duckdb(text_col)} AS tokens FROM {source})"
    )
