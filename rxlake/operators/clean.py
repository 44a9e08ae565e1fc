"""Cleaning: required fields (P1), business-key dedup (A6), audit.

Dedup is an *aggregation*, not a window: ``min(struct(order keys, row))``
per key.  Partial aggregation runs map-side, so a key holding a third of
all rows is reduced to one row per map task before the shuffle, and no
task ever sorts a whole hot group.  The struct carries every column, so
the chosen row is fully deterministic (total order).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.functions.columns import sortable
from rxlake.schemas import FEEDS, FeedSpec

LINEAGE_PREFIX = "src_"


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any required column."""
    return df.dropna(how="any", subset=list(cols))


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]] = (),
    columns: Iterable[str] | None = None,
    told: Iterable[str] = (),
) -> DataFrame:
    """One row per ``keys``; the first row by ``order`` then all columns.

    ``order`` is a list of ``(column, ascending)``; every other column
    follows ascending as the tie-break.  With no keys, exact duplicate rows
    are removed.  Where a caller reads only some ``columns`` (and the keys) the
    compared row ends at the last of them: what lies behind breaks ties between
    rows that agree in all of these.  Columns ``told`` by the keys (one value a
    group) break no tie.
    """
    if not keys:
        rows = df.dropDuplicates()
        return rows if columns is None else rows.select(*[c for c in df.columns if c in set(columns)])
    keys, told = list(keys), set(told)
    kept = set(df.columns if columns is None else columns)
    dtypes = dict(df.dtypes)
    sort_keys = [sortable(F.col(c), dtypes[c], asc).alias(f"_o{i}") for i, (c, asc) in enumerate(order)]
    # rows that tie in ``order`` agree in its columns: these are never compared again,
    # and the ascending ones are read where they lie
    led = {c for c, _ in order}
    read = {c: f"_o{i}" for i, (c, asc) in enumerate(order) if asc and c not in keys}
    compared = [c for c in df.columns if c not in {*keys, *led, *told}]
    while compared and compared[-1] not in kept:
        compared.pop()
    payload = compared + [c for c in df.columns if c in kept and c in led | told and c not in {*keys, *read}]
    row = F.struct(*sort_keys, *[F.col(c) for c in payload]).alias("_best")
    best = df.groupBy(*keys).agg(F.min(row).alias("_best"))
    found = read | {c: c for c in payload}
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{found[c]}").alias(c) for c in df.columns if c in keys or c in kept])


def dedup_sql(source: str, keys: Sequence[str], order: Sequence[tuple[str, bool]], columns: Sequence[str]) -> str:
    """DuckDB twin of :func:`dedup` (``row_number() = 1``, same total order)."""
    if not keys:
        return f"SELECT DISTINCT * FROM {source}"
    payload = [c for c in columns if c not in keys]
    parts = [f"{c} {'ASC' if asc else 'DESC'} NULLS FIRST" for c, asc in order]
    parts += [f"{c} ASC NULLS FIRST" for c in payload]
    cols = ", ".join(columns)
    return (
        f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {', '.join(parts)}) AS _rn FROM {source}) WHERE _rn = 1"
    )


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(LINEAGE_PREFIX)])


def _dedup_plan(df: DataFrame, spec: FeedSpec) -> tuple[list[str], list[tuple[str, bool]]]:
    """Dedup keys and order for a feed.

    When the feed carries the lineage keys its business key was built from
    (``src_orderkey``/``src_linenumber``), group on those: the mapping is
    injective and the upstream join is already partitioned on them.
    """
    keys = list(spec.keys)
    order = list(spec.order)
    if keys and {"src_orderkey", "src_linenumber"} <= set(df.columns):
        keys = ["src_orderkey", "src_linenumber"]
    elif keys and keys == ["trial_id"] and "src_orderkey" in df.columns:
        keys = ["src_orderkey"]
    if "src_price" in df.columns:
        order.append(("src_price", True))
    return keys, order


def clean(df: DataFrame, feed: str | FeedSpec, columns: Iterable[str] | None = None) -> DataFrame:
    """P1 + A6 for a feed; lineage columns are dropped at the end, and those
    not among the ``columns`` a caller reads (unset: it reads all)."""
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    kept = require(df, spec.required)
    keys, order = _dedup_plan(kept, spec)
    told = spec.keys if keys != list(spec.keys) else ()
    rows = drop_lineage(dedup(kept, keys, order, columns, told))
    return rows if columns is None else rows.select(*[c for c in rows.columns if c in set(columns)])


def clean_sql(source: str, feed: str | FeedSpec, columns: Sequence[str]) -> str:
    """DuckDB twin of :func:`clean` over a feed CTE with the given columns."""
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    where = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    keys = list(spec.keys)
    order = list(spec.order)
    if keys and {"src_orderkey", "src_linenumber"} <= set(columns):
        keys = ["src_orderkey", "src_linenumber"]
    elif keys and keys == ["trial_id"] and "src_orderkey" in columns:
        keys = ["src_orderkey"]
    if "src_price" in columns:
        order.append(("src_price", True))
    inner = dedup_sql(f"(SELECT * FROM {source} WHERE {where})", keys, order, columns)
    out = ", ".join(c for c in columns if not c.startswith(LINEAGE_PREFIX))
    return f"SELECT {out} FROM ({inner})"


def load_audit(feeds: dict[str, DataFrame]) -> DataFrame:
    """Rows in, after required-field filter, out, and drops per feed.

    One pass per feed: rows are grouped on the dedup key (all columns for a
    feed without a key), counting all rows and required-complete rows per
    group; rows out = groups holding a required-complete row, which is
    exactly what :func:`clean` keeps.  The grouping shuffle is the one the
    dedup itself needs, and partial aggregation keeps hot keys map-side.
    """
    parts = []
    for name, df in feeds.items():
        spec = FEEDS[name]
        ok = F.lit(True)
        for c in spec.required:
            ok = ok & F.col(c).isNotNull()
        keys, _order = _dedup_plan(df, spec)
        group = keys or [c for c in df.columns if not c.startswith(LINEAGE_PREFIX)]
        per_key = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(ok).alias("_ok"))
        agg = per_key.agg(
            F.sum("_n").cast("bigint").alias("rows_in"),
            F.sum("_ok").cast("bigint").alias("rows_required"),
            F.count_if(F.col("_ok") > 0).cast("bigint").alias("rows_out"),
        )
        parts.append(
            agg.select(
                F.lit(name).alias("feed"),
                "rows_in",
                "rows_out",
                (F.col("rows_in") - F.col("rows_required")).alias("dropped_missing"),
                (F.col("rows_required") - F.col("rows_out")).alias("dropped_duplicate"),
                (F.col("rows_in") - F.col("rows_out")).alias("dropped"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
