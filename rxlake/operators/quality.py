"""Declarative data-quality checks (Q1-Q8) and the orphan-code anti join.

A suite is a list of :class:`Check`.  Every table is read **once**: a row
emits a mark for each row-level check it fails and the value of each column
under a uniqueness or subset check.  The marks of all tables are counted per
(check, value) in one grouped aggregate, whose partial counts collapse codes
and failures before the shuffle.  The report has one row per check:
``(check, table_name, column_name, failing_rows, passed)``.

Null handling: ``not_null`` counts nulls; ``unique`` and ``accepted_values``
ignore nulls (SQL model-test reading); ``range``, ``non_negative``, ``positive`` and
``month_start`` count nulls as failures (a pandas comparison is False on NaN);
``implies`` fails only on an explicit false consequent (pandas ``all`` skips NaN).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | accepted_values | range | non_negative | positive | implies | subset | month_start
    table: str
    column: str
    values: tuple = ()  # accepted values / (lo, hi) / implication antecedent values
    other: str = ""  # implies: consequent column; subset: (table) name of the superset
    other_column: str = ""

    @property
    def name(self) -> str:
        return self.kind


def orphan_codes(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct ``column`` values of ``left`` absent from ``right``."""
    l_codes = left.select(column).distinct()
    r_codes = right.select(column).filter(F.col(column).isNotNull()).distinct()
    return l_codes.join(r_codes, on=column, how="left_anti")


def _row_fail(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "range":
        lo, hi = check.values
        return F.coalesce(~c.between(lo, hi), F.lit(True))
    if check.kind == "non_negative":
        return F.coalesce(c < 0, F.lit(True))
    if check.kind == "positive":
        return F.coalesce(c <= 0, F.lit(True))
    if check.kind == "implies":
        return c.isin(*check.values) & (F.col(check.other) == F.lit(False))
    if check.kind == "month_start":
        return F.coalesce(F.dayofmonth(c) != 1, F.lit(True))
    raise ValueError(check.kind)


ROW_KINDS = {"not_null", "accepted_values", "range", "non_negative", "positive", "implies", "month_start"}


def _marks(name: str, table: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """``no, side, value`` of one table: row check ``no`` emits a null value per
    failing row, a uniqueness or subset check every non-null value (side 1:
    the superset of a subset check)."""
    marks: list[Column] = []

    def mark(no: int, side: int, value: Column, hit: Column) -> None:
        marks.append(F.struct(
            F.lit(no).alias("no"), F.lit(side).alias("side"), value.cast("string").alias("value"),
            F.coalesce(hit, F.lit(False)).alias("hit"),
        ))

    for no, chk in enumerate(checks):
        if chk.kind in ROW_KINDS:
            if chk.table == name:
                mark(no, 0, F.lit(None), _row_fail(chk))
            continue
        if chk.table == name:
            mark(no, 0, F.col(chk.column), F.col(chk.column).isNotNull())
        if chk.kind == "subset" and chk.other == name:
            other = F.col(chk.other_column or chk.column)
            mark(no, 1, other, other.isNotNull())
    if not marks:
        return None
    return table.select(F.explode(F.array(*marks)).alias("m")).filter("m.hit").select("m.no", "m.side", "m.value")


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Evaluate a suite; one report row per check, each table read once."""
    for chk in checks:
        if chk.kind not in ROW_KINDS | {"unique", "subset"}:
            raise ValueError(chk.kind)
    parts = [p for name, table in tables.items() if (p := _marks(name, table, checks)) is not None]
    marks = parts[0]
    for p in parts[1:]:
        marks = marks.unionAll(p)
    values = marks.groupBy("no", "value").agg(F.count("*").alias("rows"), F.max("side").alias("side"))
    numbers = {kind: [n for n, c in enumerate(checks) if c.kind == kind] for kind in ("unique", "subset")}
    failing = (
        F.when(F.col("no").isin(numbers["unique"]), (F.col("rows") > 1).cast("bigint"))  # values held twice
        .when(F.col("no").isin(numbers["subset"]), (F.col("side") == 0).cast("bigint"))  # values on the left only
        .otherwise(F.col("rows"))
    )
    counts = values.groupBy("no").agg(F.sum(failing).alias("failing"))
    suite = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(c.name).alias("check"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"))
        for n, c in enumerate(checks)
    ])
    listed = marks.sparkSession.range(1).select(F.inline(suite))
    report = listed.join(counts, F.col("n") == F.col("no"), "left")
    return report.select(
        "check", "table_name", "column_name", F.coalesce("failing", F.lit(0)).cast("bigint").alias("failing_rows")
    ).withColumn("passed", F.col("failing_rows") == 0)


def failures(report: DataFrame) -> DataFrame:
    """Rows of a report whose check failed."""
    return report.filter(~F.col("passed"))


def assert_passed(report: DataFrame) -> None:
    """Contract-test form: raise listing every failed check.

    The report has one row per check, so collecting it is bounded by the
    size of the suite, not the data.
    """
    bad = failures(report).collect()
    if bad:
        lines = [f"{r.check}({r.table_name}.{r.column_name}): {r.failing_rows} failing" for r in bad]
        raise AssertionError("data-quality checks failed:\n" + "\n".join(lines))


# ---- SQL twin for oracle checks ---------------------------------------------
def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _sql_fail(chk: Check) -> str:
    c = chk.column
    if chk.kind == "not_null":
        return f"{c} IS NULL"
    if chk.kind == "accepted_values":
        return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_sql_lit(v) for v in chk.values)})"
    if chk.kind == "range":
        lo, hi = chk.values
        return f"coalesce(NOT ({c} BETWEEN {lo} AND {hi}), TRUE)"
    if chk.kind == "non_negative":
        return f"coalesce({c} < 0, TRUE)"
    if chk.kind == "positive":
        return f"coalesce({c} <= 0, TRUE)"
    if chk.kind == "implies":
        return f"{c} IN ({', '.join(_sql_lit(v) for v in chk.values)}) AND {chk.other} = FALSE"
    if chk.kind == "month_start":
        return f"coalesce(day({c}) <> 1, TRUE)"
    raise ValueError(chk.kind)


def checks_sql(checks: Sequence[Check], relation: dict[str, str]) -> str:
    """UNION ALL of one SELECT per check; ``relation`` maps table -> SQL name."""
    selects = []
    for chk in checks:
        head = f"SELECT '{chk.name}' AS check, '{chk.table}' AS table_name, '{chk.column}' AS column_name, "
        src = relation[chk.table]
        if chk.kind in ROW_KINDS:
            selects.append(head + f"CAST(count_if({_sql_fail(chk)}) AS BIGINT) AS failing_rows FROM {src}")
        elif chk.kind == "unique":
            selects.append(
                head + f"CAST(count(*) AS BIGINT) AS failing_rows FROM (SELECT {chk.column} FROM {src} "
                f"WHERE {chk.column} IS NOT NULL GROUP BY {chk.column} HAVING count(*) > 1)"
            )
        elif chk.kind == "subset":
            other = relation[chk.other]
            oc = chk.other_column or chk.column
            selects.append(
                head + f"CAST(count(*) AS BIGINT) AS failing_rows FROM (SELECT DISTINCT {chk.column} FROM {src} "
                f"WHERE {chk.column} IS NOT NULL AND {chk.column} NOT IN "
                f"(SELECT {oc} FROM {other} WHERE {oc} IS NOT NULL))"
            )
    body = "\nUNION ALL\n".join(selects)
    return f"SELECT *, failing_rows = 0 AS passed FROM (\n{body}\n)"
