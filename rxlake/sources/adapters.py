"""Driver tables -> pharma feed shapes.

The driver ships TPC-H-like tables; these adapters re-express them as the
four pharma feeds (plus the triage, series and narrative inputs) with the
declared feed schemas.  Each DataFrame builder has a DuckDB SQL twin (a CTE
body) used by the oracle checks; both must stay in step.

Join order is chosen for scale: the order-side context (orders ⋈ customer ⋈
nation ⋈ region) is built first at orders grain, lineitem meets part first
and orders last, so the result stays hash-partitioned on ``l_orderkey`` and
the per-case dedup that follows groups on ``(src_orderkey, src_linenumber)``
without another shuffle of lineitem-sized data.  No broadcast hints: Spark
broadcasts nation/region/part only if their measured size is under the
configured threshold, and keeps a sort-merge join beyond it (labels only behind
a checked size, where a query asks for it).

Lineage columns ``src_*`` ride along for dedup tie-breaks and are dropped by
cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.operators.joins import bounded_broadcast
from rxlake.sources.tables import Tables

# ---- fixed values: driver code -> feed domain mappings ---------------------
PRIORITY_TO_SEVERITY = {
    "1-URGENT": "life-threatening",
    "2-HIGH": "severe",
    "3-MEDIUM": "moderate",
}  # anything else -> mild
SERIOUS_PRIORITIES = ["1-URGENT", "2-HIGH"]
STATUS_TO_OUTCOME = {"F": "Fatal", "O": "Recovered"}  # else Unknown
PRIORITY_TO_TRIAL_STATUS = {
    "1-URGENT": "Recruiting",
    "2-HIGH": "Active",
    "3-MEDIUM": "Completed",
}  # else Terminated
STATUS_TO_ENDPOINT = {"F": True, "O": False}  # else null
TRIAL_PHASES = ["Phase I", "Phase II", "Phase III", "Phase IV"]
SEX_CODES = ["M", "F", "U"]
RETURNFLAG_TO_REPORTER = {"R": "Physician", "A": "Pharmacist"}  # else Consumer
LINESTATUS_TO_DELIVERY = {"F": "Delivered"}  # else In Transit
TRIAL_DRUG_MODULUS = 20  # Brand#1..Brand#20 get trials, Brand#21+ none
PATIENT_AGE_MODULUS = 90
PATIENT_AGE_OFFSET = 2
# ---------------------------------------------------------------------------


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def _sql_case(col: str, mapping: dict, default) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + str(v).replace("'", "''") + "'"

    arms = " ".join(f"WHEN {col} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {arms} ELSE {lit(default)} END"


def _case_id(order_key: str, line: str) -> Column:
    return F.concat(F.col(order_key).cast("string"), F.lit("-"), F.col(line).cast("string"))


def geo(t: Tables) -> DataFrame:
    """nation ⋈ region -> (geo_nationkey, geo_country, geo_region)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("geo_nationkey"),
        F.col("n_name").alias("geo_country"),
        F.col("r_name").alias("geo_region"),
    )


GEO_SQL = """SELECT n_nationkey AS geo_nationkey, n_name AS geo_country, r_name AS geo_region
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


def order_context(t: Tables) -> DataFrame:
    """orders ⋈ customer ⋈ geo at orders grain (customer-side country/region)."""
    o = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    g = geo(t)
    return o.join(c, o.o_custkey == c.c_custkey).join(g, F.col("c_nationkey") == g.geo_nationkey)


ORDER_CTX_SQL = f"""SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
         c_mktsegment, geo_country, geo_region
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN ({GEO_SQL}) g ON c_nationkey = g.geo_nationkey"""


# ---------------------------------------------------------------- adverse events
def adverse_events(t: Tables) -> DataFrame:
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag"
    )
    part = t.part.select("p_partkey", "p_brand")
    ctx = order_context(t)
    x = li.join(part, li.l_partkey == part.p_partkey).join(ctx, F.col("l_orderkey") == ctx.o_orderkey)
    return x.select(
        _case_id("l_orderkey", "l_linenumber").alias("case_id"),
        F.col("p_brand").alias("drug_code"),
        F.concat(F.lit("Drug "), F.col("p_brand")).alias("drug_name"),
        F.col("l_shipdate").cast("date").alias("report_date"),
        (F.col("l_partkey") % PATIENT_AGE_MODULUS + PATIENT_AGE_OFFSET).cast("int").alias("patient_age"),
        F.element_at(F.array(*[F.lit(s) for s in SEX_CODES]), (F.col("l_suppkey") % 3 + 1).cast("int")).alias(
            "patient_sex"
        ),
        F.col("geo_country").alias("country"),
        F.col("geo_region").alias("region"),
        _case(F.col("l_returnflag"), RETURNFLAG_TO_REPORTER, "Consumer").alias("reporter_type"),
        F.lit(None).cast("string").alias("narrative"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_SEVERITY, "mild").alias("severity_label"),
        _case(F.col("o_orderstatus"), STATUS_TO_OUTCOME, "Unknown").alias("outcome"),
        F.col("o_orderpriority").isin(*SERIOUS_PRIORITIES).alias("serious_flag"),
        F.col("l_orderkey").alias("src_orderkey"),
        F.col("l_linenumber").alias("src_linenumber"),
        F.col("l_extendedprice").alias("src_price"),
    )


ADVERSE_EVENTS_SQL = f"""SELECT
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS case_id,
    p_brand AS drug_code,
    'Drug ' || p_brand AS drug_name,
    CAST(l_shipdate AS DATE) AS report_date,
    CAST(l_partkey % {PATIENT_AGE_MODULUS} + {PATIENT_AGE_OFFSET} AS INTEGER) AS patient_age,
    ['M','F','U'][CAST(l_suppkey % 3 + 1 AS INTEGER)] AS patient_sex,
    geo_country AS country,
    geo_region AS region,
    {_sql_case('l_returnflag', RETURNFLAG_TO_REPORTER, 'Consumer')} AS reporter_type,
    CAST(NULL AS VARCHAR) AS narrative,
    {_sql_case('o_orderpriority', PRIORITY_TO_SEVERITY, 'mild')} AS severity_label,
    {_sql_case('o_orderstatus', STATUS_TO_OUTCOME, 'Unknown')} AS outcome,
    o_orderpriority IN ('1-URGENT', '2-HIGH') AS serious_flag,
    l_orderkey AS src_orderkey,
    l_linenumber AS src_linenumber,
    l_extendedprice AS src_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN ({ORDER_CTX_SQL}) ctx ON l_orderkey = ctx.o_orderkey"""


# ---------------------------------------------------------------- clinical trials
def clinical_trials(t: Tables) -> DataFrame:
    ctx = order_context(t)
    drug = F.concat(F.lit("Brand#"), (F.col("o_custkey") % TRIAL_DRUG_MODULUS + 1).cast("string"))
    start = F.col("o_orderdate").cast("date")
    return ctx.select(
        F.col("o_orderkey").cast("string").alias("trial_id"),
        drug.alias("drug_code"),
        F.concat(F.lit("Drug "), drug).alias("drug_name"),
        F.col("c_mktsegment").alias("therapeutic_area"),
        F.element_at(F.array(*[F.lit(p) for p in TRIAL_PHASES]), (F.col("o_orderkey") % 4 + 1).cast("int")).alias(
            "phase"
        ),
        _case(F.col("o_orderpriority"), PRIORITY_TO_TRIAL_STATUS, "Terminated").alias("status"),
        F.col("geo_country").alias("site_country"),
        F.col("geo_region").alias("region"),
        start.alias("start_date"),
        F.date_add(start, 730).alias("estimated_completion_date"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("enrolled_patients"),
        _case(F.col("o_orderstatus"), STATUS_TO_ENDPOINT, None).cast("boolean").alias("primary_endpoint_met"),
        F.col("o_orderkey").alias("src_orderkey"),
    )


CLINICAL_TRIALS_SQL = f"""SELECT
    CAST(o_orderkey AS VARCHAR) AS trial_id,
    'Brand#' || CAST(o_custkey % {TRIAL_DRUG_MODULUS} + 1 AS VARCHAR) AS drug_code,
    'Drug Brand#' || CAST(o_custkey % {TRIAL_DRUG_MODULUS} + 1 AS VARCHAR) AS drug_name,
    c_mktsegment AS therapeutic_area,
    ['Phase I','Phase II','Phase III','Phase IV'][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS phase,
    {_sql_case('o_orderpriority', PRIORITY_TO_TRIAL_STATUS, 'Terminated')} AS status,
    geo_country AS site_country,
    geo_region AS region,
    CAST(o_orderdate AS DATE) AS start_date,
    CAST(o_orderdate AS DATE) + 730 AS estimated_completion_date,
    CAST(floor(o_totalprice / 1000) AS INTEGER) AS enrolled_patients,
    CAST({_sql_case('o_orderstatus', STATUS_TO_ENDPOINT, None)} AS BOOLEAN) AS primary_endpoint_met,
    o_orderkey AS src_orderkey
  FROM ({ORDER_CTX_SQL}) ctx"""


# ---------------------------------------------------------------- shipments
def drug_shipments(t: Tables) -> DataFrame:
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_linestatus"
    )
    part = t.part.select("p_partkey", "p_brand", "p_size")
    sup = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    g = geo(t)
    sup_geo = sup.join(g, sup.s_nationkey == g.geo_nationkey)
    x = li.join(sup_geo, F.col("l_suppkey") == sup_geo.s_suppkey).join(part, F.col("l_partkey") == part.p_partkey)
    return x.select(
        _case_id("l_orderkey", "l_linenumber").alias("shipment_id"),
        F.col("p_brand").alias("drug_code"),
        F.concat(F.lit("Drug "), F.col("p_brand")).alias("drug_name"),
        F.col("s_name").alias("origin_facility"),
        F.col("geo_country").alias("destination_country"),
        F.col("geo_region").alias("region"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("int").alias("quantity_units"),
        F.concat(F.lit("B"), F.col("l_orderkey").cast("string")).alias("batch_id"),
        (F.col("p_size") > 25).alias("cold_chain_required"),
        _case(F.col("l_linestatus"), LINESTATUS_TO_DELIVERY, "In Transit").alias("delivery_status"),
        F.col("l_orderkey").alias("src_orderkey"),
        F.col("l_linenumber").alias("src_linenumber"),
    )


DRUG_SHIPMENTS_SQL = f"""SELECT
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
    p_brand AS drug_code,
    'Drug ' || p_brand AS drug_name,
    s_name AS origin_facility,
    geo_country AS destination_country,
    geo_region AS region,
    CAST(l_shipdate AS DATE) AS ship_date,
    CAST(l_quantity AS INTEGER) AS quantity_units,
    'B' || CAST(l_orderkey AS VARCHAR) AS batch_id,
    p_size > 25 AS cold_chain_required,
    {_sql_case('l_linestatus', LINESTATUS_TO_DELIVERY, 'In Transit')} AS delivery_status,
    l_orderkey AS src_orderkey,
    l_linenumber AS src_linenumber
  FROM lineitem
  JOIN (SELECT s_suppkey, s_name, geo_country, geo_region FROM supplier
        JOIN ({GEO_SQL}) g ON s_nationkey = g.geo_nationkey) sg ON l_suppkey = sg.s_suppkey
  JOIN part ON l_partkey = p_partkey"""


# ---------------------------------------------------------------- sales
def drug_sales(t: Tables) -> DataFrame:
    """Monthly commercial sales per brand x customer region (already a sum)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    part = t.part.select("p_partkey", "p_brand")
    ctx = order_context(t).select("o_orderkey", "o_orderdate", "geo_region")
    x = li.join(part, li.l_partkey == part.p_partkey).join(ctx, F.col("l_orderkey") == ctx.o_orderkey)
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (
        x.groupBy(
            F.col("p_brand").alias("drug_code"),
            F.col("geo_region").alias("region"),
            F.date_trunc("month", F.col("o_orderdate")).cast("date").alias("sales_month"),
        )
        .agg(
            F.sum("l_quantity").cast("bigint").alias("units_sold"),
            F.round(F.sum(net), 2).cast("double").alias("revenue_usd"),
        )
        .select(
            "sales_month",
            "drug_code",
            F.concat(F.lit("Drug "), F.col("drug_code")).alias("drug_name"),
            "region",
            "units_sold",
            "revenue_usd",
        )
    )


DRUG_SALES_SQL = f"""SELECT sales_month, drug_code, 'Drug ' || drug_code AS drug_name, region, units_sold, revenue_usd
  FROM (SELECT p_brand AS drug_code, geo_region AS region,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS sales_month,
               CAST(sum(l_quantity) AS BIGINT) AS units_sold,
               CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2)
                    AS DOUBLE) AS revenue_usd
          FROM lineitem JOIN part ON l_partkey = p_partkey
          JOIN ({ORDER_CTX_SQL}) ctx ON l_orderkey = ctx.o_orderkey
         GROUP BY 1, 2, 3) s"""


# ---------------------------------------------------------------- triage reports
def case_reports(t: Tables) -> DataFrame:
    """``events`` as incoming case reports for the real-time triage.

    ``event_type`` plays the outcome (the outcome risk term is ``error``),
    ``props`` the narrative, and purchases are flagged serious.
    """
    e = t.events.select("event_id", "ts", "user_id", "event_type", "props")
    drug = F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string"))
    return e.select(
        F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("case_id"),
        drug.alias("drug_code"),
        F.concat(F.lit("Drug "), drug).alias("drug_name"),
        F.col("ts").cast("date").alias("report_date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("country"),
        F.col("props").alias("narrative"),
        F.col("event_type").alias("outcome"),
        (F.col("event_type") == F.lit("purchase")).alias("serious_flag"),
    )


CASE_REPORTS_SQL = """SELECT
    'EV' || CAST(event_id AS VARCHAR) AS case_id,
    'Brand#' || CAST(user_id % 25 + 1 AS VARCHAR) AS drug_code,
    'Drug Brand#' || CAST(user_id % 25 + 1 AS VARCHAR) AS drug_name,
    CAST(ts AS DATE) AS report_date,
    'U' || CAST(user_id AS VARCHAR) AS country,
    props AS narrative,
    event_type AS outcome,
    event_type = 'purchase' AS serious_flag
  FROM events"""

# outcome term used when ``events`` stand in for case reports
CASE_REPORT_OUTCOME_TERMS = ["error"]


# ---------------------------------------------------------------- forecast series
def shipment_units(t: Tables) -> DataFrame:
    """Shipped units as (series keys, month, units) rows before monthly sum.

    Series = part type x supplier region, all months.  A caller that knows
    of an incomplete last month passes ``complete_through`` to
    ``monthly_units``.
    """
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    part = t.part.select("p_partkey", "p_type")
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    g = geo(t)
    sup_geo = sup.join(g, sup.s_nationkey == g.geo_nationkey).select("s_suppkey", "geo_region")
    x = li.join(part, li.l_partkey == part.p_partkey).join(sup_geo, F.col("l_suppkey") == sup_geo.s_suppkey)
    return x.select(
        F.col("p_type").alias("drug_code"),
        F.col("geo_region").alias("region"),
        F.col("l_shipdate").alias("month"),
        F.col("l_quantity").alias("units"),
    )


SHIPMENT_UNITS_SQL = f"""SELECT p_type AS drug_code, geo_region AS region, l_shipdate AS month, l_quantity AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN (SELECT s_suppkey, geo_region FROM supplier JOIN ({GEO_SQL}) g ON s_nationkey = g.geo_nationkey) sg
    ON l_suppkey = sg.s_suppkey"""


def sparse_units(t: Tables) -> DataFrame:
    """Brand x supplier-nation monthly units: fine-grained series with gaps.

    At this grain many months carry no shipment, which exercises calendar
    regularisation and interpolation over the whole table.
    """
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    part = t.part.select("p_partkey", "p_brand")
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    g = geo(t)
    sup_geo = sup.join(g, sup.s_nationkey == g.geo_nationkey).select("s_suppkey", "geo_country")
    x = li.join(part, li.l_partkey == part.p_partkey).join(sup_geo, F.col("l_suppkey") == sup_geo.s_suppkey)
    return x.select(
        F.col("p_brand").alias("drug_code"),
        F.col("geo_country").alias("region"),
        F.col("l_shipdate").alias("month"),
        F.col("l_quantity").alias("units"),
    )


SPARSE_UNITS_SQL = f"""SELECT p_brand AS drug_code, geo_country AS region, l_shipdate AS month, l_quantity AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN (SELECT s_suppkey, geo_country FROM supplier JOIN ({GEO_SQL}) g ON s_nationkey = g.geo_nationkey) sg
    ON l_suppkey = sg.s_suppkey"""


# ---------------------------------------------------------------- narratives
def labelled_narratives(t: Tables, checked: bool = False) -> DataFrame:
    """documents ⋈ labels -> (case_id, narrative, severity_label); ``checked``:
    labels within the bounds of a broadcast go to the texts, which then stay.

    The two binary labels give four classes in severity order:
    quality & not toxic -> mild, quality & toxic -> moderate,
    low quality & not toxic -> severe, low quality & toxic -> life-threatening.
    """
    d = t.documents.select("doc_id", "text")
    lab = t.labels.select("doc_id", "quality", "toxic")
    x = d.join(bounded_broadcast(lab) if checked else lab, "doc_id")
    cls = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "mild")
        .when((F.col("quality") == 1) & (F.col("toxic") == 1), "moderate")
        .when((F.col("quality") == 0) & (F.col("toxic") == 0), "severe")
        .otherwise("life-threatening")
    )
    return x.select(
        F.col("doc_id").alias("case_id"),
        F.col("text").alias("narrative"),
        cls.alias("severity_label"),
    )


LABELLED_NARRATIVES_SQL = """SELECT d.doc_id AS case_id, text AS narrative,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'mild'
         WHEN quality = 1 AND toxic = 1 THEN 'moderate'
         WHEN quality = 0 AND toxic = 0 THEN 'severe'
         ELSE 'life-threatening' END AS severity_label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def narratives(t: Tables) -> DataFrame:
    """All documents as narratives to score (labelled or not)."""
    return t.documents.select(F.col("doc_id").alias("case_id"), F.col("text").alias("narrative"))


NARRATIVES_SQL = "SELECT doc_id AS case_id, text AS narrative FROM documents"

FATAL_SOURCES = ["src3", "src7"]


def document_reports(t: Tables) -> DataFrame:
    """All documents as incoming reports: those of two sources report a fatal
    outcome, those labelled toxic are flagged serious (unlabelled: unknown)."""
    d = t.documents.select("doc_id", "text", "lang", "source")
    x = d.join(t.labels.select(F.col("doc_id").alias("_id"), "toxic"), F.col("doc_id") == F.col("_id"), "left")
    return x.select(
        F.col("doc_id").alias("case_id"), F.col("source").alias("drug_code"), F.col("source").alias("drug_name"),
        F.col("lang").alias("country"), F.col("text").alias("narrative"),
        F.when(F.col("source").isin(*FATAL_SOURCES), "Fatal").otherwise("Recovered").alias("outcome"),
        (F.col("toxic") == 1).alias("serious_flag"),
    )


DOCUMENT_REPORTS_SQL = f"""SELECT d.doc_id AS case_id, source AS drug_code, source AS drug_name, lang AS country, text AS narrative,
    CASE WHEN source IN ({', '.join(f"'{s}'" for s in FATAL_SOURCES)}) THEN 'Fatal' ELSE 'Recovered' END AS outcome, toxic = 1 AS serious_flag
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
