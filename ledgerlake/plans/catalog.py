"""Queries over the driver tables, one per operator group.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame built with
the library's operators; ``ORACLE[name]`` is the same result written as plain
SQL for DuckDB (views named like the tables). All queries read whole tables.

Equality conventions (both sides): money is summed as DECIMAL(18,2) and
cast to DOUBLE, ratios are rounded, years/months are INT, counts BIGINT,
dates DATE. No table has NULLs, so NULLs are made with CASE / NULLIF.

How the account-plan vocabulary maps onto the driver tables (line accounts):
company = ``l_returnflag``, header = A,B,D,F,H,I by ``l_linenumber`` (7 has
none), sub = discount points mod 4 and item = tax points, both NULL on open
lines of A/F (or no) headers - the "total rows" of the account plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlake.config import (CASH_EXPENSE_LABEL, CASH_INCOME_LABEL, MONTH_LABELS, MONTH_NAMES, MONTH_SHEETS, PROJECTION_HEADER_LEVELS,
                               PROJECTION_HEADERS, CashConfig, MeasureColumns, MonetaryMethodology, Rule,
                               account_rules)
from ledgerlake.functions.dates import first_of_month, month_number, parse_date, serial_to_date, year_token
from ledgerlake.functions.display import format_amount, panel_title
from ledgerlake.functions.lookup import code_lookup, ordinal
from ledgerlake.functions.numeric import is_finite, lenient_double
from ledgerlake.functions.text import squish, tidy_columns
from ledgerlake.operators.aggregate import first_code, lenient_sum, strict_sum
from ledgerlake.operators.classify import classify, dashboard_facts, normalize_code_keys
from ledgerlake.operators.joins import canonicalize_by_table, null_safe_join, occurrence_join, occurrence_number
from ledgerlake.operators.measures import ReferenceSeries, augment_monetary, reference_checks
from ledgerlake.operators.periods import annualize, complete_years, extrapolate_year, latest, rebase
from ledgerlake.operators.quality import blank_count, domain_check, duplicate_keys, reconcile, reconcile_frames
from ledgerlake.operators.reshape import has_data, literal_frame, require_columns, union_by_name, unpivot
from ledgerlake.operators.windows import running_balance
from ledgerlake.plans import accounts, artifacts, dashboard
from ledgerlake.session import scratch_path
from ledgerlake.sources.cells import header_values, read_cells, text_column
from ledgerlake.sources.contract import Contract, read_required_dataset, verify_contract
from ledgerlake.sources.landed import read_table, write_table
from ledgerlake.streaming import ingest_new_sheets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DEC = "decimal(18,2)"
CODES = ("header_code", "sub_header_code", "item_code")

# Driver methodology: base year of the index and projection year fitted to
# the driver tables (orders run 1995-01 .. 2001-08).
DRIVER_METHOD = MonetaryMethodology(
    base_year=1998, projection_year=2001, first_year=1995,
    annual=MeasureColumns("valor", "valor_base", "valor_usd", "valor_pct_gdp"),
    projection=MeasureColumns("ejecutado", "ejecutado_base", "ejecutado_usd", "ejecutado_pct_gdp"),
    index_value="idx_base", gdp_value="gdp", rate_value="rate")
DRIVER_RULES = account_rules(stock_entity="R")
LINE_HEADERS = ("A", "B", "D", "F", "H", "I")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def money(c) -> Column:
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(DEC))


# ---------------------------------------------------------------------------
# shared derivations (Spark) and their SQL twins
# ---------------------------------------------------------------------------

def line_headers(spark: SparkSession) -> DataFrame:
    """Line number -> header code: a six-row dimension (fixed vocabulary)."""
    return literal_frame(spark, list(enumerate(LINE_HEADERS, start=1)),
                         [("l_linenumber", "int"), ("header_code", "string")])


def line_accounts(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").join(F.broadcast(line_headers(spark)), "l_linenumber", "left")
    header = F.col("header_code")
    total = (F.col("l_linestatus") == "O") & (header.isin("A", "F") | header.isNull())
    sub = F.when(total, F.lit(None).cast("int")).otherwise(F.round(F.col("l_discount") * 100).cast("int") % 4)
    item = F.when(total, F.lit(None).cast("int")).otherwise(F.round(F.col("l_tax") * 100).cast("int"))
    return li.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_shipdate", "l_extendedprice",
                     F.col("l_returnflag").alias("empresa"), header.alias("header_code"),
                     sub.alias("sub_header_code"), item.alias("item_code"),
                     F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))


_H = "['A','B','D','F','H','I'][l_linenumber]"
_TOTAL = f"(l_linestatus = 'O' AND ({_H} IN ('A','F') OR {_H} IS NULL))"
LINE_ACCOUNTS_SQL = f"""
SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_shipdate, l_extendedprice,
       l_returnflag AS empresa, {_H} AS header_code,
       CASE WHEN {_TOTAL} THEN NULL ELSE CAST(round(l_discount * 100) AS INT) % 4 END AS sub_header_code,
       CASE WHEN {_TOTAL} THEN NULL ELSE CAST(round(l_tax * 100) AS INT) END AS item_code,
       CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month
FROM lineitem"""


def rules_sql(rules: tuple[Rule, ...], h="header_code", s="sub_header_code", i="item_code",
              e="empresa") -> tuple[str, str]:
    fill, facet = [], []
    for r in rules:
        cond = [f"{h} = '{r.header}'"]
        if r.sub is not None:
            cond.append(f"{s} = {r.sub}")
        if r.items is not None:
            cond.append(f"{i} IN ({', '.join(map(str, r.items))})")
        if r.entity is not None:
            cond.append(f"{e} = '{r.entity}'")
        c = " AND ".join(cond)
        fill.append(f"WHEN {c} THEN '{r.fill}'")
        facet.append(f"WHEN {c} THEN '{r.facet}'")
    return "CASE " + " ".join(fill) + " END", "CASE " + " ".join(facet) + " END"


FILL_SQL, FACET_SQL = rules_sql(DRIVER_RULES)

NEEDS_ZERO_SQL = ("(coalesce(header_code = 'H', false) OR coalesce(header_code IN ('A','F') AND sub_header_code "
                  "IS NULL AND item_code IS NULL, false) OR coalesce(header_code = 'F' AND item_code = 0, false))")
NORMALIZED_SQL = (f"CASE WHEN {NEEDS_ZERO_SQL} THEN 0 ELSE sub_header_code END AS sub_header_code, "
                  f"CASE WHEN {NEEDS_ZERO_SQL} THEN 0 ELSE item_code END AS item_code")


def driver_refs(spark: SparkSession, sf: str, m: MonetaryMethodology = DRIVER_METHOD) -> ReferenceSeries:
    """Reference series derived from orders (CP-10..CP-13):
    index = monthly totals, complete years only, yearly mean rebased to the
    base year; GDP = quarterly totals, complete years, summed, projection
    year extrapolated; rate = yearly mean of the order amounts (no
    completeness test). Built with the period operators from one monthly
    aggregate of the orders; see :func:`yearly_refs` for the one-frame form."""
    monthly = monthly_orders(spark, sf)
    idx = annualize(monthly, "year", "v", "mean", out="__mean", complete=complete_years(monthly, "year", "month", 12),
                    first_year=m.first_year, last_year=m.projection_year)
    idx = rebase(idx, "year", "__mean", m.base_year, m.index_value).select("year", m.index_value)
    quarterly = monthly.groupBy("year", "quarter").agg(F.sum("v").alias("v"))
    gdp = annualize(quarterly, "year", "v", "sum", out=m.gdp_value,
                    complete=complete_years(quarterly, "year", "quarter", 4),
                    first_year=m.first_year, last_year=m.projection_year)
    gdp = gdp.withColumn(m.gdp_value, F.col(m.gdp_value).cast("double"))
    gdp = extrapolate_year(gdp, "year", m.gdp_value, m.projection_year, m.gdp_growth_for_projection)
    yearly = monthly.where(F.col("year").between(m.first_year, m.projection_year)) \
        .groupBy("year").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    rate = yearly.select("year", (F.col("v").cast("double") / F.col("n")).alias(m.rate_value))
    return ReferenceSeries(idx, gdp, rate)


def monthly_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly sum and count of the orders: a few hundred rows at any scale."""
    return table(spark, sf, "orders") \
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")) \
        .agg(money("o_totalprice").alias("v"), F.count("o_totalprice").alias("n")) \
        .withColumn("quarter", ((F.col("month") - 1) / 3 + 1).cast("int"))


def yearly_refs(spark: SparkSession, sf: str, m: MonetaryMethodology = DRIVER_METHOD) -> ReferenceSeries:
    """The same three series as columns of ONE yearly frame (sums, complete
    months and quarters counted in one aggregate), so facts join it once."""
    projected = spark.range(1).select(F.lit(m.projection_year).alias("year"))
    y = monthly_orders(spark, sf).unionByName(projected, allowMissingColumns=True).groupBy("year").agg(
        F.sum("v").alias("v"), F.sum("n").alias("n"), F.count("month").alias("months"),
        F.countDistinct("quarter").alias("quarters")).where(F.col("year").between(m.first_year, m.projection_year))
    mean = F.when(F.col("months") >= 12, F.col("v").cast("double") / F.col("months"))
    gdp = F.when(F.col("quarters") >= 4, F.col("v").cast("double"))
    y = y.select("year", mean.alias("mean"), gdp.alias("gdp"), (F.col("v").cast("double") / F.col("n")).alias(m.rate_value))
    over = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # years only
    base = F.max(F.when(F.col("year") == m.base_year, F.col("mean"))).over(over)
    last = F.last("gdp", ignorenulls=True).over(over)
    grown = F.when(F.col("year") == m.projection_year, last * F.lit(1.0 + m.gdp_growth_for_projection))
    y = y.select("year", F.try_divide(F.lit(100.0) * F.col("mean"), base).alias(m.index_value),
                 F.coalesce("gdp", grown).alias(m.gdp_value), m.rate_value)
    one = lambda c: y.where(F.col(c).isNotNull()).select("year", c)
    return ReferenceSeries(one(m.index_value), one(m.gdp_value), one(m.rate_value), y)


REFS_SQL = """
od AS (SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
              CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
mo AS (SELECT year, month, sum(p) AS v FROM od GROUP BY ALL),
mdone AS (SELECT year FROM mo GROUP BY year HAVING count(DISTINCT month) >= 12),
ia AS (SELECT year, CAST(sum(v) AS DOUBLE) / count(v) AS m FROM mo
       WHERE year BETWEEN 1995 AND 2001 AND year IN (SELECT year FROM mdone) GROUP BY year),
idx AS (SELECT year, 100 * m / (SELECT max(m) FROM ia WHERE year = 1998) AS idx_base FROM ia),
qu AS (SELECT year, quarter, sum(p) AS v FROM od GROUP BY ALL),
qdone AS (SELECT year FROM qu GROUP BY year HAVING count(DISTINCT quarter) >= 4),
ga AS (SELECT year, CAST(sum(v) AS DOUBLE) AS gdp FROM qu
       WHERE year BETWEEN 1995 AND 2001 AND year IN (SELECT year FROM qdone) GROUP BY year),
gdp AS (SELECT year, gdp FROM ga UNION ALL
        SELECT 2001, arg_max(gdp, year) * 1.025 FROM ga HAVING count(*) FILTER (WHERE year = 2001) = 0
                                                            AND arg_max(gdp, year) IS NOT NULL),
rate AS (SELECT year, CAST(sum(p) AS DOUBLE) / count(p) AS rate FROM od WHERE year BETWEEN 1995 AND 2001 GROUP BY year)
"""

# ---------------------------------------------------------------------------
# q01 tidy source: SRC-01 SRC-08 PRJ-01 PRJ-02
# ---------------------------------------------------------------------------


@register("q01_tidy_source", """
SELECT n_regionkey AS region_key, n_nationkey AS nation_key, n_name AS nation_name FROM nation""")
def q01(spark, sf):
    landed = read_table(spark, f"{sf}/nation.parquet", "parquet")
    untidy = landed.select(F.col("n_nationkey").alias("NationKey"), F.col("n_name").alias("nationName"),
                           F.col("n_regionkey").alias(" Region-Key "))
    return tidy_columns(untidy).select("region_key", "nation_key", "nation_name")


# ---------------------------------------------------------------------------
# q02 / q03 cell grids: SRC-02..SRC-05 JN-01 WN-02 CP-02
# ---------------------------------------------------------------------------

ORDERS_PER_SHEET = 80


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is a value cell of its own: a workbook per run of 80 order
    keys and year, a sheet per month, the order's row by its key, its column
    by region (region key + 2). Header row 6 holds the region names, column 1
    the priority of the order; a total row (95) and a corner title lie outside
    the range to be read. The number of cells follows the orders."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf, "region")
    base = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(r, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.concat(F.lit("book "), F.expr(f"o_orderkey div {ORDERS_PER_SHEET}").cast("string")).alias("workbook"),
                F.year("o_orderdate").alias("year"), month_label_token(F.month("o_orderdate")).alias("sheet"),
                (F.lit(7) + F.col("o_orderkey") % ORDERS_PER_SHEET).cast("int").alias("row"),
                (F.col("r_regionkey") + 2).cast("int").alias("col"), "r_name", "o_orderpriority",
                F.col("o_totalprice").cast("double").alias("p"))
    none_n, none_c = F.lit(None).cast("double"), F.lit(None).cast("string")

    def cell(row, col, numeric=none_n, character=none_c):
        return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), numeric.alias("numeric"),
                        character.alias("character"))
    # headers, corner and total repeat with every order of a sheet; a sheet is
    # resolved from its distinct header cells
    cells = F.explode(F.array(
        cell(F.col("row"), F.col("col"), numeric=F.col("p")), cell(F.lit(6), F.col("col"), character=F.col("r_name")),
        cell(F.col("row"), F.lit(1), character=F.col("o_orderpriority")),
        cell(F.lit(6), F.lit(1), character=F.lit("Prioridad")), cell(F.lit(95), F.col("col"), numeric=F.col("p"))))
    return base.select("workbook", "year", "sheet", cells.alias("x")).select("workbook", "year", "sheet", "x.*")


def month_label_token(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in MONTH_SHEETS]), month)


def row_structure(spark: SparkSession) -> DataFrame:
    """Structure map of the order sheets: sheet row -> account code (a letter
    by row); one row per sheet row."""
    return literal_frame(spark, [(7 + i, "ABDF"[i % 4], None, None) for i in range(ORDERS_PER_SHEET)],
                         [("row", "int"), ("header_code", "string"), ("sub_header_code", "int"),
                          ("item_code", "int")])


def resolve_order_cells(spark, cells: DataFrame) -> DataFrame:
    return accounts.actuals_from_cells(cells, F.broadcast(row_structure(spark)), wide_from_year=1998,
                                       narrow_last_col=5, wide_last_col=6)


Q02_SQL = f"""
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CAST(7 + o_orderkey % {ORDERS_PER_SHEET} AS INT) AS row, r_name AS empresa,
       ['A','B','D','F'][1 + (o_orderkey % {ORDERS_PER_SHEET}) % 4] AS header_code, CAST(o_totalprice AS DOUBLE) AS valor
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
     JOIN region ON r_regionkey = n_regionkey
WHERE year(o_orderdate) >= 1998 OR r_regionkey + 2 <= 5"""


@register("q02_cells_to_fact", Q02_SQL)
def q02(spark, sf):
    facts = resolve_order_cells(spark, order_cells(spark, sf))
    return facts.select("year", "month", "row", "empresa", "header_code", "valor")


@register("q03_multi_period_ingest", Q02_SQL)
def q03(spark, sf):
    """Land the sheets as ``year=/sheet=`` folders in the shared checkpoint
    folder, then ingest every workbook and sheet with ONE read; year and
    month come from the folder tags."""
    path = scratch_path(spark, "landed-order-cells")
    # the cells of a month's folder are spread over tasks by workbook
    cells = order_cells(spark, sf).repartition("year", "sheet", F.pmod(F.hash("workbook"), F.lit(8)))
    write_table(cells, path, partition_by=["year", "sheet"])
    facts = resolve_order_cells(spark, read_cells(spark, path))
    return facts.select("year", "month", "row", "empresa", "header_code", "valor")


# ---------------------------------------------------------------------------
# q04 header tokens: SRC-06 PRJ-11 PRJ-12
# ---------------------------------------------------------------------------

@register("q04_header_tokens", """
WITH q AS (SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY ALL),
mx AS (SELECT max(y) AS my FROM q)
SELECT CAST(y * 4 + q AS INT) AS col,
       ['I','II','III','IV'][q] || ' ' || CAST(y AS VARCHAR) || CASE WHEN y = my THEN '*' ELSE '' END AS header,
       y AS year, CAST(v AS DOUBLE) AS value
FROM q, mx""")
def q04(spark, sf):
    """A headerless text grid of quarterly totals (header row 6 like
    ``IV 2000``, ``*`` marks the provisional latest year; value row 19 as
    text), read back by header regex and year token."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"),
                                          F.col("o_totalprice").cast(DEC).alias("p"))
    q = o.groupBy("y", "q").agg(F.sum("p").alias("v"))
    last = latest(q, "y")
    roman = F.element_at(F.array(*[F.lit(x) for x in ("I", "II", "III", "IV")]), F.col("q"))
    header = F.concat(roman, F.lit(" "), F.col("y").cast("string"), F.when(F.col("y") == last, "*").otherwise(""))
    col = (F.col("y") * 4 + F.col("q")).cast("int")
    sheet = [F.lit("pib").alias("workbook"), F.lit("Valores_C").alias("sheet")]
    # header (row 6) and value (row 19) cells of each quarter in one pass
    cell = F.explode(F.array(F.struct(F.lit(6).alias("row"), header.alias("character")),
                             F.struct(F.lit(19).alias("row"), F.col("v").cast("string").alias("character"))))
    grid = q.select(*sheet, col.alias("col"), cell.alias("c")).select(
        "workbook", "sheet", "c.row", "col", F.lit(None).cast("double").alias("numeric"), "c.character")
    extra = literal_frame(spark, [("pib", "Valores_C", 6, 1, None, "Periodo")],
                          [("workbook", "string"), ("sheet", "string"), ("row", "int"), ("col", "int"),
                           ("numeric", "double"), ("character", "string")])
    cells = grid.unionByName(extra)
    out = header_values(cells, 6, 19, r"^[IVX]+ [0-9]{4}")
    return out.select("col", "header", year_token("header").alias("year"), lenient_double("text").alias("value"))


# ---------------------------------------------------------------------------
# q05 lenient cast: SRC-07 PRJ-12
# ---------------------------------------------------------------------------

_SIZE_TEXT_SQL = """CASE WHEN p_size % 7 = 0 THEN CAST(p_size AS VARCHAR) || ' u'
  WHEN p_size % 7 = 1 THEN CAST(p_size AS VARCHAR) || 'd' WHEN p_size % 7 = 2 THEN CAST(p_size AS VARCHAR) || 'f'
  WHEN p_size = 45 THEN 'NaN' WHEN p_size % 7 = 3 THEN ' ' || CAST(p_size AS VARCHAR) || '.5 '
  WHEN p_size % 7 = 4 THEN CAST(p_size AS VARCHAR) || 'e3' ELSE CAST(p_size AS VARCHAR) END"""


@register("q05_lenient_cast", f"""
WITH t AS (SELECT p_partkey, p_size, {_SIZE_TEXT_SQL} AS size_text FROM part)
SELECT p_partkey, size_text, CASE WHEN size_text <> 'NaN' THEN TRY_CAST(size_text AS DOUBLE) END AS size_value FROM t""")
def q05(spark, sf):
    """A forced-text sheet (header row first; some sizes with a unit, a type
    suffix, ``NaN``, spaces or an exponent), first row skipped, then a lenient
    numeric cast."""
    p = table(spark, sf, "part")
    size, n = F.col("p_size").cast("string"), F.col("p_size") % 7
    text = F.when(n == 0, F.concat(size, F.lit(" u"))).when(n == 1, F.concat(size, F.lit("d"))) \
        .when(n == 2, F.concat(size, F.lit("f"))).when(F.col("p_size") == 45, F.lit("NaN")) \
        .when(n == 3, F.concat(F.lit(" "), size, F.lit(".5 "))).when(n == 4, F.concat(size, F.lit("e3"))).otherwise(size)
    sheet = [F.lit("parts").alias("workbook"), F.lit("sizes").alias("sheet")]
    body = p.select(*sheet, (F.col("p_partkey") + 2).cast("int").alias("row"), F.lit(2).alias("col"),
                    F.lit(None).cast("double").alias("numeric"), text.alias("character"))
    head = literal_frame(spark, [("parts", "sizes", 1, 2, None, "p_size")],
                         [("workbook", "string"), ("sheet", "string"), ("row", "int"), ("col", "int"),
                          ("numeric", "double"), ("character", "string")])
    column = text_column(head.unionByName(body), column=2, skip_rows=1)
    return column.select((F.col("row") - 2).cast("bigint").alias("p_partkey"), F.col("text").alias("size_text"),
                         lenient_double("text").alias("size_value"))


# ---------------------------------------------------------------------------
# q07 unpivot months: PRJ-05 FLT-04 DQ-16 CP-01 CP-14
# ---------------------------------------------------------------------------

@register("q07_unpivot_months", """
WITH g AS (SELECT c_nationkey AS nk, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
                  sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS v
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
keep AS (SELECT nk, year FROM g GROUP BY ALL HAVING bool_or(v IS NOT NULL AND v <> 0)),
grid AS (SELECT nk, year, CAST(m AS INT) AS month FROM keep CROSS JOIN range(1, 13) t(m))
SELECT grid.nk AS c_nationkey, grid.year, grid.month, CAST(g.v AS DOUBLE) AS valor
FROM grid LEFT JOIN g USING (nk, year, month)""")
def q07(spark, sf):
    """Finished-order totals pivoted wide by month name (the layout of a
    budget sheet), rows without data dropped, unpivoted back to long."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    base = o.join(c, o.o_custkey == c.c_custkey).select(
        "c_nationkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast(DEC)).alias("v"))
    wide = base.groupBy("c_nationkey", "year").pivot("m", list(range(1, 13))).agg(F.sum("v"))
    wide = wide.toDF("c_nationkey", "year", *MONTH_NAMES)
    require_columns(wide, MONTH_NAMES, "month sheet")
    kept = wide.where(has_data(list(MONTH_NAMES)))
    long = unpivot(kept, ["c_nationkey", "year"], list(MONTH_NAMES), "mes", "valor")
    return long.select("c_nationkey", "year", month_number("mes", MONTH_NAMES).alias("month"), "valor")


# ---------------------------------------------------------------------------
# q08 month tokens: PRJ-06
# ---------------------------------------------------------------------------

def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@register("q08_month_token", f"""
WITH t AS (SELECT o_orderkey,
  CASE o_orderpriority WHEN '2-HIGH' THEN {_sql_list(MONTH_NAMES)}[month(o_orderdate)]
                       WHEN '3-MEDIUM' THEN {_sql_list(MONTH_LABELS)}[month(o_orderdate)]
                       ELSE {_sql_list(MONTH_SHEETS)}[month(o_orderdate)] END AS token FROM orders)
SELECT o_orderkey, token,
       CAST(coalesce(list_position({_sql_list(MONTH_SHEETS)}, token), list_position({_sql_list(MONTH_NAMES)}, token))
            AS INT) AS month
FROM t""")
def q08(spark, sf):
    """Month tokens in three vocabularies; sheet tokens and month names parse,
    display labels do not (unknown -> NULL)."""
    o = table(spark, sf, "orders")
    m = F.month("o_orderdate")

    def pick(vocab):
        return F.element_at(F.array(*[F.lit(v) for v in vocab]), m)
    token = F.when(F.col("o_orderpriority") == "2-HIGH", pick(MONTH_NAMES)) \
        .when(F.col("o_orderpriority") == "3-MEDIUM", pick(MONTH_LABELS)).otherwise(pick(MONTH_SHEETS))
    t = o.select("o_orderkey", token.alias("token"))
    return t.select("o_orderkey", "token",
                    F.coalesce(month_number("token", MONTH_SHEETS), month_number("token", MONTH_NAMES)).alias("month"))


# ---------------------------------------------------------------------------
# q09 period dates: PRJ-07 PRJ-08
# ---------------------------------------------------------------------------

@register("q09_period_dates", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha, CAST(year(l_shipdate) AS INT) AS year,
       CAST(month(l_shipdate) AS INT) AS month, count(*) AS n_lines, sum(l_quantity) AS quantity
FROM lineitem GROUP BY ALL""")
def q09(spark, sf):
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                                             "l_quantity")
    return li.groupBy(first_of_month("year", "month").alias("fecha"), "year", "month") \
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))


# ---------------------------------------------------------------------------
# q10 date parsing: PRJ-09 PRJ-10 ; q10b annual rate CP-13
# ---------------------------------------------------------------------------

def order_date_texts(spark, sf) -> DataFrame:
    """Order dates as serials (some beyond the calendar or no number) and as
    text in three formats, some with a time after the date."""
    o = table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    p = F.col("o_orderpriority")
    fmt = F.when(p == "1-URGENT", F.date_format(d, "dd-MM-yyyy")) \
        .when(p == "2-HIGH", F.date_format(d, "dd/MM/yyyy")) \
        .when(p == "3-MEDIUM", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00"))) \
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    days = F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")
    serial = F.when(p == "5-LOW", F.lit("1e12")).when(p == "4-NOT SPECIFIED", F.lit("NaN")).otherwise(days)
    return o.select("o_orderkey", "o_totalprice", serial.alias("serial"), fmt.alias("date_text"))


@register("q10_date_parsing", """
SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') THEN CAST(o_orderdate AS DATE) END
         AS from_serial, CAST(o_orderdate AS DATE) AS from_text FROM orders""")
def q10(spark, sf):
    """Order dates written as spreadsheet serials and as text, parsed back."""
    t = order_date_texts(spark, sf)
    return t.select("o_orderkey", serial_to_date("serial").alias("from_serial"),
                    parse_date("date_text").alias("from_text"))


@register("q10b_annual_rate", """
SELECT CAST(year(o_orderdate) AS INT) AS year,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS rate
FROM orders GROUP BY ALL""")
def q10b(spark, sf):
    """Yearly mean of daily quotes read from text dates, no completeness test."""
    t = order_date_texts(spark, sf)
    d = t.select(F.year(parse_date("date_text")).alias("year"), F.col("o_totalprice").cast(DEC).alias("q"))
    return annualize(d, "year", "q", "mean", out="rate").withColumn("rate", F.round("rate", 6))


# ---------------------------------------------------------------------------
# q11 canonical labels: PRJ-13 PRJ-14
# ---------------------------------------------------------------------------

_RAW_TYPE_SQL = ("'  ' || replace(CASE WHEN p_size % 2 = 0 THEN upper(p_type) ELSE lower(p_type) END, ' ', '   ') "
                 "|| ' '")


@register("q11_canonical_labels", f"""
WITH r AS (SELECT p_partkey, {_RAW_TYPE_SQL} AS raw FROM part),
s AS (SELECT p_partkey, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS squished FROM r),
syn AS (SELECT DISTINCT lower(p_type) AS k, p_type AS canonical FROM part WHERE p_size <= 40)
SELECT p_partkey, squished, coalesce(syn.canonical, squished) AS canonical
FROM s LEFT JOIN syn ON syn.k = lower(squished)""")
def q11(spark, sf):
    """Type labels with injected spaces and case changes, squished and
    mapped to their canonical spelling through a synonym table built from
    the part table itself."""
    p = table(spark, sf, "part")
    t = F.when(F.col("p_size") % 2 == 0, F.upper("p_type")).otherwise(F.lower("p_type"))
    raw = p.select("p_partkey", F.concat(F.lit("  "), F.regexp_replace(t, " ", "   "), F.lit(" ")).alias("raw"))
    syn = p.where(F.col("p_size") <= 40).select(F.lower("p_type").alias("key"), F.col("p_type").alias("canonical")) \
        .distinct()
    out = raw.withColumn("squished", squish("raw")).withColumn("canonical", F.col("raw"))
    out = canonicalize_by_table(out, "canonical", syn)
    return out.select("p_partkey", "squished", "canonical")


# ---------------------------------------------------------------------------
# q12 classification: PRJ-16 CP-04
# ---------------------------------------------------------------------------

@register("q12_classify_rules", f"""
WITH a AS ({LINE_ACCOUNTS_SQL}),
c AS (SELECT *, {FILL_SQL} AS fill_col, {FACET_SQL} AS facet_col FROM a)
SELECT empresa, header_code, sub_header_code, item_code, facet_col, fill_col, count(*) AS n
FROM c WHERE fill_col IS NOT NULL AND facet_col IS NOT NULL GROUP BY ALL""")
def q12(spark, sf):
    c = classify(line_accounts(spark, sf), DRIVER_RULES)
    return c.groupBy("empresa", *CODES, "facet_col", "fill_col").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# q13 key normalisation: PRJ-17 FLT-01 CP-05
# ---------------------------------------------------------------------------

@register("q13_normalise_keys", f"""
WITH a AS ({LINE_ACCOUNTS_SQL}),
k AS (SELECT header_code, {NORMALIZED_SQL} FROM a
      WHERE NOT (header_code IS NULL AND sub_header_code IS NULL AND item_code IS NULL))
SELECT header_code, sub_header_code, item_code, count(*) AS n FROM k GROUP BY ALL""")
def q13(spark, sf):
    a = line_accounts(spark, sf).na.drop(how="all", subset=list(CODES))
    return normalize_code_keys(a).groupBy(*CODES).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# q14 ordered codes: PRJ-18 PRJ-19 CP-14
# ---------------------------------------------------------------------------

_HEADER_CASE_SQL = "CASE substr(c_mktsegment, 1, 1) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PROJECTION_HEADERS.items()) + " END"


@register("q14_ordered_codes", f"""
SELECT c_custkey, substr(c_mktsegment, 1, 1) AS code, {_HEADER_CASE_SQL} AS header,
       CAST(list_position({_sql_list(PROJECTION_HEADER_LEVELS)}, {_HEADER_CASE_SQL}) AS INT) AS header_ord
FROM customer""")
def q14(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.substring("c_mktsegment", 1, 1).alias("code"))
    named = c.withColumn("header", code_lookup("code", PROJECTION_HEADERS))
    return named.withColumn("header_ord", ordinal("header", PROJECTION_HEADER_LEVELS))


# ---------------------------------------------------------------------------
# q15 annual totals: FLT-02 FLT-03 AG-02 CP-07
# ---------------------------------------------------------------------------

_BRANCHES_SQL = """(coalesce((header_code = 'A' AND sub_header_code IS NULL AND item_code IS NULL)
 OR (header_code = 'B' AND sub_header_code IS NOT NULL AND item_code IS NOT NULL AND item_code <> 0)
 OR (header_code = 'H' AND sub_header_code = 1)
 OR (header_code = 'D' AND sub_header_code IS NOT NULL AND item_code IS NOT NULL AND item_code <> 0)
 OR (header_code = 'F' AND sub_header_code IS NOT NULL AND item_code IS NOT NULL AND item_code <> 0), false))"""


def annual_line_rows(spark, sf, nullable: bool) -> DataFrame:
    """Classified line accounts of the five annual branches, with nation."""
    a = line_accounts(spark, sf).where(accounts.annual_branches())
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    v = F.col("l_extendedprice").cast(DEC)
    if nullable:
        v = F.when(F.col("l_discount") != 0, v)
    rows = a.join(o, a.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .select(F.col("c_nationkey").alias("nation"), "empresa", "year", *CODES, v.alias("v"))
    return classify(rows, DRIVER_RULES)


_ANNUAL_ROWS_SQL = f"""
a AS ({LINE_ACCOUNTS_SQL}),
b AS (SELECT c_nationkey AS nation, a.*, {{value}} AS v FROM a JOIN orders ON o_orderkey = l_orderkey
      JOIN customer ON c_custkey = o_custkey WHERE {_BRANCHES_SQL}),
c AS (SELECT *, {FILL_SQL} AS fill_col, {FACET_SQL} AS facet_col FROM b),
r AS (SELECT * FROM c WHERE fill_col IS NOT NULL AND facet_col IS NOT NULL)"""


@register("q15_annual_totals", "WITH " + _ANNUAL_ROWS_SQL.format(
    value="CASE WHEN l_discount <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END") + """
SELECT nation, year, facet_col, fill_col,
       CASE WHEN count(*) = count(v) THEN CAST(sum(v) AS DOUBLE) END AS valor
FROM r GROUP BY ALL""")
def q15(spark, sf):
    """Yearly totals by nation, facet and fill; a zero-discount line makes
    its group NULL (strict sum)."""
    rows = annual_line_rows(spark, sf, nullable=True)
    return rows.groupBy("nation", "year", "facet_col", "fill_col") \
        .agg(strict_sum("v").cast("double").alias("valor"))


# ---------------------------------------------------------------------------
# q16 flagship: JN-05 PRJ-04 CP-07 CP-09 (+ q18 reference series)
# ---------------------------------------------------------------------------

Q16_SQL = "WITH " + REFS_SQL + """,
f AS (SELECT n_name AS nation, CAST(year(o_orderdate) AS INT) AS year,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT f.nation, f.year, f.valor, round(100 * f.valor / idx.idx_base, 6) AS valor_base,
       round(f.valor / gdp.gdp, 9) AS valor_pct_gdp, round(f.valor / rate.rate, 6) AS valor_usd
FROM f LEFT JOIN idx USING (year) LEFT JOIN gdp USING (year) LEFT JOIN rate USING (year)"""


def nation_year_totals(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
        .groupBy(F.col("n_name").alias("nation"), F.year("o_orderdate").alias("year")) \
        .agg(money("o_totalprice").cast("double").alias("valor"))


@register("q16_augment_measures", Q16_SQL)
def q16(spark, sf):
    """Flagship: yearly order totals by nation in four measures - nominal,
    constant (index base 1998), share of GDP and 'dollars' - against
    reference series derived from the same orders. 2001 has no complete
    index year, so its constant measure is NULL (``on_missing='null'``;
    the coverage gap is reported by q32)."""
    m = DRIVER_METHOD
    out = augment_monetary(nation_year_totals(spark, sf), "valor", yearly_refs(spark, sf), m, on_missing="null")
    c = m.annual
    return out.select("nation", "year", "valor", F.round(c.constant, 6).alias(c.constant),
                      F.round(c.pct_gdp, 9).alias(c.pct_gdp), F.round(c.usd, 6).alias(c.usd))


# ---------------------------------------------------------------------------
# q17 budget sums with first label: AG-01 JN-02 PRJ-15 CP-03
# ---------------------------------------------------------------------------

_LABEL_EXCEL_SQL = ("CASE WHEN l_discount >= 0.05 THEN 'desc ' || CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) "
                    "END")
_DIM_LABEL_SQL = ("'cuenta ' || header_code || '-' || coalesce(CAST(sub_header_code AS VARCHAR), 'x') || '-' || "
                  "coalesce(CAST(item_code AS VARCHAR), 'x')")


@register("q17_budget_sum_label", f"""
WITH a AS ({LINE_ACCOUNTS_SQL}),
r AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha, {_LABEL_EXCEL_SQL} AS label_excel,
             CASE WHEN l_tax <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS v FROM a),
s AS (SELECT empresa, fecha, header_code, sub_header_code, item_code,
             CAST(coalesce(sum(v), 0) AS DOUBLE) AS valor,
             arg_min(label_excel, (l_orderkey, l_linenumber, l_discount)) FILTER (WHERE label_excel IS NOT NULL)
               AS label_excel
      FROM r GROUP BY ALL),
lm AS (SELECT DISTINCT empresa, header_code, sub_header_code, item_code, {_DIM_LABEL_SQL} AS label
       FROM a WHERE header_code IN ('A', 'B'))
SELECT s.empresa, s.fecha, s.header_code, s.sub_header_code, s.item_code, s.valor,
       coalesce(lm.label, s.label_excel) AS label
FROM s LEFT JOIN lm ON s.empresa IS NOT DISTINCT FROM lm.empresa AND s.header_code IS NOT DISTINCT FROM lm.header_code
  AND s.sub_header_code IS NOT DISTINCT FROM lm.sub_header_code AND s.item_code IS NOT DISTINCT FROM lm.item_code""")
def q17(spark, sf):
    """Monthly sums on nullable account keys (all-NULL sums to 0), the first
    non-NULL source label by line order, and a NULL-safe join to the label
    dimension with fallback to the source label. The first label is kept as a
    number (line order and label code in one), so the aggregation hashes."""
    a = line_accounts(spark, sf)
    code = F.round(F.col("l_discount") * 100).cast("bigint")
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    # lines tie on their order only if they have the same key: the label code decides
    r = a.select("empresa", first_of_month("year", "month").alias("fecha"), *CODES, line.alias("line"),
                 F.when(F.col("l_discount") >= 0.05, code).alias("code"),
                 F.when(F.col("l_tax") != 0, F.col("l_extendedprice").cast(DEC)).alias("v"))
    s = r.groupBy("empresa", "fecha", *CODES).agg(lenient_sum("v", 0).cast("double").alias("valor"),
                                                  first_code("code", "line", 101).alias("code"))
    s = s.withColumn("label_excel", F.concat(F.lit("desc "), F.col("code").cast("string"))).drop("code")
    dim_label = F.concat(F.lit("cuenta "), F.col("header_code"), F.lit("-"),
                         F.coalesce(F.col("sub_header_code").cast("string"), F.lit("x")), F.lit("-"),
                         F.coalesce(F.col("item_code").cast("string"), F.lit("x")))
    dim = a.where(F.col("header_code").isin("A", "B")).select("empresa", *CODES).distinct() \
        .select("empresa", *CODES, dim_label.alias("label"))
    j = null_safe_join(s, dim, ["empresa", *CODES], "left")
    return j.select("empresa", "fecha", *CODES, "valor", F.coalesce("label", "label_excel").alias("label"))


# ---------------------------------------------------------------------------
# q18 reference series: AG-03 AG-04 AG-06 FLT-08 SO-03 UN-02 CP-10..CP-13
# ---------------------------------------------------------------------------

@register("q18_reference_series", "WITH " + REFS_SQL + """
SELECT 'index' AS series, year, round(idx_base, 6) AS value FROM idx
UNION ALL SELECT 'gdp', year, round(gdp, 6) FROM gdp
UNION ALL SELECT 'rate', year, round(rate, 6) FROM rate""")
def q18(spark, sf):
    r = driver_refs(spark, sf)
    m = DRIVER_METHOD
    parts = [(name, df, col) for name, df, col in
             (("index", r.index, m.index_value), ("gdp", r.gdp, m.gdp_value), ("rate", r.rate, m.rate_value))]
    out = None
    for name, df, col in parts:
        one = df.select(F.lit(name).alias("series"), F.col("year").cast("int").alias("year"),
                        F.round(F.col(col).cast("double"), 6).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# q19 occurrence join: WN-01 JN-03 DQ-15 CP-03
# ---------------------------------------------------------------------------

LINE_ORDER = ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus")
_ORDER_SQL = ", ".join(LINE_ORDER)
Q19_CTE = f"""
s AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS occ FROM lineitem),
t AS (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS code,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS occ
      FROM lineitem WHERE l_quantity > 10)"""


def occurrence_sides(spark, sf):
    li = table(spark, sf, "lineitem")
    return li, li.where(F.col("l_quantity") > 10).withColumnRenamed("l_suppkey", "code")


@register("q19_occurrence_join", "WITH " + Q19_CTE + """
SELECT s.k, s.n, CAST(s.occ AS INT) AS occ, s.q, t.code FROM s JOIN t USING (k, n, occ)""")
def q19(spark, sf):
    """The n-th duplicate of each (orderkey, linenumber) paired with the n-th
    row of a filtered template numbered on its own; no group has to fit a task."""
    s, t = occurrence_sides(spark, sf)
    t = t.select("l_orderkey", "l_linenumber", "code", *[F.col(c).alias(f"t_{c}") for c in LINE_ORDER if c in t.columns])
    order = ["code" if c == "l_suppkey" else f"t_{c}" for c in LINE_ORDER]
    j = occurrence_join(s, t, ["l_orderkey", "l_linenumber"], list(LINE_ORDER), order, "occ")
    return j.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "occ",
                    F.col("l_quantity").alias("q"), "code")


@register("q19b_unmatched_rows", "WITH " + Q19_CTE + """
SELECT count(*) AS unmatched_rows FROM s ANTI JOIN t USING (k, n, occ)""")
def q19b(spark, sf):
    by = ["l_orderkey", "l_linenumber"]
    s, t = occurrence_sides(spark, sf)
    s = occurrence_number(s, by, list(LINE_ORDER), "occ")
    t = occurrence_number(t.withColumnRenamed("code", "l_suppkey"), by, list(LINE_ORDER), "occ")
    return s.join(t.select(*by, "occ"), [*by, "occ"], "left_anti").agg(F.count(F.lit(1)).alias("unmatched_rows"))


# ---------------------------------------------------------------------------
# q20 semi join on nullable keys: JN-04 AG-07 CP-08
# ---------------------------------------------------------------------------

def shipped_totals(spark, sf) -> DataFrame:
    a = line_accounts(spark, sf)
    return a.groupBy("empresa", "year", "month", *CODES).agg(money("l_extendedprice").cast("double").alias("valor"))


def ordered_totals(spark, sf) -> DataFrame:
    a = line_accounts(spark, sf).drop("year", "month")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = a.join(o, a.l_orderkey == o.o_orderkey)
    return j.groupBy("empresa", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), *CODES) \
        .agg(money("l_extendedprice").cast("double").alias("valor"))


def period_totals(spark, sf) -> DataFrame:
    """Shipped (by ship month) and ordered (by order month) totals from ONE
    lineitem x orders pass: each line is emitted under both periods and the
    two views are summed in a single shuffle. The totals (a row per company,
    month and account) are landed, so actual, budget, keys and label dimension
    read them and not the facts again."""
    a = line_accounts(spark, sf)
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = a.join(o, a.l_orderkey == o.o_orderkey)
    periods = F.explode(F.array(
        F.struct(F.lit("shipped").alias("view"), F.col("year").alias("y"), F.col("month").alias("m")),
        F.struct(F.lit("ordered").alias("view"), F.year("o_orderdate").alias("y"),
                 F.month("o_orderdate").alias("m"))))
    e = j.select("empresa", *CODES, F.col("l_extendedprice").cast(DEC).alias("p"), periods.alias("per"))
    totals = e.groupBy("per.view", F.col("per.y").alias("year"), F.col("per.m").alias("month"), "empresa", *CODES) \
        .agg(F.sum("p").cast("double").alias("valor"))
    path = scratch_path(spark, "period-totals")
    totals.write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED_SQL = f"""sh AS (SELECT empresa, year, month, header_code, sub_header_code, item_code,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor FROM ({LINE_ACCOUNTS_SQL}) GROUP BY ALL)"""
_ORDERED_SQL = f"""od2 AS (SELECT empresa, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       header_code, sub_header_code, item_code,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
       FROM ({LINE_ACCOUNTS_SQL}) a JOIN orders ON o_orderkey = a.l_orderkey GROUP BY ALL)"""
_NULL_SAFE_6 = " AND ".join(f"x.{k} IS NOT DISTINCT FROM y.{k}"
                            for k in ("empresa", "year", "month", *CODES))


@register("q20_keys_semi", f"""
WITH {_SHIPPED_SQL}, {_ORDERED_SQL},
x AS (SELECT empresa, year, month, header_code, {NORMALIZED_SQL}, valor FROM sh),
y AS (SELECT DISTINCT empresa, year, month, header_code, {NORMALIZED_SQL} FROM od2)
SELECT * FROM x WHERE EXISTS (SELECT 1 FROM y WHERE {_NULL_SAFE_6})""")
def q20(spark, sf):
    """Shipped monthly totals kept only where the same (company, month,
    account) was also ordered - NULL codes matching NULL codes."""
    totals = period_totals(spark, sf)
    shipped = totals.where(F.col("view") == "shipped").drop("view")
    ordered = totals.where(F.col("view") == "ordered").drop("view")
    return accounts.filter_to_keys(shipped, ordered).select("empresa", "year", "month", *CODES, "valor")


# ---------------------------------------------------------------------------
# q21 actual vs budget: PRJ-03 UN-01 AG-07 CP-06 CP-08 ; q22 keep rule
# ---------------------------------------------------------------------------

def account_dimension(spark, sf, accounts_df: DataFrame | None = None) -> DataFrame:
    """Label per (company, normalised account); income rows carry a
    non-canonical spelling on purpose (``otros   ingresos``)."""
    src = accounts_df if accounts_df is not None else line_accounts(spark, sf)
    a = normalize_code_keys(src.select("empresa", *CODES)).distinct()
    label = F.when(F.col("header_code") == "A", F.lit("otros   ingresos")).otherwise(
        F.concat(F.lit("cuenta "), F.coalesce(F.col("header_code"), F.lit("x")), F.lit("-"),
                 F.coalesce(F.col("sub_header_code").cast("string"), F.lit("x")), F.lit("-"),
                 F.coalesce(F.col("item_code").cast("string"), F.lit("x"))))
    return a.select("empresa", *CODES, label.alias("rubro"))


def actual_vs_budget(spark, sf) -> DataFrame:
    totals = period_totals(spark, sf)
    shipped = totals.where(F.col("view") == "shipped").drop("view")
    ordered = totals.where(F.col("view") == "ordered").drop("view")
    b = ordered.select("empresa", *CODES, first_of_month("year", "month").alias("fecha"), "valor")
    return accounts.series_monthly(shipped, b, account_dimension(spark, sf, totals), DRIVER_RULES)


_DIM_SQL = f"""dim AS (SELECT DISTINCT empresa, header_code, {NORMALIZED_SQL} FROM ({LINE_ACCOUNTS_SQL})),
diml AS (SELECT *, CASE WHEN header_code = 'A' THEN 'otros   ingresos' ELSE 'cuenta ' || coalesce(header_code, 'x')
           || '-' || coalesce(CAST(sub_header_code AS VARCHAR), 'x') || '-' || coalesce(CAST(item_code AS VARCHAR), 'x')
           END AS rubro FROM dim)"""


def _standardize_sql(src: str, tipo: str, mult: str) -> str:
    return f"""(SELECT DISTINCT z.empresa, facet_col, fill_col,
   CASE WHEN lower(trim(regexp_replace(dimsel.rubro, '\\s+', ' ', 'g'))) = 'otros ingresos' THEN 'Otros Ingresos'
        ELSE trim(regexp_replace(dimsel.rubro, '\\s+', ' ', 'g')) END AS label,
   z.year, z.month, {mult} * z.valor AS valor, '{tipo}' AS tipo, z.header_code, z.sub_header_code, z.item_code
 FROM (SELECT *, {FILL_SQL} AS fill_col, {FACET_SQL} AS facet_col
       FROM (SELECT empresa, year, month, header_code, {NORMALIZED_SQL}, valor FROM {src})) z
 LEFT JOIN diml dimsel ON z.empresa IS NOT DISTINCT FROM dimsel.empresa
   AND z.header_code IS NOT DISTINCT FROM dimsel.header_code
   AND z.sub_header_code IS NOT DISTINCT FROM dimsel.sub_header_code
   AND z.item_code IS NOT DISTINCT FROM dimsel.item_code
 WHERE fill_col IS NOT NULL AND facet_col IS NOT NULL)"""


Q21_CTE = f"""{_SHIPPED_SQL}, {_ORDERED_SQL}, {_DIM_SQL},
x AS (SELECT empresa, year, month, header_code, {NORMALIZED_SQL}, valor FROM sh),
y AS (SELECT DISTINCT empresa, year, month, header_code, {NORMALIZED_SQL} FROM od2),
xs AS (SELECT * FROM x WHERE EXISTS (SELECT 1 FROM y WHERE {_NULL_SAFE_6})),
u AS ({_standardize_sql('xs', 'Ejecutado', '1e3')} UNION ALL {_standardize_sql('od2', 'Firmado', '1.0')}),
v AS (SELECT make_date(year, month, 1) AS fecha, empresa, facet_col, fill_col, label, valor, tipo,
             header_code, sub_header_code, item_code FROM u)"""


@register("q21_actual_vs_budget", f"WITH {Q21_CTE}\nSELECT * FROM v")
def q21(spark, sf):
    """Shipped (actual, x1e3) vs ordered (budget) monthly totals: actuals cut
    to budget keys, both normalised, classified, labelled (canonical
    spelling), scaled, tagged, deduplicated and unioned."""
    return actual_vs_budget(spark, sf)


@register("q22_keep_rule", f"""WITH {Q21_CTE},
k AS (SELECT fecha, empresa, facet_col, fill_col,
        CASE WHEN facet_col IS NULL THEN NULL WHEN facet_col = 'Resultado' THEN 'Resultado' ELSE label END AS label,
        valor, tipo, header_code, sub_header_code, item_code,
        CASE WHEN header_code = 'A' THEN (sub_header_code = 1 AND item_code = 0) OR (sub_header_code = 2 AND item_code = 0)
             WHEN header_code = 'B' THEN (sub_header_code = 1 AND item_code = 0) OR (sub_header_code = 2 AND item_code <> 0)
                                         OR (sub_header_code = 3 AND item_code = 0)
             WHEN header_code = 'F' THEN (empresa = 'R' AND sub_header_code <> 0) OR (empresa <> 'R' AND sub_header_code = 0)
             ELSE true END AS keep FROM v)
SELECT * FROM k WHERE keep AND abs(valor) > 1""")
def q22(spark, sf):
    """Dashboard keep rule (leaf/total per header), result label override and
    the |valor| > 1 threshold; ``keep`` stays in the output."""
    return dashboard_facts(actual_vs_budget(spark, sf), stock_entity="R")


# ---------------------------------------------------------------------------
# q23 running balance: FLT-09 JN-06 WN-03..05 SO-01 AG-08 CP-15
# ---------------------------------------------------------------------------

@register("q23_running_balance", """
WITH m AS (SELECT c_nationkey AS nk, CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS mov
           FROM orders JOIN customer ON c_custkey = o_custkey
           WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY ALL),
o AS (SELECT c_nationkey AS nk, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS opening FROM customer GROUP BY ALL),
j AS (SELECT m.*, CASE WHEN month(fecha) = 1 THEN opening END AS opening FROM m LEFT JOIN o USING (nk)),
w AS (SELECT *, first_value(opening IGNORE NULLS) OVER (PARTITION BY nk ORDER BY fecha
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS open0,
             sum(mov) OVER (PARTITION BY nk ORDER BY fecha ROWS UNBOUNDED PRECEDING) AS cum FROM j)
SELECT nk, fecha, CAST(CASE WHEN month(fecha) = 1 THEN opening ELSE open0 - cum END AS DOUBLE) AS saldo FROM w""")
def q23(spark, sf):
    """Monthly order movements per nation in the latest year against an
    opening balance (sum of account balances) dated January 1st; the
    balance is computed at the (nation, month) grain, so a hot nation adds
    at most 12 rows to its window partition."""
    return nation_balances(spark, sf)


def entity_key(fanout: int) -> Column:
    """Nation as the entity; with ``fanout`` > 1 every nation is split into
    that many entities by customer (the x100 scale measurement)."""
    if fanout == 1:
        return F.col("c_nationkey")
    return F.col("c_nationkey") * fanout + F.col("c_custkey") % fanout


def year_start(df: DataFrame, column: str, back: int = 0) -> Column:
    """Scalar subquery: the first day of the latest year (or ``back`` years
    before) in the column's own type, so a comparison with it reaches the
    reader as a pushed filter."""
    kind = df.schema[column].dataType
    return df.select(F.add_months(F.trunc(F.max(column), "year"), -12 * back).cast(kind)).scalar()


def nation_balances(spark, sf, fanout: int = 1) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    moves = o.where(F.col("o_orderdate") >= year_start(o, "o_orderdate")).join(
        c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey) \
        .groupBy(entity_key(fanout).alias("nk"), F.trunc("o_orderdate", "month").alias("fecha")) \
        .agg(money("o_totalprice").alias("mov"))
    opening = c.groupBy(entity_key(fanout).alias("nk")).agg(money("c_acctbal").alias("opening")) \
        .withColumn("fecha", year_start(o, "o_orderdate").cast("date"))
    j = moves.join(opening, ["nk", "fecha"], "left")
    bal = running_balance(j, "nk", "fecha", "mov", "opening")
    return bal.select("nk", "fecha", F.col("saldo").cast("double").alias("saldo"))


# ---------------------------------------------------------------------------
# q24 minimum balance: FLT-09 JN-07 AG-10 CP-15 CP-19
# ---------------------------------------------------------------------------

INCOME_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
EXPENSE_SEGMENTS = ("HOUSEHOLD", "MACHINERY")


@register("q24_minimum_balance", """
WITH ly AS (SELECT max(year(o_orderdate)) AS y FROM orders),
oc AS (SELECT c_mktsegment AS seg, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS p
       FROM orders JOIN customer ON c_custkey = o_custkey),
m AS (SELECT seg, CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, sum(p) AS mov FROM oc
      WHERE year(o_orderdate) = (SELECT y FROM ly) GROUP BY ALL),
op AS (SELECT c_mktsegment AS seg, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS opening FROM customer GROUP BY ALL),
j AS (SELECT m.*, CASE WHEN month(fecha) = 1 THEN opening END AS opening FROM m LEFT JOIN op USING (seg)),
w AS (SELECT *, first_value(opening IGNORE NULLS) OVER (PARTITION BY seg ORDER BY fecha
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS open0,
             sum(mov) OVER (PARTITION BY seg ORDER BY fecha ROWS UNBOUNDED PRECEDING) AS cum FROM j),
inc AS (SELECT seg, CAST(sum(p) AS DOUBLE) / 12.0 AS saldo_minimo_ingresos FROM oc
        WHERE year(o_orderdate) = (SELECT y FROM ly) - 1 GROUP BY seg),
gas AS (SELECT c_mktsegment AS seg, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / 1e3 AS saldo_minimo_gastos
        FROM customer GROUP BY c_mktsegment)
SELECT w.seg AS segment, fecha, CAST(CASE WHEN month(fecha) = 1 THEN opening ELSE open0 - cum END AS DOUBLE) AS saldo,
       gas.saldo_minimo_gastos, inc.saldo_minimo_ingresos,
       1e3 * CASE WHEN w.seg IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN inc.saldo_minimo_ingresos
                  WHEN w.seg IN ('HOUSEHOLD', 'MACHINERY') THEN gas.saldo_minimo_gastos END AS saldo_minimo,
       CASE WHEN w.seg IN ('HOUSEHOLD', 'MACHINERY') THEN 'Un mes de Gastos + Impuestos'
            WHEN w.seg IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'Un mes de Ingresos ' END AS linea_label
FROM w LEFT JOIN gas USING (seg) LEFT JOIN inc USING (seg)""")
def q24(spark, sf):
    """Cash balance per market segment with its minimum: one month of the
    previous year's orders (income class) or a fixed amount from the account
    balances (expense class), plus the threshold label of the cash view."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    first = year_start(o, "o_orderdate").cast("date")
    # the last two years of orders, summed once by segment and month
    sums = o.where(F.col("o_orderdate") >= year_start(o, "o_orderdate", 1)).join(
        c.select("c_custkey", "c_mktsegment"), o.o_custkey == c.c_custkey) \
        .groupBy(F.col("c_mktsegment").alias("segment"), F.trunc("o_orderdate", "month").alias("fecha")) \
        .agg(strict_sum(F.col("o_totalprice").cast(DEC)).alias("p"), money("o_totalprice").alias("mov"))
    moves = sums.where(F.col("fecha") >= first).select("segment", "fecha", "mov")
    opening = c.groupBy(F.col("c_mktsegment").alias("segment")).agg(money("c_acctbal").alias("opening")) \
        .withColumn("fecha", first)
    bal = running_balance(moves.join(opening, ["segment", "fecha"], "left"), "segment", "fecha", "mov", "opening")
    income = sums.where(F.col("fecha") < first).groupBy("segment") \
        .agg((strict_sum("p").cast("double") / F.lit(12.0)).alias("saldo_minimo_ingresos"))
    fixed = c.groupBy(F.col("c_mktsegment").alias("segment")) \
        .agg((money("c_acctbal").cast("double") / F.lit(1e3)).alias("saldo_minimo_gastos"))
    out = bal.select("segment", "fecha", F.col("saldo").cast("double").alias("saldo")) \
        .join(fixed, "segment", "left").join(income, "segment", "left")
    seg = F.col("segment")
    minimum = F.when(seg.isin(*INCOME_SEGMENTS), F.col("saldo_minimo_ingresos")) \
        .when(seg.isin(*EXPENSE_SEGMENTS), F.col("saldo_minimo_gastos"))
    line = F.when(seg.isin(*EXPENSE_SEGMENTS), F.lit(CASH_EXPENSE_LABEL)) \
        .when(seg.isin(*INCOME_SEGMENTS), F.lit(CASH_INCOME_LABEL))
    return out.select("segment", "fecha", "saldo", "saldo_minimo_gastos", "saldo_minimo_ingresos",
                      (F.lit(1e3) * minimum).alias("saldo_minimo"), line.alias("linea_label"))


# ---------------------------------------------------------------------------
# q25 KPIs / q26 display: PRJ-20 PRJ-21 PRJ-22 AG-02 AG-11 CP-17
# ---------------------------------------------------------------------------

def annual_line_series(spark, sf) -> DataFrame:
    """Yearly line totals by company, facet and fill in four measures (the
    annual series of the account plan over the driver tables)."""
    m = DRIVER_METHOD
    a = line_accounts(spark, sf).where(accounts.annual_branches()).withColumn("v", F.col("l_extendedprice").cast(DEC))
    rows = classify(a, DRIVER_RULES)
    sums = rows.groupBy("empresa", "year", "facet_col", "fill_col").agg(strict_sum("v").cast("double").alias("valor"))
    out = augment_monetary(sums, "valor", yearly_refs(spark, sf), m, on_missing="null")
    c = m.annual
    return out.select("empresa", "year", "facet_col", "fill_col", "valor", F.round(c.constant, 6).alias(c.constant),
                      F.round(c.pct_gdp, 9).alias(c.pct_gdp), F.round(c.usd, 6).alias(c.usd))


_SERIES_SQL = "WITH " + REFS_SQL + "," + _ANNUAL_ROWS_SQL.format(
    value="CAST(l_extendedprice AS DECIMAL(18,2))") + """,
s AS (SELECT empresa, year, facet_col, fill_col,
             CASE WHEN count(*) = count(v) THEN CAST(sum(v) AS DOUBLE) END AS valor FROM r GROUP BY ALL),
ser AS (SELECT s.*, round(100 * s.valor / idx.idx_base, 6) AS valor_base, round(s.valor / gdp.gdp, 9) AS valor_pct_gdp,
               round(s.valor / rate.rate, 6) AS valor_usd
        FROM s LEFT JOIN idx USING (year) LEFT JOIN gdp USING (year) LEFT JOIN rate USING (year))"""

KPI_UNITS = {"valor": 2, "valor_usd": 6, "valor_base": 6, "valor_pct_gdp": 9}
DRIVER_DISPLAY = {"valor": ("money", "$ "), "valor_base": ("money", "$ "), "valor_usd": ("money", "US$ "),
                  "valor_pct_gdp": ("percent", "")}


def _kpi_sql(unit: str, scale: int) -> str:
    return f"""SELECT facet_col, '{unit}' AS unit,
  CASE WHEN count(*) = count({unit}) THEN CAST(sum(CAST({unit} AS DECIMAL(38,{scale}))) AS DOUBLE) END AS total
  FROM ser WHERE year = (SELECT max(year) FROM ser) GROUP BY facet_col"""


@register("q25_kpis_by_measure", _SERIES_SQL + "\n" + _kpi_sql("valor_usd", 6))
def q25(spark, sf):
    """Latest-year total per facet in the chosen measure (US$), five KPIs in
    one grouped aggregate; summed exactly at the measure's precision."""
    d = annual_line_series(spark, sf).withColumn("valor_usd", F.col("valor_usd").cast("decimal(38,6)"))
    out = dashboard.kpi_totals(d, "valor_usd", DRIVER_METHOD)
    return out.select("facet_col", F.lit("valor_usd").alias("unit"), F.col("total").cast("double").alias("total"))


def _fmt_sql(x: str, unit: str) -> str:
    if unit == "valor_pct_gdp":
        mag = f"format('{{:,.2f}}', round(abs({x}) * 100, 2))"
        return f"CASE WHEN {x} IS NOT NULL THEN (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || translate({mag}, ',.', '.,') || '%' END"
    prefix = "US$ " if unit == "valor_usd" else "$ "
    mag = f"format('{{:,.0f}}', round(abs({x}) * 1e-6, 0))"
    return (f"CASE WHEN {x} IS NOT NULL THEN (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || '{prefix}' || "
            f"translate({mag}, ',.', '.,') END")


@register("q26_display_amounts", _SERIES_SQL + ",\nk AS (" + "\nUNION ALL ".join(
    _kpi_sql(u, s) for u, s in KPI_UNITS.items()) + ")\nSELECT facet_col, unit, total, CASE unit " + " ".join(
    f"WHEN '{u}' THEN {_fmt_sql('total', u)}" for u in KPI_UNITS) + " END AS label FROM k")
def q26(spark, sf):
    """KPI totals of every measure formatted for display (millions,
    ``.``/``,`` separators, US$ prefix, percent with two decimals)."""
    series = annual_line_series(spark, sf)
    sums = series.where(F.col("year") == latest(series, "year")).groupBy("facet_col").agg(
        *[strict_sum(F.col(u).cast(f"decimal(38,{scale})")).cast("double").alias(u) for u, scale in KPI_UNITS.items()])
    out = sums.unpivot("facet_col", list(KPI_UNITS), "unit", "total")
    label = None
    for u in KPI_UNITS:
        text = format_amount("total", u, DRIVER_DISPLAY)
        label = F.when(F.col("unit") == u, text) if label is None else label.when(F.col("unit") == u, text)
    return out.withColumn("label", label)


# ---------------------------------------------------------------------------
# q27 gap-filled grid / q28 ordered facets: JN-08 JN-09 FLT-07 AG-09 SO-02 CP-18
# ---------------------------------------------------------------------------

def latest_year_order_facts(spark, sf, fanout: int = 1) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf, "region")
    j = o.where(F.col("o_orderdate") >= year_start(o, "o_orderdate")).join(c, o.o_custkey == c.c_custkey) \
        .join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    tipo = F.when(F.col("o_orderstatus") == "F", F.lit("Ejecutado")).otherwise(F.lit("Firmado"))
    # monthly facts (region x priority x segment x month x type: small) read
    # by the label order, the template and the gap fill - computed once
    company = F.col("r_name") if fanout == 1 else \
        F.concat(F.col("r_name"), F.lit("-"), (F.col("c_custkey") % fanout).cast("string"))
    return j.groupBy(company.alias("empresa"), F.col("o_orderpriority").alias("facet_col"),
                     F.col("c_mktsegment").alias("label"), F.trunc("o_orderdate", "month").alias("fecha"),
                     tipo.alias("tipo")).agg(money("o_totalprice").cast("double").alias("valor"))


_GRID_FACTS_SQL = """f AS (SELECT r_name AS empresa, o_orderpriority AS facet_col, c_mktsegment AS label,
        CAST(month(o_orderdate) AS INT) AS month, CASE WHEN o_orderstatus = 'F' THEN 'Ejecutado' ELSE 'Firmado' END AS tipo,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
           JOIN region ON r_regionkey = n_regionkey
      WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY ALL),
sz AS (SELECT empresa, facet_col, label, max(abs(valor)) AS facet_size FROM f GROUP BY ALL),
ord AS (SELECT *, CAST(row_number() OVER (PARTITION BY empresa, facet_col ORDER BY facet_size DESC, label) AS INT)
          AS label_ord FROM sz)"""


@register("q27_gap_filled_grid", f"""WITH {_GRID_FACTS_SQL},
t AS (SELECT empresa, facet_col, label, label_ord, CAST(m AS INT) AS month, tipo
      FROM ord CROSS JOIN range(1, 13) mm(m) CROSS JOIN (VALUES ('Ejecutado'), ('Firmado')) tt(tipo))
SELECT t.empresa, t.facet_col, t.label, t.label_ord, t.month, t.tipo, coalesce(f.valor, 0) AS valor,
       f.valor IS NOT NULL AS observed,
       CASE WHEN f.valor IS NOT NULL THEN {_fmt_sql('f.valor', 'valor')} END AS tooltip,
       CAST(CASE WHEN f.valor IS NOT NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) AS alpha_value,
       {_sql_list(MONTH_LABELS)}[t.month] AS month_label
FROM t LEFT JOIN f USING (empresa, facet_col, label, month, tipo)""")
def q27(spark, sf):
    """Per region and priority: segments ordered by size, each with all 12
    months x 2 types; months the latest (incomplete) year lacks are 0 with
    ``observed`` FALSE. The template is generated per label, not by a cross
    join."""
    g = dashboard.monthly_grid(latest_year_order_facts(spark, sf))
    return g.select("empresa", "facet_col", "label", "label_ord", "month", "tipo", "valor", "observed", "tooltip",
                    "alpha_value", "month_label")


@register("q28_ordered_facets", f"WITH {_GRID_FACTS_SQL}\nSELECT * FROM ord")
def q28(spark, sf):
    """Label order per (company, facet) by max |value| (ties by label), finite values only."""
    f = latest_year_order_facts(spark, sf).where(is_finite("valor"))
    return dashboard.label_order(f)


# ---------------------------------------------------------------------------
# q29 latest period + title: AG-12 PRJ-23
# ---------------------------------------------------------------------------

@register("q29_latest_period", """
WITH d AS (SELECT c_nationkey AS nk, CAST(o_orderdate AS DATE) AS fecha FROM orders JOIN customer ON c_custkey = o_custkey
           UNION ALL
           SELECT c_nationkey, CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           JOIN customer ON c_custkey = o_custkey),
m AS (SELECT nk, max(fecha) AS latest_date FROM d GROUP BY nk)
SELECT n_name AS nation, latest_date, CAST(year(latest_date) AS INT) AS year,
       n_name || ' - Ingresos Corrientes ' || CAST(year(latest_date) AS VARCHAR) AS title
FROM m JOIN nation ON n_nationkey = nk""")
def q29(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    a = oc.select(F.col("c_nationkey").alias("empresa"), F.to_date("o_orderdate").alias("fecha"))
    b = li.join(oc.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select(F.col("c_nationkey").alias("empresa"), F.to_date("l_shipdate").alias("fecha"))
    m = dashboard.latest_company_year(a, b, "empresa", "fecha")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = m.join(n, F.col("empresa") == F.col("n_nationkey"))
    return j.select(F.col("n_name").alias("nation"), "latest_date", "year",
                    panel_title("n_name", F.lit("Ingresos"), F.col("year")).alias("title"))


# ---------------------------------------------------------------------------
# q30 blank labels: DQ-07
# ---------------------------------------------------------------------------

@register("q30_blank_labels", """
SELECT 'part' AS tbl, count(*) AS n_rows,
       count(*) FILTER (WHERE lbl IS NULL OR trim(lbl) = '') AS n_bad
FROM (SELECT CASE WHEN p_size > 45 THEN '  ' ELSE p_name END AS lbl FROM part)
UNION ALL
SELECT 'customer', count(*), count(*) FILTER (WHERE lbl IS NULL OR trim(lbl) = '')
FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS lbl FROM customer)
UNION ALL
SELECT 'supplier', count(*), count(*) FILTER (WHERE lbl IS NULL OR trim(lbl) = '')
FROM (SELECT s_name AS lbl FROM supplier)""")
def q30(spark, sf):
    part = table(spark, sf, "part").select(F.when(F.col("p_size") > 45, F.lit("  ")).otherwise(F.col("p_name"))
                                           .alias("lbl"))
    cust = table(spark, sf, "customer").select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
                                               .alias("lbl"))
    supp = table(spark, sf, "supplier").select(F.col("s_name").alias("lbl"))
    out = None
    for name, df in (("part", part), ("customer", cust), ("supplier", supp)):
        one = blank_count(df, "lbl").select(F.lit(name).alias("tbl"), "n_rows", "n_bad")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# q31 duplicate keys: AG-05 DQ-03 DQ-08
# ---------------------------------------------------------------------------

@register("q31_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q31(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# q32 reference checks: DQ-09..DQ-13 JN-10 UN-03
# ---------------------------------------------------------------------------

def _checks_sql(name: str, cte: str, col: str, base: int | None) -> str:
    rows = [
        f"SELECT '{name}' AS series, 'columns' AS \"check\", true AS passed, '' AS detail",
        f"""SELECT '{name}', 'unique_years', NOT (count(year) - count(DISTINCT year) > 0 OR count(*) - count(year) > 1),
            CASE WHEN count(year) - count(DISTINCT year) > 0 OR count(*) - count(year) > 1
                 THEN 'Reference series ''{name}'' has duplicate years.' ELSE '' END FROM {cte}""",
        f"""SELECT '{name}', 'non_null_years', count(*) = count(year),
            CASE WHEN count(*) > count(year) THEN 'Reference series ''{name}'' has missing years.' ELSE '' END FROM {cte}""",
        f"""SELECT '{name}', 'non_null_values', count({col}) = count(*),
            CASE WHEN count({col}) < count(*) THEN 'Reference series ''{name}'' has missing values in column ''{col}''.'
                 ELSE '' END FROM {cte}""",
        f"""SELECT '{name}', 'positive_values', count(*) FILTER (WHERE {col} <= 0) = 0,
            CASE WHEN count(*) FILTER (WHERE {col} <= 0) > 0
                 THEN 'Reference series ''{name}'' must be strictly positive in column ''{col}''.' ELSE '' END
            FROM {cte}""",
    ]
    if base is not None:
        rows.append(f"""SELECT '{name}', 'base_year', coalesce(bool_or(year = {base}), false),
            CASE WHEN coalesce(bool_or(year = {base}), false) THEN ''
                 ELSE 'IPC reference series does not include the base year {base}.' END FROM {cte}""")
    rows.append(f"""SELECT '{name}', 'required_years', count(*) = 0,
            CASE WHEN count(*) > 0 THEN 'Reference series ''{name}'' is missing required years: '
                 || string_agg(CAST(year AS VARCHAR), ', ' ORDER BY CAST(year AS VARCHAR)) ELSE '' END
            FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders
                  WHERE year NOT IN (SELECT year FROM {cte}))""")
    return "\nUNION ALL ".join(rows)


@register("q32_reference_checks", "WITH " + REFS_SQL + "\n" + "\nUNION ALL ".join([
    _checks_sql("ipc_anual", "idx", "idx_base", 1998),
    _checks_sql("pib_nominal_anual", "gdp", "gdp", None),
    _checks_sql("dolar_promedio_anual", "rate", "rate", None)]))
def q32(spark, sf):
    """Every reference-series check as a row; the index lacks the incomplete
    year 2001 that the facts need."""
    facts = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return reference_checks(yearly_refs(spark, sf), facts, DRIVER_METHOD)


# ---------------------------------------------------------------------------
# q33 contract report: SRC-09 DQ-01..DQ-06
# ---------------------------------------------------------------------------

def driver_contract(sf: str) -> Contract:
    doc = {"required_datasets": [
        {"id": "orders", "output_path": "orders.parquet", "format": "parquet", "produced_by": "driver",
         "minimum_schema": {"required_columns": ["o_orderkey", "o_custkey", "o_totalprice"],
                            "key_columns": ["o_orderkey"]},
         "freshness": {"max_age_hours": 1e9}, "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "lineitem", "output_path": "lineitem.parquet", "format": "parquet", "produced_by": "driver",
         "minimum_schema": {"required_columns": ["l_orderkey", "l_linenumber"],
                            "key_columns": ["l_orderkey", "l_linenumber"]},
         "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "nation", "output_path": "nation.parquet", "format": "parquet", "produced_by": "driver",
         "minimum_schema": {"required_columns": ["n_nationkey", "n_comment"]},
         "validation_rules": {"row_count_min": 30, "unique_key": False}},
        {"id": "region", "output_path": "region.parquet", "format": "parquet", "produced_by": "driver",
         "minimum_schema": {"required_columns": ["r_regionkey"]},
         "freshness": {"max_age_hours": 0}, "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "supplier", "output_path": "supplier.parquet", "format": "parquet", "produced_by": "driver",
         "minimum_schema": {"required_columns": ["s_suppkey"], "key_columns": ["s_suppkey", "s_absent"]},
         "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "events_archive", "output_path": "events_archive.parquet", "format": "parquet",
         "produced_by": "driver", "validation_rules": {"row_count_min": 1}},
        {"id": "customer_rds", "output_path": "customer.parquet", "format": "rds", "produced_by": "driver"},
    ]}
    import json
    return Contract.from_json(json.dumps(doc), root=sf)


@register("q33_contract_report", """
SELECT 'schema' AS type, 'lineitem' AS id, 'Duplicate rows found for key columns: l_orderkey, l_linenumber' AS detail
WHERE EXISTS (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'schema', 'orders', 'Duplicate rows found for key columns: o_orderkey'
WHERE EXISTS (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'schema', 'nation', 'Missing required columns: n_comment'
UNION ALL SELECT 'row_count', 'nation', 'Row count ' || CAST(count(*) AS VARCHAR) || ' is below minimum 30.'
FROM nation HAVING count(*) < 30
UNION ALL SELECT 'schema', 'region', 'unique_key is true but key_columns is empty.'
UNION ALL SELECT 'stale', 'region', 'File age # hours exceeds max_age_hours 0.'
UNION ALL SELECT 'schema', 'supplier', 'Missing key columns: s_absent'
UNION ALL SELECT 'missing', 'events_archive', 'File does not exist.'
UNION ALL SELECT 'unreadable', 'customer_rds', 'Unsupported dataset format ''rds''.'""")
def q33(spark, sf):
    """Contract verification over driver tables: one aggregate job per
    dataset, issues as rows."""
    issues = verify_contract(spark, driver_contract(sf))
    detail = F.when(F.col("type") == "stale", F.regexp_replace("detail", "age [0-9.]+", "age #")).otherwise(F.col("detail"))
    return issues.select("type", "id", detail.alias("detail"))  # the age itself changes by the minute


# ---------------------------------------------------------------------------
# q34 reconciliation: DQ-14
# ---------------------------------------------------------------------------

def _difference_sql(a: str, e: str, both: str) -> str:
    """Mean difference over the rows that differ: relative to the expected
    magnitude, absolute where that is not above the tolerance."""
    d = f"FILTER (WHERE {both} AND {a} <> {e})"
    return (f"CASE WHEN count(*) {d} = 0 THEN 0 WHEN sum(abs({e})) {d} / count(*) {d} > 1e-6 "
            f"THEN sum(abs({a} - {e})) {d} / sum(abs({e})) {d} ELSE sum(abs({a} - {e})) {d} / count(*) {d} END")


def _reconcile_sql(name: str, actual: str, expected: str) -> str:
    both = "ina = 1 AND ine = 1"
    return f"""SELECT '{name}' AS comparison, count(ina) AS rows_actual, count(ine) AS rows_expected,
  count(*) FILTER (WHERE ina IS NULL OR ine IS NULL) AS rows_unmatched,
  count(*) FILTER (WHERE {both} AND (av IS NULL) <> (ev IS NULL)) AS null_mismatches,
  {_difference_sql('av', 'ev', both)} AS mean_rel_diff
  FROM (SELECT year AS ay, v AS av, 1 AS ina FROM {actual}) FULL OUTER JOIN
       (SELECT year AS ey, v AS ev, 1 AS ine FROM {expected}) ON ay IS NOT DISTINCT FROM ey"""


RECONCILED = (("monthly_route", "b", "a"), ("line_route", "c", "a"), ("one_order_off", "off", "ords"),
              ("null_key", "nk", "nk"), ("null_value", "nv", "a"), ("zero_expected", "a", "zero"))


@register("q34_reconcile", """
WITH a AS (SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v
           FROM orders GROUP BY ALL),
mo AS (SELECT CAST(year(o_orderdate) AS INT) AS year, month(o_orderdate) AS m, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
       FROM orders GROUP BY ALL),
b AS (SELECT year, CAST(sum(v) AS DOUBLE) AS v FROM mo GROUP BY year),
c AS (SELECT CAST(year(o_orderdate) AS INT) AS year,
             CAST(sum(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(18,2))) AS DOUBLE) AS v
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
ords AS (SELECT o_orderkey AS year, CAST(o_totalprice AS DOUBLE) AS v FROM orders),
off AS (SELECT o_orderkey AS year, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 1.1 ELSE 1.0 END
               * CAST(o_totalprice AS DOUBLE) AS v FROM orders),
nk AS (SELECT nullif(year, 1996) AS year, v FROM a),
nv AS (SELECT year, CASE WHEN year <> 1997 THEN v END AS v FROM a),
zero AS (SELECT year, CASE WHEN year = 1998 THEN 0.0 ELSE v END AS v FROM a),
r AS (""" + "\nUNION ALL\n".join(_reconcile_sql(*x) for x in RECONCILED) + """)
SELECT comparison, rows_actual, rows_expected, rows_unmatched, null_mismatches, round(mean_rel_diff, 6) AS mean_rel_diff,
       rows_unmatched = 0 AND null_mismatches = 0 AND mean_rel_diff <= 1e-6 AS within_tolerance
FROM r""")
def q34(spark, sf):
    """Yearly order totals compared with other routes to them: via months (must
    agree) and via discounted line amounts (does not); one order of all off by
    a tenth; a NULL key on both sides; a value missing on one side; an
    expected zero."""
    o = table(spark, sf, "orders")
    a = o.groupBy(F.year("o_orderdate").alias("year")).agg(money("o_totalprice").cast("double").alias("v"))
    mo = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m")) \
        .agg(money("o_totalprice").alias("v"))
    li = table(spark, sf, "lineitem")
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).cast(DEC)
    ords = o.select(F.col("o_orderkey").alias("year"), F.col("o_totalprice").cast("double").alias("v"))
    year, v = F.col("year"), F.col("v")
    last = latest(ords, "year")
    frames = {
        "a": a, "b": mo.groupBy("year").agg(F.sum("v").cast("double").alias("v")),
        "c": li.join(o.select("o_orderkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
        .groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(amount).cast("double").alias("v")),
        "ords": ords, "off": ords.withColumn("v", F.when(year == last, 1.1).otherwise(1.0) * v),
        "nk": a.withColumn("year", F.when(year != 1996, year)), "nv": a.withColumn("v", F.when(year != 1997, v)),
        "zero": a.withColumn("v", F.when(year == 1998, 0.0).otherwise(v)),
    }
    out = None
    for name, actual, expected in RECONCILED:
        r = reconcile(frames[actual], frames[expected], ["year"], "v").select(
            F.lit(name).alias("comparison"), "rows_actual", "rows_expected", "rows_unmatched", "null_mismatches",
            F.round("mean_rel_diff", 6).alias("mean_rel_diff"), "within_tolerance")
        out = r if out is None else out.unionByName(r)
    return out


def _rf_sql(col: str, numeric: bool) -> str:
    both = "(ina = 1 AND ine = 1)"
    if numeric:
        d = f"round({_difference_sql(f'CAST({col} AS DOUBLE)', f'CAST(e_{col} AS DOUBLE)', both)}, 6)"
        m = f"count(*) FILTER (WHERE {both} AND (({col} IS NULL) <> (e_{col} IS NULL)))"
        kind = "numeric"
    else:
        d, m, kind = "CAST(NULL AS DOUBLE)", f"count(*) FILTER (WHERE {both} AND {col} IS DISTINCT FROM e_{col})", "text"
    return f"""SELECT '{col}' AS "column", '{kind}' AS kind, count(ina) AS rows_actual, count(ine) AS rows_expected,
  count(*) FILTER (WHERE ina IS NULL OR ine IS NULL) AS rows_unmatched, {d} AS mean_rel_diff, {m} AS mismatches FROM j"""


Q34B_SQL = """
WITH a AS (SELECT nullif(n_name, 'GERMANY') AS nation, CAST(year(o_orderdate) AS INT) AS year,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor, count(*) AS n_orders,
                  max(o_orderpriority) AS top_priority
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
e0 AS (SELECT nullif(n_name, 'GERMANY') AS nation, CAST(year(o_orderdate) AS INT) AS year,
             CAST(sum(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(18,2))) AS DOUBLE) AS valor,
             count(DISTINCT l_orderkey) AS n_orders, max(o_orderpriority) AS top_priority
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
e AS (SELECT nation, year, CASE WHEN year <> 1996 THEN valor END AS valor,
             CASE WHEN year = 1997 THEN 0 ELSE n_orders END AS n_orders, top_priority FROM e0),
j AS (SELECT a.valor, a.n_orders, a.top_priority, e.valor AS e_valor, e.n_orders AS e_n_orders,
             e.top_priority AS e_top_priority, ina, ine
      FROM (SELECT *, 1 AS ina FROM a) a FULL OUTER JOIN (SELECT *, 1 AS ine FROM e) e
        ON a.nation IS NOT DISTINCT FROM e.nation AND a.year = e.year),
r AS (""" + "\nUNION ALL ".join(_rf_sql(c, num) for c, num in
                                 (("valor", True), ("n_orders", True), ("top_priority", False))) + """)
SELECT *, rows_unmatched = 0 AND mismatches = 0 AND coalesce(mean_rel_diff, 0) <= 1e-6 AS within_tolerance
FROM r"""


@register("q34b_reconcile_frames", Q34B_SQL)
def q34b(spark, sf):
    """Whole-frame reconciliation per column (nation x year): amounts and
    order counts from the order route against the line route, plus a text
    column; one nation has no name, one year no expected amounts, one year
    expected counts of zero."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    oc = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    keys = [F.when(F.col("n_name") != "GERMANY", F.col("n_name")).alias("nation"), F.year("o_orderdate").alias("year")]
    a = oc.groupBy(*keys).agg(money("o_totalprice").cast("double").alias("valor"),
                              F.count(F.lit(1)).alias("n_orders"), F.max("o_orderpriority").alias("top_priority"))
    li = table(spark, sf, "lineitem")
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).cast(DEC)
    e = li.join(oc, li.l_orderkey == F.col("o_orderkey")).groupBy(*keys).agg(
        F.sum(amount).cast("double").alias("valor"), F.countDistinct("l_orderkey").alias("n_orders"),
        F.max("o_orderpriority").alias("top_priority"))
    e = e.withColumn("valor", F.when(F.col("year") != 1996, F.col("valor"))) \
        .withColumn("n_orders", F.when(F.col("year") == 1997, F.lit(0)).otherwise(F.col("n_orders")))
    r = reconcile_frames(a, e, ["nation", "year"])
    return r.withColumn("mean_rel_diff", F.round("mean_rel_diff", 6))


# ---------------------------------------------------------------------------
# q35 domain check: UN-04 DQ-17
# ---------------------------------------------------------------------------

EXPECTED_EVENT_TYPES = ("click", "view", "purchase", "signup", "logout")


@register("q35_domain_check", """
WITH a AS (SELECT DISTINCT event_type AS value FROM events),
e AS (SELECT * FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('logout')) t(value)),
am AS (SELECT DISTINCT CAST(month(ts) AS VARCHAR) AS value FROM events),
em AS (SELECT CAST(m AS VARCHAR) AS value FROM range(1, 13) t(m))
SELECT 'event_type' AS domain, value, 'unexpected' AS side FROM a WHERE value NOT IN (SELECT value FROM e)
UNION ALL SELECT 'event_type', value, 'missing' FROM e WHERE value NOT IN (SELECT value FROM a)
UNION ALL SELECT 'month', value, 'unexpected' FROM am WHERE value NOT IN (SELECT value FROM em)
UNION ALL SELECT 'month', value, 'missing' FROM em WHERE value NOT IN (SELECT value FROM am)
UNION ALL SELECT 'named_type', nullif(value, 'view'), 'unexpected' FROM a WHERE value = 'view' OR value NOT IN (SELECT value FROM e)
UNION ALL SELECT 'named_type', value, 'missing' FROM e WHERE value = 'view' OR value NOT IN (SELECT value FROM a)""")
def q35(spark, sf):
    ev = table(spark, sf, "events")
    types = domain_check(ev, "event_type", EXPECTED_EVENT_TYPES, "event_type")
    months = domain_check(ev.select(F.month("ts").alias("m")), "m", range(1, 13), "month")
    named = ev.select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("t"))
    return types.unionByName(months).unionByName(domain_check(named, "t", EXPECTED_EVENT_TYPES, "named_type"))


# ---------------------------------------------------------------------------
# q06 artifact job: SNK-01 SNK-02 (registered last: it reuses other plans)
# ---------------------------------------------------------------------------

@register("q06_artifact_job", "WITH " + REFS_SQL + """
SELECT 'annual_by_nation' AS dataset, n_name || '|' || CAST(year(o_orderdate) AS VARCHAR) AS key,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY n_name, year(o_orderdate)
UNION ALL SELECT 'index', CAST(year AS VARCHAR), round(idx_base, 6) FROM idx
UNION ALL SELECT 'gdp', CAST(year AS VARCHAR), round(gdp, 6) FROM gdp
UNION ALL SELECT 'rate', CAST(year AS VARCHAR), round(rate, 6) FROM rate
UNION ALL SELECT 'duplicate_keys', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q06(spark, sf):
    """Build the bundle, stage and publish every dataset (annual series
    partitioned by year) in the shared folder, and read the contents back."""
    refs = driver_refs(spark, sf)
    bundle = {"annual_by_nation": q16(spark, sf), "index": refs.index, "gdp": refs.gdp, "rate": refs.rate,
              "duplicate_keys": q31(spark, sf)}
    paths = artifacts.write_bundle(bundle, scratch_path(spark, "artifacts"))
    back = {name: spark.read.parquet(path) for name, path in paths.items()}
    m, year = DRIVER_METHOD, F.col("year").cast("string")
    shapes = {"annual_by_nation": (F.concat_ws("|", "nation", year), F.col("valor")),
              "index": (year, F.round(m.index_value, 6)), "gdp": (year, F.round(m.gdp_value, 6)),
              "rate": (year, F.round(m.rate_value, 6)),
              "duplicate_keys": (F.concat_ws("|", "l_orderkey", "l_linenumber"), F.col("n").cast("double"))}
    out = None
    for name, (key, value) in shapes.items():
        one = back[name].select(F.lit(name).alias("dataset"), key.alias("key"), value.alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# The account-plan jobs themselves on sheets derived from the driver tables
# q36 CP-01 structure maps, q37 CP-14 projections, q38 CP-15 cash job,
# q39 CP-07 annual series job. Amounts are whole thousands, as on the
# account sheets, so sums are exact in any order.
# ---------------------------------------------------------------------------

BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITY_HEADERS = {"1-URGENT": "A", "2-HIGH": "B", "3-MEDIUM": "D", "4-NOT SPECIFIED": "E", "5-LOW": "X"}


def brand_sheet(spark, sf) -> DataFrame:
    """Structure sheet: one row per part (sheet row = key + 2), codes as
    text, one column per brand holding the part's account label."""
    p = table(spark, sf, "part")
    size = F.col("p_size")
    header = F.when(size > 48, F.lit(None).cast("string")).otherwise(F.substring("p_type", 1, 1))
    sub = F.when(size % 10 == 0, F.lit(None).cast("string")).otherwise((size % 4).cast("string"))
    item = F.when(size % 10 == 0, F.lit(None).cast("string")).otherwise(size.cast("string"))
    rubro = F.concat(F.lit("rubro "), F.col("p_partkey").cast("string"))
    brands = [F.when(F.col("p_brand") == b, rubro).alias(b) for b in BRANDS]
    return p.select((F.col("p_partkey") + 2).cast("int").alias("row"), header.alias("Header"), sub.alias("SubHeader"),
                    item.alias("Item"), F.col("p_name").alias("Label"), *brands)


_BRAND_SHEET_SQL = """sheet AS (SELECT CAST(p_partkey + 2 AS INT) AS row, p_brand, p_partkey,
   CASE WHEN p_size > 48 THEN NULL ELSE substr(p_type, 1, 1) END AS header_code,
   CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size % 4 END AS sub_header_code,
   CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size END AS item_code, p_name FROM part)"""


@register("q36a_structure_by_row", f"""WITH {_BRAND_SHEET_SQL}
SELECT CAST(row + 5 AS INT) AS row, header_code, CAST(sub_header_code AS INT) AS sub_header_code,
       CAST(item_code AS INT) AS item_code, p_name AS label_estructura FROM sheet""")
def q36a(spark, sf):
    """Account map by sheet row (CP-01) from the structure sheet."""
    by_row, _ = accounts.structure_maps(brand_sheet(spark, sf))
    return by_row


@register("q36b_structure_by_company", f"""WITH {_BRAND_SHEET_SQL},
b AS (SELECT 'Brand#' || CAST(i AS VARCHAR) AS empresa FROM range(1, 26) t(i))
SELECT header_code, CAST(sub_header_code AS INT) AS sub_header_code, CAST(item_code AS INT) AS item_code, b.empresa,
       CASE WHEN p_brand = b.empresa THEN 'rubro ' || CAST(p_partkey AS VARCHAR) END AS rubro
FROM sheet CROSS JOIN b
WHERE NOT (header_code IS NULL AND sub_header_code IS NULL AND item_code IS NULL)""")
def q36b(spark, sf):
    """Account x company labels (CP-01): the brand columns unpivoted, NULL
    labels kept, rows with no code dropped."""
    _, by_company = accounts.structure_maps(brand_sheet(spark, sf))
    return by_company


def projection_sheet(spark, sf, m: MonetaryMethodology = DRIVER_METHOD) -> DataFrame:
    """Projection sheet of the projection year: one row per priority (coded
    header), one column per segment, amounts in thousands as text."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    start = F.lit(f"{m.projection_year}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{m.projection_year + 1}-01-01").cast("timestamp_ntz")
    rows = o.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)) \
        .join(c, o.o_custkey == c.c_custkey)
    wide = rows.groupBy("o_orderpriority").pivot("c_mktsegment", list(SEGMENTS)).agg(money("o_totalprice"))
    return wide.select(code_lookup("o_orderpriority", PRIORITY_HEADERS).alias("header"),
                       F.lit(1.0).alias("SubHeader"), F.lit(0.0).alias("Item"),
                       F.col("o_orderpriority").alias("label"), F.lit("r").alias("rubro"),
                       *[F.round(F.col(s) / 1000).cast("bigint").cast("string").alias(s) for s in SEGMENTS])


_PROJ_HEADER_SQL = "CASE p.h " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PROJECTION_HEADERS.items()) + " END"


@register("q37_projection_measures", "WITH " + REFS_SQL + f""",
pr AS (SELECT o_orderpriority AS label, c_mktsegment AS seg,
              CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000) AS BIGINT) AS th
       FROM orders JOIN customer ON c_custkey = o_custkey
       WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2002-01-01' GROUP BY ALL),
lb AS (SELECT DISTINCT label, CASE label {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_HEADERS.items())} END AS h
       FROM pr),
sg AS (SELECT * FROM (VALUES {", ".join(f"('{s}', {i})" for i, s in enumerate(SEGMENTS, start=1))}) t(seg, ente_ord)),
p AS (SELECT lb.label, lb.h, sg.seg, sg.ente_ord, 1e3 * CAST(pr.th AS DOUBLE) AS ejecutado
      FROM lb CROSS JOIN sg LEFT JOIN pr ON pr.label = lb.label AND pr.seg = sg.seg
      WHERE lb.h IS NOT NULL)
SELECT {_PROJ_HEADER_SQL} AS header, p.label, p.seg AS ente, p.ejecutado, 2001 AS year,
       round(100 * p.ejecutado / idx.idx_base, 6) AS ejecutado_base, round(p.ejecutado / gdp.gdp, 9) AS ejecutado_pct_gdp,
       round(p.ejecutado / rate.rate, 6) AS ejecutado_usd, 'Proyección' AS tipo,
       CAST(list_position({_sql_list(PROJECTION_HEADER_LEVELS)}, {_PROJ_HEADER_SQL}) AS INT) AS header_ord,
       CAST(p.ente_ord AS INT) AS ente_ord
FROM p LEFT JOIN idx ON idx.year = 2001 LEFT JOIN gdp ON gdp.year = 2001 LEFT JOIN rate ON rate.year = 2001""")
def q37(spark, sf):
    """The projection job (CP-14) on the projection year's orders: unpivoted by
    segment, header coded and ordered, four measures, tagged. The index has
    no complete 2001, so the constant measure is NULL."""
    m = DRIVER_METHOD
    out = accounts.projections(projection_sheet(spark, sf, m), yearly_refs(spark, sf), m, on_missing="null")
    c = m.projection
    return out.select("header", "label", "ente", c.nominal, "year", F.round(c.constant, 6).alias(c.constant),
                      F.round(c.pct_gdp, 9).alias(c.pct_gdp), F.round(c.usd, 6).alias(c.usd), "tipo",
                      "header_ord", "ente_ord")


def thousand_accounts(spark, sf) -> DataFrame:
    """Monthly line accounts in whole thousands: the actuals table of the
    account plan (company x year x month x account)."""
    a = line_accounts(spark, sf)
    return a.groupBy("empresa", "year", "month", *CODES).agg(
        F.round(money("l_extendedprice") / 1000).cast("double").alias("valor"))


_ACTS_SQL = f"""acts AS (SELECT empresa, year, month, header_code, sub_header_code, item_code,
   CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) / 1000) AS DOUBLE) AS valor
   FROM ({LINE_ACCOUNTS_SQL}) GROUP BY ALL)"""

DRIVER_CASH = CashConfig(income_class=("A", "N"), expense_class=("R",), opening_overrides={"N": 5.0e8},
                         expense_minimums={"A": 1.0e6, "N": 2.0e6, "R": 3.0e6},
                         movement_account=("I", 1, 1), income_account="A")


def opening_sheet(acts: DataFrame, first_year: int = 1995) -> DataFrame:
    """Opening cash sheet (thousands): first-year income totals; blank for
    the company whose opening comes from the override."""
    total = (F.col("year") == first_year) & (F.col("header_code") == "A") & \
        F.col("sub_header_code").isNull() & F.col("item_code").isNull()
    miles = F.sum(F.when(total, F.col("valor")))
    return acts.groupBy("empresa").agg(
        F.when(F.col("empresa").isin(*DRIVER_CASH.opening_overrides), F.lit(None).cast("double"))
        .otherwise(miles).alias("saldo_inicial_miles"))


@register("q38_cash_job", f"""WITH {_ACTS_SQL},
ly AS (SELECT max(year) AS y FROM acts),
mv AS (SELECT empresa, make_date(year, month, 1) AS fecha, 1e3 * valor AS valor FROM acts
       WHERE year = (SELECT y FROM ly) AND header_code = 'I' AND sub_header_code = 1 AND item_code = 1),
mva AS (SELECT empresa, fecha, sum(valor) AS valor FROM mv GROUP BY ALL),
opm AS (SELECT empresa, CASE WHEN empresa = 'N' THEN NULL ELSE sum(CASE WHEN year = 1995 AND header_code = 'A'
          AND sub_header_code IS NULL AND item_code IS NULL THEN valor END) END AS miles FROM acts GROUP BY empresa),
op AS (SELECT empresa, coalesce(1e3 * miles, CASE empresa WHEN 'N' THEN 5.0e8 END) AS opening,
              make_date((SELECT y FROM ly), 1, 1) AS fecha FROM opm),
j AS (SELECT mva.*, op.opening FROM mva LEFT JOIN op USING (empresa, fecha)),
w AS (SELECT *, first_value(opening IGNORE NULLS) OVER (PARTITION BY empresa ORDER BY fecha
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS o0,
             sum(coalesce(valor, 0)) OVER (PARTITION BY empresa ORDER BY fecha ROWS UNBOUNDED PRECEDING) AS cum FROM j),
inc AS (SELECT empresa, CASE WHEN count(*) = count(valor) THEN sum(valor) END / 12.0 AS saldo_minimo_ingresos
        FROM acts WHERE year = (SELECT y FROM ly) - 1 AND header_code = 'A' AND sub_header_code IS NULL
        AND item_code IS NULL GROUP BY empresa),
gas AS (SELECT empresa, CAST(v AS DOUBLE) AS saldo_minimo_gastos FROM (VALUES ('A', 1000.0), ('N', 2000.0), ('R', 3000.0))
        t(empresa, v))
SELECT 'I' AS header_code, 1 AS sub_header_code, 1 AS item_code, w.empresa,
       CASE WHEN month(fecha) = 1 THEN opening ELSE o0 - cum END AS saldo, gas.saldo_minimo_gastos,
       inc.saldo_minimo_ingresos,
       1e3 * CASE WHEN w.empresa IN ('A', 'N') THEN inc.saldo_minimo_ingresos
                  WHEN w.empresa IN ('R') THEN gas.saldo_minimo_gastos END AS saldo_minimo, fecha
FROM w LEFT JOIN gas USING (empresa) LEFT JOIN inc USING (empresa)""")
def q38(spark, sf):
    """The cash job (CP-15) on the driver accounts: latest-year movements of
    the cash account, opening from the opening sheet (or override), January
    anchor, income-class / expense-class minimums."""
    acts = thousand_accounts(spark, sf)
    return accounts.cash_monthly(acts, opening_sheet(acts), DRIVER_CASH)


@register("q39_annual_series_job", "WITH " + REFS_SQL + f""", {_ACTS_SQL},
r AS (SELECT *, {FILL_SQL} AS fill_col, {FACET_SQL} AS facet_col FROM acts WHERE {_BRANCHES_SQL}),
s AS (SELECT empresa, year, facet_col, fill_col,
             CASE WHEN count(*) = count(valor) THEN sum(1e3 * valor) END AS valor
      FROM r WHERE fill_col IS NOT NULL AND facet_col IS NOT NULL GROUP BY ALL)
SELECT s.empresa, s.year, s.facet_col, s.fill_col, s.valor, round(100 * s.valor / idx.idx_base, 6) AS valor_base,
       round(s.valor / gdp.gdp, 9) AS valor_pct_gdp, round(s.valor / rate.rate, 6) AS valor_usd
FROM s LEFT JOIN idx USING (year) LEFT JOIN gdp USING (year) LEFT JOIN rate USING (year)""")
def q39(spark, sf):
    """The annual series job (CP-07): five account branches in one predicate,
    classification, strict yearly sums in units, four measures."""
    m = DRIVER_METHOD
    out = accounts.series_annual(thousand_accounts(spark, sf), yearly_refs(spark, sf), m, DRIVER_RULES,
                                 on_missing="null")
    c = m.annual
    return out.select("empresa", "year", "facet_col", "fill_col", c.nominal, F.round(c.constant, 6).alias(c.constant),
                      F.round(c.pct_gdp, 9).alias(c.pct_gdp), F.round(c.usd, 6).alias(c.usd))


# ---------------------------------------------------------------------------
# q40 CP-03 budget job: budget sheets (one per priority, one row per segment
# and nation, month columns in thousands) paired with a coded template by
# concept + occurrence; q40b the unmatched rows (DQ-15).
# ---------------------------------------------------------------------------

def budget_sheets(spark, sf):
    """(source sheets, template sheets, label map) of all years, derived from
    one pass over the orders: a sheet per year and priority, a row per segment
    and nation. The template codes a row as (segment letter, region, nation)
    and only covers regions 0-3; the label map names the accounts of nations
    0-9."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = o.join(c, o.o_custkey == c.c_custkey)
    wide = rows.withColumn("m", F.month("o_orderdate")) \
        .groupBy(F.year("o_orderdate").alias(accounts.YEAR), "o_orderpriority", "c_mktsegment", "c_nationkey") \
        .pivot("m", list(range(1, 13))).agg(money("o_totalprice"))
    months = [F.round(F.col(str(i)) / 1000).cast("bigint").cast("string").alias(MONTH_NAMES[i - 1])
              for i in range(1, 13)]
    name = F.concat_ws(" ", F.col(accounts.YEAR).cast("string"), "o_orderpriority")
    # sheets are landed tables: written once, read by source, template and labels
    path = scratch_path(spark, "budget-sheets")
    wide.write.parquet(path)
    wide = spark.read.parquet(path)
    sheet = wide.select(name.alias("sheet"), accounts.YEAR, (F.col("c_nationkey") + 2).cast("int").alias("row"),
                        F.col("c_mktsegment").alias("Concepto"), "c_nationkey", *months)
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey", "n_name")
    coded = sheet.join(n, F.col("c_nationkey") == F.col("n_nationkey")).where(F.col("n_regionkey") < 4)
    template = coded.select("sheet", "row", F.substring("Concepto", 1, 1).alias("Header"),
                            F.col("n_regionkey").cast("string").alias("SubHeader"),
                            F.col("c_nationkey").cast("string").alias("Item"), "Concepto", *MONTH_NAMES)
    labels = coded.where(F.col("c_nationkey") < 10).select(
        F.col("sheet").alias("empresa"), F.substring("Concepto", 1, 1).alias("header_code"),
        F.col("n_regionkey").cast("int").alias("sub_header_code"), F.col("c_nationkey").cast("int").alias("item_code"),
        F.concat(F.lit("cuenta "), F.col("n_name")).alias("rubro")).distinct()
    return sheet.drop("c_nationkey"), template, labels


_BUDGET_CTE = """
th AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || ' ' || o_orderpriority AS sheet, CAST(year(o_orderdate) AS INT) AS y,
              c_mktsegment AS concepto, c_nationkey AS nk, CAST(month(o_orderdate) AS INT) AS m,
              CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000) AS BIGINT) AS v
       FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
rws AS (SELECT DISTINCT sheet, y, concepto, nk FROM th WHERE v <> 0),
src AS (SELECT sheet, y, concepto, nk, CAST(nk + 2 AS INT) AS row,
               row_number() OVER (PARTITION BY sheet, concepto ORDER BY nk) AS occ FROM rws),
tpl AS (SELECT r.sheet, r.concepto, r.nk AS tnk, substr(r.concepto, 1, 1) AS header_code,
               CAST(n_regionkey AS INT) AS sub_header_code, CAST(r.nk AS INT) AS item_code, n_name,
               row_number() OVER (PARTITION BY r.sheet, r.concepto ORDER BY r.nk) AS occ
        FROM rws r JOIN nation ON n_nationkey = r.nk WHERE n_regionkey < 4)"""


@register("q40_budget_template_job", "WITH " + _BUDGET_CTE + """,
mt AS (SELECT src.sheet, src.y, src.concepto, src.row, src.nk, tpl.header_code, tpl.sub_header_code, tpl.item_code
       FROM src JOIN tpl USING (sheet, concepto, occ)),
lg AS (SELECT mt.*, CAST(mm.m AS INT) AS m, 1e3 * CAST(th.v AS DOUBLE) AS valor FROM mt CROSS JOIN range(1, 13) mm(m)
       LEFT JOIN th ON th.sheet = mt.sheet AND th.concepto = mt.concepto AND th.nk = mt.nk AND th.m = mm.m),
g AS (SELECT sheet AS empresa, make_date(y, m, 1) AS fecha, header_code, sub_header_code, item_code,
             coalesce(sum(valor), 0) AS valor, arg_min(concepto, row) AS label_excel FROM lg GROUP BY ALL),
lm AS (SELECT DISTINCT sheet AS empresa, header_code, sub_header_code, item_code, 'cuenta ' || n_name AS rubro
       FROM tpl WHERE item_code < 10)
SELECT g.empresa, g.header_code, g.sub_header_code, g.item_code, coalesce(lm.rubro, g.label_excel) AS label, g.fecha,
       g.valor
FROM g LEFT JOIN lm ON g.empresa IS NOT DISTINCT FROM lm.empresa AND g.header_code IS NOT DISTINCT FROM lm.header_code
  AND g.sub_header_code IS NOT DISTINCT FROM lm.sub_header_code AND g.item_code IS NOT DISTINCT FROM lm.item_code""")
def q40(spark, sf):
    """The budget job (CP-03): rows with data, n-th concept occurrence paired
    with the n-th template row, months unpivoted, x1e3, summed per account,
    first source label, NULL-safe label join with fallback."""
    src, tpl, labels = budget_sheets(spark, sf)
    return accounts.budget_raw(src, tpl, labels, None)


@register("q40b_budget_unmatched", "WITH " + _BUDGET_CTE + """
SELECT sheet, count(*) AS dropped_rows FROM src ANTI JOIN tpl USING (sheet, concepto, occ) GROUP BY sheet""")
def q40b(spark, sf):
    src, tpl, _ = budget_sheets(spark, sf)
    return accounts.budget_unmatched(src, tpl)


# ---------------------------------------------------------------------------
# q41 SRC-09, q42 CP-04 DQ-07, q43 CP-17, q44 CP-19 PRJ-22, q45 FLT-10,
# q47 failing branches of DQ-09..DQ-13
# ---------------------------------------------------------------------------

@register("q41_required_dataset", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY ALL""")
def q41(spark, sf):
    """Orders read through the dataset contract (format, columns, typed errors)."""
    o = read_required_dataset(spark, driver_contract(sf), "orders")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), money("o_totalprice").cast("double").alias("total"))


@register("q42_budget_classified", f"""
WITH r AS (SELECT make_date(year, month, 1) AS fecha, empresa, header_code, sub_header_code, item_code,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
           FROM ({LINE_ACCOUNTS_SQL}) WHERE sub_header_code IS NOT NULL AND item_code IS NOT NULL
             AND header_code IN ('A', 'B', 'D', 'F', 'H') GROUP BY ALL),
c AS (SELECT *, {FILL_SQL} AS fill_col, {FACET_SQL} AS facet_col FROM r)
SELECT fecha, 'cuenta ' || header_code AS label, empresa, facet_col, fill_col, valor, header_code, sub_header_code, item_code
FROM c WHERE fill_col IS NOT NULL AND facet_col IS NOT NULL""")
def q42(spark, sf):
    """The budget classification of every import (CP-04) on monthly line sums:
    coded rows of the budget headers only, classified, blank labels refused."""
    raw = line_accounts(spark, sf).groupBy("empresa", first_of_month("year", "month").alias("fecha"), *CODES) \
        .agg(money("l_extendedprice").cast("double").alias("valor")) \
        .withColumn("label", F.concat(F.lit("cuenta "), "header_code"))
    return accounts.budget_monthly(raw, DRIVER_RULES)


@register("q43_facet_series", _SERIES_SQL + f"""
SELECT facet_col, year, empresa, fill_col, valor AS ejecutado, {_fmt_sql('valor', 'valor')} AS tooltip FROM ser""")
def q43(spark, sf):
    """Yearly series per facet, company and fill in the chosen measure, with tooltips."""
    return dashboard.facet_series(annual_line_series(spark, sf), "valor", m=DRIVER_METHOD)


def _cash_view_sql(cash_job_sql: str) -> str:
    return f"""WITH q AS ({cash_job_sql})
SELECT empresa, fecha, saldo, saldo_minimo,
       CASE WHEN empresa = 'R' THEN '{CASH_EXPENSE_LABEL}' WHEN empresa IN ('A', 'N') THEN '{CASH_INCOME_LABEL}' END AS linea_label,
       {_sql_list(MONTH_LABELS)}[month(fecha)] || ' ' || CAST(year(fecha) AS VARCHAR) || ': ' || {_fmt_sql('saldo', 'valor')} AS tooltip
FROM q"""


@register("q44_cash_view", _cash_view_sql(ORACLE["q38_cash_job"]))
def q44(spark, sf):
    """Balance, threshold, threshold label and month-year tooltip per company."""
    return dashboard.cash_view(q38(spark, sf), DRIVER_CASH)


@register("q45_filtered_series", _SERIES_SQL + """
SELECT empresa, year, facet_col, fill_col, valor FROM ser
WHERE empresa IN ('A', 'R') AND facet_col IN ('Ingresos', 'Gastos') AND year IN (1998, 1999)""")
def q45(spark, sf):
    """Companies, facets and years picked from the published annual series:
    the year prunes partition folders, the rest reaches the reader."""
    paths = artifacts.write_bundle({"series_anuales": annual_line_series(spark, sf)}, scratch_path(spark, "published"))
    got = artifacts.read_series(spark, paths["series_anuales"], ("A", "R"), ("Ingresos", "Gastos"), (1998, 1999))
    return got.select("empresa", F.col("year").cast("int").alias("year"), "facet_col", "fill_col", "valor")


@register("q47_failing_references", "WITH " + REFS_SQL + """,
idx2 AS (SELECT year, CASE WHEN year <> 1999 THEN idx_base END AS idx_base FROM idx WHERE year <> 1998
         UNION ALL SELECT year, idx_base FROM idx WHERE year = 1997),
rate2 AS (SELECT nullif(year, 1996) AS year, CASE WHEN year = 1997 THEN 0 ELSE rate END AS rate FROM rate)
""" + "\nUNION ALL ".join([
    _checks_sql("ipc_anual", "idx2", "idx_base", 1998),
    "SELECT 'pib_nominal_anual', 'columns', false, 'Reference series ''pib_nominal_anual'' is missing columns: gdp'",
    _checks_sql("dolar_promedio_anual", "rate2", "rate", None).replace("(SELECT year FROM rate2)",
                                                                     "(SELECT year FROM rate2 WHERE year IS NOT NULL)")]))
def q47(spark, sf):
    """Spoiled reference series: a repeated year, no base year and a NaN in the
    index, no value column in the GDP, a missing year and a zero in the rate."""
    m, r = DRIVER_METHOD, yearly_refs(spark, sf)
    y = F.col("year")
    index = r.index.where(y != 1998).withColumn(
        m.index_value, F.when(y == 1999, F.lit(float("nan"))).otherwise(F.col(m.index_value)))
    index = index.unionByName(r.index.where(y == 1997))
    rate = r.rate.withColumn(m.rate_value, F.when(y == 1997, 0.0).otherwise(F.col(m.rate_value))) \
        .withColumn("year", F.when(y != 1996, y))
    facts = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return reference_checks(ReferenceSeries(index, r.gdp.drop(m.gdp_value), rate), facts, m)


# ---------------------------------------------------------------------------
# q48 the whole import on landed sheets (SNK-02, CP-01..CP-16 in one run), and
# q49 its incremental form (SRC-04): sheets made from the driver tables
# ---------------------------------------------------------------------------

#: Account plan of the sheets: (header, sub, item) by sheet row from 7 on.
IMPORT_ACCOUNTS = (
    *[(h, s, i) for h in "ABDI" for s in (1, 2, 3) for i in (0, 1, 2)], *[("F", s, i) for s in (1, 2, 3) for i in (1, 2)],
    ("H", 1, 0), ("A", None, None), ("F", None, None))
IMPORT_COMPANIES = ("A", "N", "R")


def _account_name(h, s, i) -> str:
    return f"{h}-{'x' if s is None else s}-{'x' if i is None else i}"


def import_lines(spark, sf) -> DataFrame:
    """Lines by company, period and account of the sheets' plan (six lines of
    an order; open lines of A and F are total rows)."""
    li = table(spark, sf, "lineitem").join(F.broadcast(line_headers(spark)), "l_linenumber")
    h, points, tax = F.col("header_code"), F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int")
    total = (F.col("l_linestatus") == "O") & h.isin("A", "F")
    none = F.lit(None).cast("int")
    sub = F.when(total, none).when(h == "H", 1).otherwise(1 + points % 3)
    item = F.when(total, none).when(h == "H", 0).when(h == "F", 1 + tax % 2).otherwise(tax % 3)
    return li.select(F.col("l_returnflag").alias("empresa"), "header_code", sub.alias("sub_header_code"), item.alias("item_code"),
                     F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_extendedprice", "l_discount")


_IMPORT_LINES_SQL = f"""il AS (
SELECT l_returnflag AS empresa, {_H} AS header_code,
       CASE WHEN t THEN NULL WHEN {_H} = 'H' THEN 1 ELSE CAST(1 + CAST(round(l_discount * 100) AS INT) % 3 AS INT) END AS sub_header_code,
       CASE WHEN t THEN NULL WHEN {_H} = 'H' THEN 0 WHEN {_H} = 'F' THEN CAST(1 + CAST(round(l_tax * 100) AS INT) % 2 AS INT)
            ELSE CAST(CAST(round(l_tax * 100) AS INT) % 3 AS INT) END AS item_code,
       CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, l_extendedprice, l_discount
FROM (SELECT *, l_linestatus = 'O' AND {_H} IN ('A', 'F') AS t FROM lineitem WHERE l_linenumber <= 6))"""
_IMPORT_ACTS_SQL = f"""{_IMPORT_LINES_SQL},
acts AS (SELECT empresa, year, month, header_code, sub_header_code, item_code,
   CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) / 1000) AS DOUBLE) AS valor FROM il GROUP BY ALL)"""


def import_actuals(spark, sf) -> DataFrame:
    return import_lines(spark, sf).groupBy("empresa", "year", "month", *CODES).agg(
        F.round(money("l_extendedprice") / 1000).cast("double").alias("valor"))


def account_row(first: int = 7) -> Column:
    """Sheet row of a row's account."""
    name = F.concat_ws("-", "header_code", *[F.coalesce(F.col(c).cast("string"), F.lit("x")) for c in CODES[1:]])
    rows = {_account_name(*a): first + n for n, a in enumerate(IMPORT_ACCOUNTS)}
    return F.element_at(F.create_map(*[F.lit(x) for kv in rows.items() for x in kv]), name)


def import_cells(acts: DataFrame) -> DataFrame:
    """Actuals as sheets: a workbook a year, a sheet a month, a row an account,
    a column a company; headers in row 6, labels in column 1."""
    col = F.array_position(F.lit(list(IMPORT_COMPANIES)), F.col("empresa")).cast("int") + 1
    none_n, none_c = F.lit(None).cast("double"), F.lit(None).cast("string")
    cell = lambda row, at, number, text: F.struct(row.cast("int").alias("row"), at.cast("int").alias("col"),
                                                  number.alias("numeric"), text.alias("character"))
    cells = F.explode(F.array(cell(F.col("r"), F.col("c"), F.col("valor"), none_c),
                              cell(F.lit(6), F.col("c"), none_n, F.col("empresa")),
                              cell(F.col("r"), F.lit(1), none_n, F.concat(F.lit("cuenta "), F.col("r").cast("string")))))
    return acts.select("year", "month", "empresa", "valor", account_row().alias("r"), col.alias("c")).select(
        F.concat(F.lit("libro "), F.col("year").cast("string")).alias("workbook"), "year",
        month_label_token(F.col("month")).alias("sheet"), cells.alias("x")).select("workbook", "year", "sheet", "x.*").distinct()


def import_structure(spark) -> DataFrame:
    """Structure sheet of the plan; income labels carry a spelling that the
    import must canonicalise."""
    label = lambda a: "otros   ingresos" if a[0] == "A" else f"cuenta {_account_name(*a)}"
    rows = [(2 + n, h, None if s is None else str(s), None if i is None else str(i), f"fila {n}",
             *[label((h, s, i))] * len(IMPORT_COMPANIES)) for n, (h, s, i) in enumerate(IMPORT_ACCOUNTS)]
    return literal_frame(spark, rows, [("row", "int"), *[(c, "string") for c in ("Header", "SubHeader", "Item", "Label",
                                                                                 *IMPORT_COMPANIES)]])


def import_budget(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(source, template): discounted amounts of the latest year, a sheet a
    company, a row an account, concepts repeated within a sheet; the template
    has no account of header I."""
    lines = import_lines(spark, sf)
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    wide = lines.where(F.col("year") == latest(lines, "year")).groupBy("empresa", *CODES).pivot("month", list(range(1, 13))).agg(
        F.round(F.sum(amount.cast(DEC)) / 1000).cast("bigint").cast("string"))
    concept = F.concat(F.lit("Concepto "), "header_code", F.coalesce(F.col("sub_header_code").cast("string"), F.lit("x")))
    sheet = wide.select(F.col("empresa").alias("sheet"), account_row().alias("row"), concept.alias("concepto"), *CODES,
                        *[F.col(str(i)).alias(MONTH_NAMES[i - 1]) for i in range(1, 13)])
    template = sheet.where("header_code <> 'I'").select(
        "sheet", "row", "concepto", F.col("header_code").alias("header"), F.col("sub_header_code").cast("string").alias("sub_header"),
        F.col("item_code").cast("string").alias("item"), *MONTH_NAMES)
    return sheet.drop(*CODES), template


def import_macro(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(GDP cells, index sheet, rate sheet): quarterly, monthly and daily orders."""
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    thousands = F.round(money("o_totalprice") / 1000).cast("bigint").cast("string")
    q = o.groupBy(F.year(day).alias("y"), F.quarter(day).alias("q")).agg(thousands.alias("v"))
    at = (2 + (F.col("y") - 1990) * 4 + F.col("q") - 1).cast("int")
    roman = F.element_at(F.lit(["I", "II", "III", "IV"]), F.col("q"))
    cell = lambda row, text: F.struct(F.lit(row).alias("row"), text.alias("character"))
    gdp = q.select(at.alias("col"), F.explode(F.array(cell(6, F.concat_ws(" ", roman, F.col("y").cast("string"))),
                                                      cell(19, F.col("v")))).alias("x")) \
        .select(F.lit("pib").alias("workbook"), F.lit("trimestres").alias("sheet"), "x.row", "col",
                F.lit(None).cast("double").alias("numeric"), "x.character")
    month = F.trunc(day, "month")
    serial = F.datediff(F.col("m"), F.lit("1899-12-30").cast("date"))
    index = o.groupBy(month.alias("m")).agg(thousands.alias("c2")).select(
        serial.alias("row"), serial.cast("string").alias("c1"), "c2")
    rate = o.groupBy(day.alias("d")).agg(F.count(F.lit(1)).cast("string").alias("c3")).select(
        F.datediff(F.col("d"), F.lit("1899-12-30").cast("date")).alias("row"), F.col("d").cast("string").alias("c1"),
        F.lit(None).cast("string").alias("c2"), "c3")
    return gdp, index, rate


def import_inputs(spark, sf) -> artifacts.LandedInputs:
    """All landed inputs of the import, written once and reread."""
    acts = import_actuals(spark, sf)
    source, template = import_budget(spark, sf)
    gdp, index, rate = import_macro(spark, sf)
    frames = {"actual_cells": import_cells(acts), "structure_sheet": import_structure(spark), "budget_source": source,
              "budget_template": template, "opening_sheet": opening_sheet(acts), "gdp_cells": gdp, "index_sheet": index,
              "rate_sheet": rate, "projection_sheet": projection_sheet(spark, sf)}
    root = scratch_path(spark, "import-sheets")
    for name, df in frames.items():
        write_table(df, f"{root}/{name}", partition_by=["year", "sheet"] if name == "actual_cells" else None)
    return artifacts.read_landed(spark, root)


_IMPORT_REFS_SQL = """
qu AS (SELECT CAST(year(o_orderdate) AS INT) AS year, quarter(o_orderdate) AS q,
              CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000) AS BIGINT) AS v FROM orders GROUP BY ALL),
ga AS (SELECT year, 1e6 * CAST(sum(v) AS DOUBLE) AS gdp FROM qu WHERE year BETWEEN 1995 AND 2001
       GROUP BY year HAVING count(*) >= 4),
gdp AS (SELECT year, gdp FROM ga UNION ALL SELECT 2001, arg_max(gdp, year) * 1.025 FROM ga
        HAVING count(*) FILTER (WHERE year = 2001) = 0 AND arg_max(gdp, year) IS NOT NULL),
mo AS (SELECT CAST(year(o_orderdate) AS INT) AS year, month(o_orderdate) AS month,
              CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000) AS BIGINT) AS v FROM orders GROUP BY ALL),
ia AS (SELECT year, CAST(sum(v) AS DOUBLE) / count(v) AS m FROM mo WHERE year BETWEEN 1995 AND 2001
       GROUP BY year HAVING count(*) >= 12),
idx AS (SELECT year, 100 * m / (SELECT max(m) FROM ia WHERE year = 1998) AS idx_base FROM ia),
dy AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL),
rate AS (SELECT CAST(year(d) AS INT) AS year, CAST(sum(n) AS DOUBLE) / count(n) AS rate FROM dy
         WHERE year(d) BETWEEN 1995 AND 2001 GROUP BY ALL)"""
_IMPORT_DIM_SQL = f"""diml AS (SELECT empresa, header_code, {NORMALIZED_SQL}, rubro FROM (VALUES """ + ", ".join(
    f"('{h}', {'NULL' if s is None else s}, {'NULL' if i is None else i}, "
    f"'{'otros   ingresos' if h == 'A' else 'cuenta ' + _account_name(h, s, i)}')" for h, s, i in IMPORT_ACCOUNTS) + f""")
  t(header_code, sub_header_code, item_code, rubro) CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in IMPORT_COMPANIES)}) c(empresa))"""
_IMPORT_MONTHLY_SQL = f"""WITH {_IMPORT_ACTS_SQL}, {_IMPORT_DIM_SQL},
ly AS (SELECT max(year) AS y FROM il),
th AS (SELECT empresa, header_code, sub_header_code, item_code, month,
              CAST(round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,2))) / 1000) AS BIGINT) AS v
       FROM il WHERE year = (SELECT y FROM ly) GROUP BY ALL),
br AS (SELECT DISTINCT empresa, header_code, sub_header_code, item_code FROM th WHERE v <> 0 AND header_code <> 'I'),
bud AS (SELECT br.*, (SELECT y FROM ly) AS year, CAST(mm.m AS INT) AS month, coalesce(1e3 * CAST(th.v AS DOUBLE), 0) AS valor
        FROM br CROSS JOIN range(1, 13) mm(m) LEFT JOIN th ON th.empresa = br.empresa AND th.header_code = br.header_code
          AND th.sub_header_code IS NOT DISTINCT FROM br.sub_header_code AND th.item_code IS NOT DISTINCT FROM br.item_code
          AND th.month = mm.m),
x AS (SELECT empresa, year, month, header_code, {NORMALIZED_SQL}, valor FROM acts),
y AS (SELECT DISTINCT empresa, year, month, header_code, {NORMALIZED_SQL} FROM bud),
xs AS (SELECT * FROM x WHERE EXISTS (SELECT 1 FROM y WHERE {_NULL_SAFE_6})),
u AS ({_standardize_sql('xs', 'Ejecutado', '1e3')} UNION ALL {_standardize_sql('bud', 'Firmado', '1.0')}),
v AS (SELECT make_date(year, month, 1) AS fecha, empresa, facet_col, fill_col, label, valor, tipo,
             header_code, sub_header_code, item_code FROM u)""" + ORACLE["q22_keep_rule"].partition(Q21_CTE)[2]


def _import_sql(name: str) -> str:
    """A job's oracle on the import's sheets."""
    return ORACLE[name].replace(_ACTS_SQL, _IMPORT_ACTS_SQL).replace(REFS_SQL, _IMPORT_REFS_SQL)


#: dataset: (key columns, {measure: decimals})
IMPORT_CONTENTS = {
    "series_anuales": (("empresa", "year", "facet_col", "fill_col"),
                       {"valor": 2, "valor_base": 6, "valor_pct_gdp": 9, "valor_usd": 6}),
    "series_mensuales": (("fecha", "empresa", "facet_col", "fill_col", "label", "tipo", *CODES, "keep"), {"valor": 2}),
    "caja_mensual": ((*CODES, "empresa", "fecha"),
                     {"saldo": 2, "saldo_minimo_gastos": 2, "saldo_minimo_ingresos": 6, "saldo_minimo": 4}),
    "serie_ipc_anual_24": (("year",), {"idx_base": 6}), "serie_pib_anual": (("year",), {"gdp": 6}),
    "dolar_promedio_anual": (("year",), {"rate": 6}),
    "proyecciones": (("header", "label", "ente", "year", "tipo"),
                     {"ejecutado": 2, "ejecutado_base": 6, "ejecutado_pct_gdp": 9, "ejecutado_usd": 6}),
}
_IMPORT_DATASETS_SQL = {
    "series_anuales": _import_sql("q39_annual_series_job"), "series_mensuales": _IMPORT_MONTHLY_SQL,
    "caja_mensual": _import_sql("q38_cash_job"), "proyecciones": _import_sql("q37_projection_measures"),
    **{name: f"WITH {_IMPORT_REFS_SQL} SELECT * FROM {cte}" for name, cte in (
        ("serie_ipc_anual_24", "idx"), ("serie_pib_anual", "gdp"), ("dolar_promedio_anual", "rate"))}}


def _contents_sql(name: str) -> str:
    keys, measures = IMPORT_CONTENTS[name]
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
    return "\nUNION ALL ".join(f"SELECT '{name}' AS dataset, {key} AS key, '{m}' AS measure, round({m}, {d}) AS value FROM {name}"
                               for m, d in measures.items())


@register("q48_import_job", "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in _IMPORT_DATASETS_SQL.items()) + "\n"
          + "\nUNION ALL ".join(map(_contents_sql, IMPORT_CONTENTS)))
def q48(spark, sf):
    """The whole import: sheets of actuals, structure, budget and template,
    opening balances, macro series and projections are read as landed, the
    seven datasets built, written to a new version of the bundle, committed,
    and every value read back."""
    out = scratch_path(spark, "import-bundle")
    bundle = artifacts.build_bundle(import_inputs(spark, sf), DRIVER_METHOD, DRIVER_CASH, rules=DRIVER_RULES, stock_entity="R",
                                    on_missing="null")
    artifacts.write_bundle(bundle, out)
    parts = []
    for name, (keys, measures) in IMPORT_CONTENTS.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        values = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), d).alias("value"))
                           for m, d in measures.items()])
        parts.append(artifacts.read_dataset(spark, out, name).select(
            F.lit(name).alias("dataset"), key.alias("key"), F.inline(values)))
    return union_by_name(*parts)


@register("q49_relanded_sheets", f"""WITH {_IMPORT_ACTS_SQL}
SELECT year, month, empresa, header_code, sub_header_code, item_code,
       CASE WHEN year = 1998 AND month IN (1, 6) THEN 2 * valor ELSE valor END AS valor FROM acts""")
def q49(spark, sf):
    """Incremental ingest (SRC-04): all sheets land, then two of them again
    with corrected values; each run reads what is new, and the corrected
    sheets replace their facts."""
    root = scratch_path(spark, "relanded")
    landing, facts = f"{root}/landing", f"{root}/facts"
    by_row, _ = accounts.structure_maps(import_structure(spark))
    acts = import_actuals(spark, sf)
    corrected = acts.where((F.col("year") == 1998) & F.col("month").isin(1, 6)).withColumn("valor", 2 * F.col("valor"))
    for landed in (acts, corrected):
        import_cells(landed).repartition("year", "sheet").write.mode("append").partitionBy("year", "sheet").parquet(landing)
        ingest_new_sheets(spark, landing, by_row, facts, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(facts).select("year", "month", "empresa", *CODES, "valor")
