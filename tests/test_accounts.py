"""The account-plan jobs on tiny landed sheets (hand-computed expectations)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.config import DEFAULT_METHODOLOGY as M, MONTH_NAMES
from ledgerlake.operators.measures import ReferenceSeries
from ledgerlake.plans import accounts, dashboard
from tests.conftest import rows

CELL = "year int, sheet string, row int, col int, numeric double, character string"


def structure(spark):
    return spark.createDataFrame([
        (2, "A", None, None, "Ingresos", "Ingresos totales", "Ingresos"),
        (3, "B", "1", "0", "Sueldos", "Sueldos y jornales", "Sueldos"),
        (4, "B", "2", "1", "Compras", "Compras de materiales", "Compras"),
        (5, "I", "5", "1", "Caja", "Caja", "Caja"),
        (6, None, None, None, "Nota", None, None),
    ], "row int, Header string, SubHeader string, Item string, Label string, ANCAP string, UTE string")


def test_structure_maps(spark):
    by_row, by_company = accounts.structure_maps(structure(spark))
    assert rows(by_row.where("row = 7"), "row", "header_code", "sub_header_code", "item_code") == [(7, "A", None, None)]
    assert by_row.count() == 5
    assert by_company.count() == 8  # 4 coded rows x 2 companies; the all-NULL code row is dropped
    assert rows(by_company.where("empresa = 'ANCAP' AND header_code = 'B'"), "sub_header_code", "rubro") == [
        (1, "Sueldos y jornales"), (2, "Compras de materiales")]


def actual_cells(spark):
    cells = []
    for year in (2023, 2024):
        for sheet in ("ENE", "FEB"):
            cells += [(year, sheet, 6, 2, None, "ANCAP"), (year, sheet, 6, 3, None, "UTE"),
                      (year, sheet, 6, 11, None, "OSE")]
            cells += [(year, sheet, r, 1, None, lbl) for r, lbl in ((7, "Ingresos"), (8, "Sueldos"), (10, "Caja"))]
            cells += [(year, sheet, 7, 2, 100.0, None), (year, sheet, 7, 3, 50.0, None),
                      (year, sheet, 7, 11, 7.0, None), (year, sheet, 8, 2, 30.0, None),
                      (year, sheet, 10, 2, 5.0, None), (year, sheet, 95, 2, 999.0, None)]
    return spark.createDataFrame(cells, CELL)


def test_actuals_from_cells_layout_by_period(spark):
    by_row, _ = accounts.structure_maps(structure(spark))
    a = accounts.actuals_from_cells(actual_cells(spark), by_row)
    assert a.columns == ["row", "empresa", "header_code", "sub_header_code", "item_code", "valor", "month", "year"]
    # OSE (column K) only from 2024 on; the row-95 cell lies outside the range
    assert rows(a.where("empresa = 'OSE'"), "year", "month") == [(2024, 1), (2024, 2)]
    assert a.where("valor = 999").count() == 0
    assert rows(a.where("year = 2023 AND month = 2 AND empresa = 'ANCAP'"), "row", "header_code", "valor") == [
        (7, "A", 100.0), (8, "B", 30.0), (10, "I", 5.0)]


def budget_sheets(spark):
    months = ", ".join(f"{m} string" for m in MONTH_NAMES)
    src = spark.createDataFrame([
        ("ANCAP", 1, "Ventas", *(["1"] * 12)),
        ("ANCAP", 2, " Ventas ", *(["2"] * 12)),
        ("ANCAP", 3, "Vacía", *(["0"] * 12)),
        ("ANCAP", 4, "   ", *(["5"] * 12)),
        ("ANCAP", 5, "Sin plantilla", *(["3"] * 12)),
    ], f"sheet string, row int, Concepto string, {months}")
    tpl = spark.createDataFrame([
        ("ANCAP", 1, "A", None, None, "Ventas", *(["1"] * 12)),
        ("ANCAP", 2, "B", "2", "1", "Ventas", *(["1"] * 12)),
    ], f"sheet string, row int, Header string, SubHeader string, Item string, Concepto string, {months}")
    return src, tpl


def test_budget_from_template(spark):
    src, tpl = budget_sheets(spark)
    _, by_company = accounts.structure_maps(structure(spark))
    raw = accounts.budget_raw(src, tpl, by_company, 2025)
    assert raw.count() == 24
    jan = rows(raw.where(F.col("fecha") == dt.date(2025, 1, 1)), "header_code", "sub_header_code", "label", "valor")
    assert jan == [("A", None, "Ingresos totales", 1000.0), ("B", 2, "Compras de materiales", 2000.0)]
    assert rows(accounts.budget_unmatched(src, tpl)) == [("ANCAP", 1)]
    monthly = accounts.budget_monthly(raw)
    assert rows(monthly.select("fill_col").distinct()) == [("Compras",)]  # A row has NULL codes -> filtered


def test_budget_monthly_blank_label_fails(spark):
    raw = spark.createDataFrame([("X", "A", 1, 1, "  ", dt.date(2025, 1, 1), 1.0)],
                                "empresa string, header_code string, sub_header_code int, item_code int, "
                                "label string, fecha date, valor double")
    with pytest.raises(PySparkException, match="missing/blank label"):
        accounts.budget_monthly(raw).collect()


def refs(spark):
    mk = lambda d, col: spark.createDataFrame(list(d.items()), f"year int, {col} double")
    return ReferenceSeries(mk({2023: 90.0, 2024: 100.0}, M.index_value),
                           mk({2023: 1e6, 2024: 2e6}, M.gdp_value), mk({2023: 40.0, 2024: 50.0}, M.rate_value))


def test_series_annual(spark):
    by_row, _ = accounts.structure_maps(structure(spark))
    a = accounts.actuals_from_cells(actual_cells(spark), by_row)
    out = accounts.series_annual(a, refs(spark))
    got = {(r["empresa"], r["year"], r["fill_col"]): r for r in out.collect()}
    # A totals (NULL sub/item) by company; B sub 1 item 0 is excluded (item 0)
    assert set(got) == {("ANCAP", 2023, "Ingresos"), ("ANCAP", 2024, "Ingresos"), ("UTE", 2023, "Ingresos"),
                        ("UTE", 2024, "Ingresos"), ("OSE", 2024, "Ingresos")}
    r = got[("ANCAP", 2024, "Ingresos")]
    assert r["valor"] == 200000.0 and r["valor_2024"] == pytest.approx(200000.0)
    assert r["valor_usd"] == pytest.approx(4000.0) and r["valor_pct_pib"] == pytest.approx(0.1)


def test_series_monthly_actual_vs_budget(spark):
    by_row, by_company = accounts.structure_maps(structure(spark))
    a = accounts.actuals_from_cells(actual_cells(spark), by_row).where("year = 2024")
    budget = spark.createDataFrame([("ANCAP", "A", None, None, "x", dt.date(2024, 1, 1), 90000.0)],
                                   "empresa string, header_code string, sub_header_code int, item_code int, "
                                   "label string, fecha date, valor double")
    out = accounts.series_monthly(a, budget, by_company)
    assert rows(out, "tipo", "empresa", "fecha", "label", "valor", "sub_header_code") == [
        ("Ejecutado", "ANCAP", dt.date(2024, 1, 1), "Ingresos totales", 100000.0, 0),
        ("Firmado", "ANCAP", dt.date(2024, 1, 1), "Ingresos totales", 90000.0, 0)]


def test_cash_monthly(spark):
    acts = spark.createDataFrame(
        [(r, "ANTEL", "I", 5, 1, float(m), m, 2025) for r, m in ((10, 1), (10, 2), (10, 3))] +
        [(10, "AFE", "I", 5, 1, 1.0, 1, 2025)] +
        [(7, "ANTEL", "A", None, None, 1200.0, m, 2024) for m in (1, 2)],
        "row int, empresa string, header_code string, sub_header_code int, item_code int, valor double, "
        "month int, year int")
    opening = spark.createDataFrame([("ANTEL", None), ("AFE", 100.0)], "empresa string, saldo_inicial_miles double")
    out = accounts.cash_monthly(acts, opening)
    got = {(r["empresa"], r["fecha"].month): r for r in out.collect()}
    assert got[("ANTEL", 1)]["saldo"] == 2966359000.0
    assert got[("ANTEL", 2)]["saldo"] == 2966359000.0 - 3000.0
    assert got[("ANTEL", 3)]["saldo"] == 2966359000.0 - 6000.0
    assert got[("ANTEL", 1)]["saldo_minimo"] == pytest.approx(1e3 * 2400.0 / 12)
    assert got[("AFE", 1)]["saldo"] == 100000.0
    assert got[("AFE", 1)]["saldo_minimo"] == pytest.approx(172474688.0)
    view = dashboard.cash_view(out).where("empresa = 'AFE'").first()
    assert view["linea_label"] == "Un mes de Gastos + Impuestos" and view["tooltip"] == "Ene 2025: $ 0"


def test_macro_series(spark):
    heads = ["I 2024", "II 2024", "III 2024", "IV 2024", "I 2025*"]
    gdp = spark.createDataFrame(
        [("pib", "s", 6, 1, None, "Periodo")] +
        [("pib", "s", 6, c, None, h) for c, h in enumerate(heads, start=2)] +
        [("pib", "s", 19, c, None, str(10 * c)) for c in range(2, 7)],
        "workbook string, sheet string, row int, col int, numeric double, character string")
    serial0 = 45292  # 2024-01-01
    idx_rows = [(1, "Periodo", "Indice")]
    for y, base in ((2024, 0), (2025, 366)):
        for m in range(12):
            d = dt.date(y, m + 1, 1)
            idx_rows.append((len(idx_rows) + 1, str((d - dt.date(1899, 12, 30)).days), str(100.0 + (y - 2024) * 10)))
    index = spark.createDataFrame(idx_rows, "row int, c1 string, c2 string")
    rate = spark.createDataFrame([(1, "fecha", None, "venta"), (2, "02-01-2024", None, "39"),
                                  (3, "03/01/2024", None, "41"), (4, "2025-01-02", None, "44"),
                                  (5, "junk", None, "x")], "row int, c1 string, c2 string, c3 string")
    r = accounts.macro_series(gdp, index, rate, M)
    assert rows(r.gdp) == [(2024, 1e6 * (20 + 30 + 40 + 50)), (2025, pytest.approx(1e6 * 140 * 1.025))]
    assert rows(r.index) == [(2024, 100.0), (2025, pytest.approx(110.0))]
    assert rows(r.rate) == [(2024, 40.0), (2025, 44.0)]
    assert serial0 == (dt.date(2024, 1, 1) - dt.date(1899, 12, 30)).days


def test_projections(spark):
    sheet = spark.createDataFrame([
        ("A", 1.0, 0.0, "Ventas", "r", "10", "20"), ("E", 1.0, 0.0, "Resultado", "r", "1", None),
        ("Z", 1.0, 0.0, "Otro", "r", "5", "5"), (None, 1.0, 0.0, "Sin header", "r", "1", "1"),
    ], "header string, SubHeader double, Item double, label string, rubro string, ANCAP string, UTE string")
    mk = lambda col, v: spark.createDataFrame([(2025, v)], f"year int, {col} double")
    refs25 = ReferenceSeries(mk(M.index_value, 125.0), mk(M.gdp_value, 1e6), mk(M.rate_value, 40.0))
    out = accounts.projections(sheet, refs25, M)
    assert out.count() == 6
    r = out.where("label = 'Ventas' AND ente = 'UTE'").first()
    assert (r["header"], r["ejecutado"], r["ejecutado_2024"], r["ejecutado_usd"]) == ("Ingresos", 20000.0, 16000.0, 500.0)
    assert r["header_ord"] == 1 and r["ente_ord"] == 2 and r["tipo"] == "Proyección"
    assert out.where("label = 'Otro'").first()["header"] is None


def test_kpis_and_facet_series_in_every_unit(spark):
    annual = spark.createDataFrame([
        ("ANCAP", 2024, "Ingresos", "Ingresos", 2.0e9, 1.8e9, 0.02, 5.0e7),
        ("UTE", 2024, "Ingresos", "Ingresos", 3.0e9, 2.7e9, 0.03, 7.5e7),
        ("UTE", 2023, "Ingresos", "Ingresos", 9.0e9, 9.0e9, 0.09, 9.0e7),
        ("UTE", 2024, "Resultado", "Resultado", -5.0e8, None, -0.005, -1.25e7),
    ], "empresa string, year int, facet_col string, fill_col string, valor double, valor_2024 double, "
       "valor_pct_pib double, valor_usd double")
    k = {r["facet_col"]: r for r in dashboard.kpi_totals(annual, "valor").collect()}
    assert k["Ingresos"]["total"] == 5.0e9 and k["Ingresos"]["label"] == "$ 5.000"
    assert k["Resultado"]["label"] == "-$ 500"
    pct = {r["facet_col"]: r["label"] for r in dashboard.kpi_totals(annual, "valor_pct_pib").collect()}
    assert pct == {"Ingresos": "5,00%", "Resultado": "-0,50%"}
    usd = {r["facet_col"]: r["total"] for r in dashboard.kpi_totals(annual, "valor_2024").collect()}
    assert usd["Resultado"] is None  # strict sum: one NULL makes the KPI NULL
    with pytest.raises(ValueError):
        dashboard.kpi_totals(annual, "valor_x")
    fs = dashboard.facet_series(annual, "valor_usd").where("facet_col = 'Ingresos' AND year = 2024")
    assert rows(fs, "empresa", "ejecutado", "tooltip") == [("ANCAP", 5.0e7, "US$ 50"), ("UTE", 7.5e7, "US$ 75")]
    titles = dashboard.panel_titles(spark.createDataFrame([("UTE", 2025), ("AFE", None)], "empresa string, year int"),
                                    ["Ingresos", "I"])
    assert rows(titles, "empresa", "title") == [("AFE", "AFE - Caja Mensual"), ("AFE", "AFE - Ingresos Corrientes"),
                                                ("UTE", "UTE - Caja Mensual 2025"),
                                                ("UTE", "UTE - Ingresos Corrientes 2025")]


def test_gdp_total_row_by_label(spark):
    cells = spark.createDataFrame(
        [("pib", "s", 6, c, None, h) for c, h in enumerate(["I 2024", "II 2024", "III 2024", "IV 2024"], start=2)] +
        [("pib", "s", 21, 1, None, " pib total "), ("pib", "s", 19, 1, None, "Otro")] +
        [("pib", "s", 21, c, None, "1") for c in range(2, 6)] + [("pib", "s", 19, c, None, "9") for c in range(2, 6)],
        "workbook string, sheet string, row int, col int, numeric double, character string")
    by_label = accounts.gdp_series(cells, M, total_label="PIB total")
    assert rows(by_label.where("year = 2024")) == [(2024, 4e6)]
    assert rows(accounts.gdp_series(cells, M).where("year = 2024")) == [(2024, 36e6)]


def test_label_guard_holds_whatever_is_read(spark):
    _, by_company = accounts.structure_maps(structure(spark))
    twice = by_company.unionByName(by_company)
    with pytest.raises(PySparkException, match="duplicate keys after normalization"):
        accounts.label_map(twice).count()


def test_two_workbooks_of_a_year_do_not_mix(spark):
    from ledgerlake.sources.cells import cells_to_long
    sheet = lambda w, name: [(w, "S", 6, 2, None, name), (w, "S", 7, 1, None, f"row of {w}"), (w, "S", 7, 2, 1.0, None)]
    cells = spark.createDataFrame(sheet("w1", "A") + sheet("w2", "B"),
                                  "workbook string, sheet string, row int, col int, numeric double, character string")
    out = cells_to_long(cells, 6)
    assert rows(out, "workbook", "empresa", "label", "valor") == [("w1", "A", "row of w1", 1.0), ("w2", "B", "row of w2", 1.0)]


def test_label_order_ties_and_month_year_label(spark):
    from ledgerlake.functions.display import month_year_label
    facts = spark.createDataFrame([("X", "G", "b", 5.0), ("X", "G", "a", -5.0), ("X", "G", "c", 9.0),
                                   ("Y", "G", "a", 1.0)], "empresa string, facet_col string, label string, valor double")
    order = dashboard.label_order(facts)
    assert rows(order, "empresa", "label", "label_ord") == [("X", "a", 2), ("X", "b", 3), ("X", "c", 1), ("Y", "a", 1)]
    d = spark.createDataFrame([(dt.date(2025, 9, 1),)], "d date")
    assert d.select(month_year_label("d").alias("m")).first()["m"] == "Sept 2025"
