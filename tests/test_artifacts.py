"""The artifact job end to end on tiny landed inputs, and the streaming ingest."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.plans import accounts
from ledgerlake.plans import artifacts
from ledgerlake.plans.artifacts import LandedInputs, build_bundle, read_dataset, write_bundle
from ledgerlake.sources.landed import commits, current_version, drop_versions, write_table
from ledgerlake.streaming import ingest_new_sheets
from tests.test_accounts import actual_cells, budget_sheets, structure


def landed_inputs(spark):
    src, tpl = budget_sheets(spark)
    heads = [f"{q} {y}" for y in (2023, 2024) for q in ("I", "II", "III", "IV")]
    gdp = spark.createDataFrame(
        [("pib", "s", 6, c, None, h) for c, h in enumerate(heads, start=2)] +
        [("pib", "s", 19, c, None, "100") for c in range(2, 2 + len(heads))],
        "workbook string, sheet string, row int, col int, numeric double, character string")
    idx = [(1, "Periodo", "Indice")]
    for y in (2023, 2024, 2025):
        for m in range(1, 13):
            idx.append((len(idx) + 1, str((dt.date(y, m, 1) - dt.date(1899, 12, 30)).days), str(90 + 10 * (y - 2023))))
    index = spark.createDataFrame(idx, "row int, c1 string, c2 string")
    rate = spark.createDataFrame([(1, "fecha", None, "venta"), (2, "02-01-2023", None, "40"),
                                  (3, "2024-01-02", None, "50"), (4, "2025-01-02", None, "50")], "row int, c1 string, c2 string, c3 string")
    opening = spark.createDataFrame([("ANCAP", 100.0)], "empresa string, saldo_inicial_miles double")
    projection = spark.createDataFrame([("A", 1.0, 0.0, "Ventas", "r", "10"), (None, 1.0, 0.0, "x", "r", "1")],
                                       "header string, SubHeader double, Item double, label string, rubro string, ANCAP string")
    return LandedInputs(actual_cells(spark), structure(spark), src, tpl, opening, gdp, index, rate, projection)


def test_artifact_job_roundtrip(spark, tmp_path):
    bundle = build_bundle(landed_inputs(spark))
    assert set(bundle) == {"series_anuales", "series_mensuales", "caja_mensual", "serie_ipc_anual_24",
                           "serie_pib_anual", "dolar_promedio_anual", "proyecciones"}
    paths = write_bundle(bundle, str(tmp_path / "processed"))
    back = {k: spark.read.parquet(p) for k, p in paths.items()}
    assert back["serie_pib_anual"].count() == 3          # 2023, 2024 + projected 2025
    assert back["serie_ipc_anual_24"].where("year = 2024").first()["ipc_base_24"] == 100.0
    anual = back["series_anuales"]
    assert anual.where("empresa = 'ANCAP' AND year = 2024").first()["valor"] == 200000.0
    assert set(anual.columns) >= {"valor", "valor_2024", "valor_pct_pib", "valor_usd", "year"}
    mensual = back["series_mensuales"]
    assert "keep" in mensual.columns and mensual.count() > 0
    projected = back["proyecciones"].collect()
    assert [(r["header"], r["ente"], r["ejecutado"], r["tipo"]) for r in projected] == [("Ingresos", "ANCAP", 10000.0, "Proyección")]
    assert "header_ord" not in back["proyecciones"].columns
    caja = back["caja_mensual"].where("empresa = 'ANCAP'").orderBy("fecha").collect()
    assert [r["saldo"] for r in caja] == [100000.0, 100000.0 - 10000.0]
    assert caja[0]["saldo_minimo"] == 21822288449.0


def test_streaming_ingest_of_landed_sheets(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write_table(actual_cells(spark), landing, partition_by=["year", "sheet"])
    by_row, _ = accounts.structure_maps(structure(spark))
    out, ckpt = str(tmp_path / "facts"), str(tmp_path / "ckpt")
    ingest_new_sheets(spark, landing, by_row, out, ckpt).awaitTermination(120)
    facts = spark.read.parquet(out)
    expected = accounts.actuals_from_cells(actual_cells(spark), by_row)
    assert facts.count() == expected.count()
    # a second run with nothing new landed appends nothing
    ingest_new_sheets(spark, landing, by_row, out, ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == expected.count()
    assert facts.where(F.col("empresa") == "OSE").select("year").distinct().collect()[0]["year"] == 2024


def test_artifact_schemas_match_the_contract(spark):
    """Required columns of the dataset contract (minimum schema per dataset)."""
    bundle = build_bundle(landed_inputs(spark))
    assert bundle["series_anuales"].columns == ["empresa", "year", "facet_col", "fill_col", "valor", "valor_2024",
                                                "valor_pct_pib", "valor_usd"]
    assert set(bundle["series_mensuales"].columns) == {"fecha", "empresa", "facet_col", "fill_col", "label", "valor",
                                                       "tipo", "header_code", "sub_header_code", "item_code", "keep"}
    assert bundle["caja_mensual"].columns == ["header_code", "sub_header_code", "item_code", "empresa", "saldo",
                                              "saldo_minimo_gastos", "saldo_minimo_ingresos", "saldo_minimo", "fecha"]
    assert bundle["serie_ipc_anual_24"].columns == ["year", "ipc_base_24"]
    assert bundle["serie_pib_anual"].columns == ["year", "pib_nominal"]
    assert bundle["dolar_promedio_anual"].columns == ["year", "dolar_promedio"]
    assert dict(bundle["series_mensuales"].dtypes)["fecha"] == "date"
    keys = ["fecha", "empresa", "facet_col", "fill_col", "label", "tipo", "header_code", "sub_header_code", "item_code"]
    m = bundle["series_mensuales"]
    assert m.count() == m.select(*keys).distinct().count()  # unique on all but valor


def test_artifact_command_writes_and_verifies(spark, tmp_path):
    from ledgerlake.plans.artifacts import main
    inp = landed_inputs(spark)
    landed = tmp_path / "landed"
    write_table(inp.actual_cells, str(landed / "actual_cells"), partition_by=["year", "sheet"])
    for name in ("structure_sheet", "budget_source", "budget_template", "opening_sheet", "gdp_cells",
                 "index_sheet", "rate_sheet", "projection_sheet"):
        write_table(getattr(inp, name), str(landed / name))
    assert main(["--landed", str(landed), "--out", str(tmp_path / "out"), "--verify"]) == 0
    assert read_dataset(spark, str(tmp_path / "out"), "caja_mensual").count() == 2


def test_bundle_stops_on_invalid_reference_series(spark, tmp_path):
    import dataclasses

    from ledgerlake.operators.measures import ReferenceSeriesError
    from ledgerlake.plans.artifacts import read_landed
    inp = landed_inputs(spark)
    no_base = dataclasses.replace(inp, index_sheet=inp.index_sheet.where("c1 NOT LIKE '45%'"))  # drops 2024
    with pytest.raises(ReferenceSeriesError, match="base year 2024"):
        build_bundle(no_base)
    with pytest.raises(FileNotFoundError, match="Missing required file"):
        read_landed(spark, str(tmp_path / "nothing"))


def test_failing_guard_leaves_published_artifacts(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.createDataFrame([(1, "a")], "year int, label string")
    paths = write_bundle({"one": good, "two": good}, out)
    bad = accounts.stop_if(good, F.col("label") == "a", "blank label")
    with pytest.raises(PySparkException, match="blank label"):
        write_bundle({"one": good.withColumn("label", F.lit("new")), "two": bad}, out)
    for name in ("one", "two"):
        assert [r["label"] for r in read_dataset(spark, out, name).collect()] == ["a"]
    with pytest.raises(PySparkException, match="blank label"):
        write_table(bad, paths["one"])
    assert spark.read.parquet(paths["one"]).count() == 1
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 1   # what was half written is gone
    with pytest.raises(FileNotFoundError, match="No committed version"):
        current_version(spark, str(tmp_path / "nothing"))


def test_a_crash_at_any_step_leaves_all_seven_datasets_readable(spark, tmp_path, monkeypatch):
    """Steps: seven writes, then the commit. A crash (nothing is cleaned up)
    before, inside or after any of them but a finished commit shows the old
    bundle whole; readers never see a mixture."""
    out = str(tmp_path / "out")
    names = list(build_bundle(landed_inputs(spark)))
    frame = lambda tag: spark.createDataFrame([(2024, tag)], "year int, tag string")
    seen = lambda: {n: [r["tag"] for r in read_dataset(spark, out, n).collect()] for n in names}
    write_bundle({n: frame("old") for n in names}, out)
    write, commit, steps = artifacts.write_dataset, artifacts.commit_version, []

    class Crash(BaseException):   # like a killed driver: no handler of the job runs
        pass

    for step in range(2 * len(names) + 1):
        def writing(df, path, partition_by=(), step=step):
            steps.append("write")
            if len(steps) == step // 2 + 1 and step % 2 == 0:
                raise Crash
            write(df, path, partition_by)
            if len(steps) == step // 2 + 1:
                raise Crash

        def committing(*args):
            raise Crash
        steps.clear()
        monkeypatch.setattr(artifacts, "write_dataset", writing)
        monkeypatch.setattr(artifacts, "commit_version", committing)
        with pytest.raises(Crash):
            write_bundle({n: frame("new") for n in names}, out)
        assert seen() == {n: ["old"] for n in names}, step
    monkeypatch.setattr(artifacts, "write_dataset", write)
    monkeypatch.setattr(artifacts, "commit_version", commit)
    reader = read_dataset(spark, out, "caja_mensual")
    write_bundle({n: frame("new") for n in names}, out)
    assert seen() == {n: ["new"] for n in names}
    assert [r["tag"] for r in reader.collect()] == ["old"]   # an open reader keeps its version
    assert [n for n, _ in commits(spark, out)] == [1, 2]
    assert len(drop_versions(spark, out, keep=1)) == 1       # the old one; crashed ones may still be written
    assert len(drop_versions(spark, out, keep=1, abandoned_hours=0)) == 2 * len(names)   # but the one that wrote nothing
    assert seen() == {n: ["new"] for n in names}


def test_sheet_without_header_stops_the_import(spark, tmp_path):
    by_row, _ = accounts.structure_maps(structure(spark))
    cells = actual_cells(spark)
    first = cells.where("numeric IS NOT NULL").first()
    here = (F.col("year") == first["year"]) & (F.col("sheet") == first["sheet"])
    headless = cells.where(~(here & (F.col("row") == 6)))
    with pytest.raises(PySparkException, match="Sheet without a header in row 6"):
        accounts.actuals_from_cells(headless, by_row).select("valor").collect()
    assert accounts.actuals_from_cells(headless.where(~here), by_row).count() < accounts.actuals_from_cells(cells, by_row).count()


def test_relanded_sheet_replaces_its_facts(spark, tmp_path):
    """A corrected sheet, two landings of one sheet in the same run, and a
    headless one, which stops the run and leaves all facts."""
    landing, out, ckpt = (str(tmp_path / n) for n in ("landing", "facts", "ckpt"))
    by_row, _ = accounts.structure_maps(structure(spark))
    cells = actual_cells(spark)
    first = cells.where("numeric IS NOT NULL").first()
    sheet = cells.where((F.col("year") == first["year"]) & (F.col("sheet") == first["sheet"]))

    def land(df):
        df.coalesce(1).write.mode("append").partitionBy("year", "sheet").parquet(landing)

    def ingest():
        ingest_new_sheets(spark, landing, by_row, out, ckpt).awaitTermination(120)
        return sorted(map(tuple, spark.read.parquet(out).select("year", "month", "row", "empresa", "valor").collect()), key=repr)

    def facts(df):
        return sorted(map(tuple, accounts.actuals_from_cells(df, by_row).select("year", "month", "row", "empresa", "valor")
                          .collect()), key=repr)
    land(cells)
    assert ingest() == facts(cells)
    shorter = sheet.where((F.col("row") != first["row"]) | (F.col("col") != first["col"]))   # a fact is withdrawn
    others = cells.join(sheet.select("year", "sheet").distinct(), ["year", "sheet"], "left_anti")
    land(shorter.withColumn("numeric", -F.col("numeric")))
    land(shorter.withColumn("numeric", 3 * F.col("numeric")))
    want = sorted(facts(others) + facts(shorter.withColumn("numeric", 3 * F.col("numeric"))), key=repr)
    assert ingest() == want
    assert ingest() == want
    land(sheet.where("row <> 6"))
    with pytest.raises(Exception, match="Sheet without a header"):
        ingest()
    assert sorted(map(tuple, spark.read.parquet(out).select("year", "month", "row", "empresa", "valor").collect()), key=repr) == want


def test_import_hands_out_what_it_passes_through(spark):
    between = {}
    build_bundle(landed_inputs(spark), intermediate=between)
    assert set(between) == {"structure_by_row", "structure_by_company", "actuals", "budget_raw", "budget_monthly"}
    assert between["budget_monthly"].columns == ["fecha", "label", "empresa", "facet_col", "fill_col", "valor",
                                                 "header_code", "sub_header_code", "item_code"]
    assert between["actuals"].count() == accounts.actuals_from_cells(actual_cells(spark), between["structure_by_row"]).count()


def test_year_filter_prunes_folders(spark, tmp_path):
    from ledgerlake.plans.artifacts import read_series
    df = spark.createDataFrame([(y, e, "Ingresos", 1.0) for y in (2023, 2024) for e in ("A", "B")],
                               "year int, empresa string, facet_col string, valor double")
    paths = write_bundle({"series_anuales": df}, str(tmp_path))
    got = read_series(spark, paths["series_anuales"], ["A"], ["Ingresos"], [2024])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [year" in plan
    assert "In(empresa" in plan or "EqualTo(empresa" in plan
    assert [(r["year"], r["empresa"]) for r in got.collect()] == [(2024, "A")]
