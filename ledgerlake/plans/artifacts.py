"""The artifact job (SNK-01, SNK-02): build the bundle once, write each
dataset to a new version, commit the version. The actuals feed several outputs, so they are written to the shared
folder once and reread."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.config import DEFAULT_CASH, DEFAULT_METHODOLOGY, CashConfig, MonetaryMethodology, Rule
from ledgerlake.operators.classify import dashboard_facts
from ledgerlake.operators.measures import validate_references
from ledgerlake.operators.periods import latest
from ledgerlake.plans import accounts
from ledgerlake.session import scratch_path
from ledgerlake.sources.landed import commit_version, current_version, drop_table, new_version

PARTITIONED = ("series_anuales",)


@dataclass
class LandedInputs:
    actual_cells: DataFrame      # cells with year, sheet
    structure_sheet: DataFrame   # row, Header, SubHeader, Item, Label, <companies>
    budget_source: DataFrame     # sheet, row, concepto, enero..diciembre
    budget_template: DataFrame   # sheet, row, header, sub_header, item, concepto, months
    opening_sheet: DataFrame     # empresa, saldo_inicial_miles
    gdp_cells: DataFrame
    index_sheet: DataFrame       # row, c1 (serial), c2 (value)
    rate_sheet: DataFrame        # row, c1 (date text), c3 (quote)
    projection_sheet: DataFrame  # header, SubHeader, Item, label, rubro, <companies>


def build_bundle(inp: LandedInputs, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                 cash: CashConfig = DEFAULT_CASH, validate: bool = True, rules: Sequence[Rule] | None = None,
                 stock_entity: str = "ANCAP", on_missing: str = "raise",
                 intermediate: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The seven datasets of an import. ``intermediate``, if given, receives
    what the import passes through: both structure maps, the actuals, the
    budget as matched and as classified."""
    by_row, by_company = accounts.structure_maps(inp.structure_sheet)
    spark = inp.actual_cells.sparkSession
    landed = scratch_path(spark, "actuals")
    accounts.actuals_from_cells(inp.actual_cells, by_row).write.parquet(landed)
    actuals = spark.read.parquet(landed)
    refs = accounts.macro_series(inp.gdp_cells, inp.index_sheet, inp.rate_sheet, m)
    if validate:
        # the series are one row per year: a few one-row aggregates, then stop
        # before anything is written if a series is unusable
        validate_references(refs, m)
    budget = accounts.budget_raw(inp.budget_source, inp.budget_template, by_company, latest(actuals, "year"))
    if validate:
        # every import classifies the budget: a blank label stops the run here
        accounts.budget_monthly(budget, rules).write.format("noop").mode("overwrite").save()
    if intermediate is not None:
        intermediate |= {"structure_by_row": by_row, "structure_by_company": by_company, "actuals": actuals,
                         "budget_raw": budget, "budget_monthly": accounts.budget_monthly(budget, rules)}
    monthly = accounts.series_monthly(actuals, budget, by_company, rules)
    return {
        "series_anuales": accounts.series_annual(actuals, refs, m, rules, on_missing),
        "series_mensuales": dashboard_facts(monthly, stock_entity),
        "caja_mensual": accounts.cash_monthly(actuals, inp.opening_sheet, cash),
        "serie_ipc_anual_24": refs.index,
        "serie_pib_anual": refs.gdp,
        "dolar_promedio_anual": refs.rate,
        "proyecciones": accounts.projections(inp.projection_sheet, refs, m, on_missing=on_missing).drop("header_ord", "ente_ord"),
    }


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bundle(bundle: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write every dataset to a new version of the bundle, then commit it.
    Whatever stops the job before the commit - a guard in any dataset, a lost
    driver - readers go on seeing the last committed version, whole; after it
    they see the new one, whole. Returns the new paths."""
    spark = next(iter(bundle.values())).sparkSession
    version, folder = new_version(out_dir)
    paths = {name: f"{folder}/{name}" for name in bundle}
    try:
        for name, df in bundle.items():
            write_dataset(df, paths[name], ("year",) if "year" in df.columns and name in PARTITIONED else ())
    except Exception:
        drop_table(spark, folder)
        raise
    commit_version(spark, out_dir, version)
    return paths


def read_dataset(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A dataset of the current version of a bundle."""
    return spark.read.parquet(f"{current_version(spark, out_dir)}/{name}")


def read_series(spark, path: str, empresa=None, facet=None, years=None) -> DataFrame:
    """A published series (its folder in a version of the bundle) cut to
    companies, facets and years (FLT-10): the year filter prunes partition folders, the others reach the reader."""
    df = spark.read.parquet(path)
    for column, values in (("empresa", empresa), ("facet_col", facet), ("year", years)):
        if values is not None:
            df = df.where(F.col(column).isin(*values))
    return df


# Dataset contract of the bundle: required columns per artifact (fixed
# values of the dashboard's data contract).
ARTIFACT_CONTRACT = {"required_datasets": [
    {"id": "series_anuales", "output_path": "series_anuales", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["empresa", "year", "facet_col", "fill_col", "valor", "valor_2024",
                                             "valor_pct_pib", "valor_usd"]},
     "validation_rules": {"row_count_min": 1, "unique_key": False}},
    {"id": "series_mensuales", "output_path": "series_mensuales", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["fecha", "empresa", "facet_col", "fill_col", "label", "valor", "tipo",
                                             "header_code", "sub_header_code", "item_code", "keep"]},
     "validation_rules": {"row_count_min": 1, "unique_key": False}},
    {"id": "caja_mensual", "output_path": "caja_mensual", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["header_code", "sub_header_code", "item_code", "empresa", "saldo",
                                             "saldo_minimo_gastos", "saldo_minimo_ingresos", "saldo_minimo", "fecha"]},
     "validation_rules": {"row_count_min": 1, "unique_key": False}},
    {"id": "serie_ipc_anual_24", "output_path": "serie_ipc_anual_24", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["year", "ipc_base_24"], "key_columns": ["year"]},
     "validation_rules": {"row_count_min": 1, "unique_key": True}},
    {"id": "serie_pib_anual", "output_path": "serie_pib_anual", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["year", "pib_nominal"], "key_columns": ["year"]},
     "validation_rules": {"row_count_min": 1, "unique_key": True}},
    {"id": "dolar_promedio_anual", "output_path": "dolar_promedio_anual", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["year", "dolar_promedio"], "key_columns": ["year"]},
     "validation_rules": {"row_count_min": 1, "unique_key": True}},
    {"id": "proyecciones", "output_path": "proyecciones", "format": "parquet",
     "produced_by": "ledgerlake.plans.artifacts",
     "minimum_schema": {"required_columns": ["header", "label", "ente", "ejecutado", "year", "ejecutado_2024",
                                             "ejecutado_pct_pib", "ejecutado_usd", "tipo"]},
     "validation_rules": {"row_count_min": 1, "unique_key": False}},
]}

LANDED_FOLDERS = ("actual_cells", "structure_sheet", "budget_source", "budget_template", "opening_sheet",
                  "gdp_cells", "index_sheet", "rate_sheet", "projection_sheet")


def read_landed(spark, root: str) -> LandedInputs:
    """Landed inputs as parquet folders under ``root`` (one per input;
    ``actual_cells`` partitioned ``year=/sheet=``)."""
    from pyspark.errors import AnalysisException

    from ledgerlake.sources.cells import read_cells
    root = root.rstrip("/")
    parts = {}
    for name in LANDED_FOLDERS:
        path = f"{root}/{name}"
        try:
            parts[name] = read_cells(spark, path) if name == "actual_cells" else spark.read.parquet(path)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
                raise FileNotFoundError(f"Missing required file: {path}") from err
            raise
    return LandedInputs(**parts)


def main(argv=None) -> int:
    """``python -m ledgerlake.plans.artifacts --landed DIR --out DIR [--verify]``:
    build the bundle once, write each dataset, then check the written
    datasets against the contract (exit status 1 on any issue)."""
    import argparse
    import json

    from ledgerlake.session import get_session
    from ledgerlake.sources.contract import Contract, verify_contract
    p = argparse.ArgumentParser(prog="ledgerlake.plans.artifacts")
    p.add_argument("--landed", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--verify", action="store_true")
    args = p.parse_args(argv)
    spark = get_session()
    landed = read_landed(spark, args.landed)
    write_bundle(build_bundle(landed), args.out)
    for r in accounts.budget_unmatched(landed.budget_source, landed.budget_template).orderBy("sheet").toLocalIterator():
        print(f"Dropped {r['dropped_rows']} unmatched firmado row(s) from sheet '{r['sheet']}'.")
    if not args.verify:
        return 0
    contract = Contract.from_json(json.dumps(ARTIFACT_CONTRACT), root=current_version(spark, args.out))
    issues = verify_contract(spark, contract).collect()
    for r in issues:
        print(f"{r['type']}: {r['id']}: {r['detail']}")
    print(f"{'FAIL' if issues else 'PASS'}: {len(ARTIFACT_CONTRACT['required_datasets'])} dataset(s) checked")
    return 1 if issues else 0


if __name__ == "__main__":
    raise SystemExit(main())
