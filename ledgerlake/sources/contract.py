"""Dataset contract: declared datasets, read-by-id and verification
(SRC-09, DQ-01..DQ-06).

The contract is small driver-side configuration (a JSON document). Each
dataset is checked with ONE aggregate job (rows, duplicate keys and newest
file time together); only that one row comes back to the driver.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.operators.quality import issues_frame
from ledgerlake.sources.landed import READ_FORMATS, read_table


@dataclass(frozen=True)
class DatasetEntry:
    id: str
    output_path: str
    format: str = "parquet"
    produced_by: str = ""
    description: str = ""
    required_columns: tuple[str, ...] = ()
    optional_columns: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ()
    max_age_hours: float | None = None
    row_count_min: int | None = None
    unique_key: bool = False

    @staticmethod
    def from_dict(d: dict) -> "DatasetEntry":
        schema = d.get("minimum_schema") or {}
        rules = d.get("validation_rules") or {}
        fresh = d.get("freshness") or {}
        return DatasetEntry(
            id=d["id"], output_path=d["output_path"], format=d.get("format", "parquet"),
            produced_by=d.get("produced_by", ""), description=d.get("description", ""),
            required_columns=tuple(schema.get("required_columns") or ()),
            optional_columns=tuple(schema.get("optional_columns") or ()),
            key_columns=tuple(schema.get("key_columns") or ()),
            max_age_hours=fresh.get("max_age_hours"),
            row_count_min=rules.get("row_count_min"),
            unique_key=bool(rules.get("unique_key", False)),
        )


@dataclass
class Contract:
    entries: list[DatasetEntry] = field(default_factory=list)
    root: str = ""
    regenerate: str = "python -m ledgerlake.plans.artifacts"

    @staticmethod
    def from_json(text: str, root: str = "") -> "Contract":
        doc = json.loads(text)
        return Contract([DatasetEntry.from_dict(d) for d in doc.get("required_datasets", [])], root)

    @staticmethod
    def load(path: str, root: str = "") -> "Contract":
        with open(path, encoding="utf-8") as fh:
            return Contract.from_json(fh.read(), root)

    def path_of(self, entry: DatasetEntry) -> str:
        p = entry.output_path
        if not self.root or "://" in p or p.startswith("/"):
            return p
        return f"{self.root.rstrip('/')}/{p}"

    def entry(self, dataset_id: str) -> DatasetEntry:
        match = [e for e in self.entries if e.id == dataset_id]
        if len(match) != 1:
            raise KeyError(f"Dataset id '{dataset_id}' is not declared in the required data manifest.")
        return match[0]


class ContractError(RuntimeError):
    pass


def _is_missing(err: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err)


def read_required_dataset(spark: SparkSession, contract: Contract, dataset_id: str) -> DataFrame:
    """Read a dataset through the contract; typed errors as in the source."""
    entry = contract.entry(dataset_id)
    path = contract.path_of(entry)
    if entry.format not in READ_FORMATS:
        raise ContractError(f"Failed to read required dataset '{entry.id}' at {path}: "
                            f"Unsupported dataset format '{entry.format}'.")
    try:
        df = read_table(spark, path, entry.format)
    except AnalysisException as err:
        if _is_missing(err):
            raise ContractError(
                f"Required dataset '{entry.id}' is missing at {path}. Run {contract.regenerate} "
                f"to generate it (pipeline step: {entry.produced_by}).") from err
        raise ContractError(f"Failed to read required dataset '{entry.id}' at {path}: {err}") from err
    except (PySparkException, Py4JJavaError) as err:
        raise ContractError(f"Failed to read required dataset '{entry.id}' at {path}: "
                            f"{str(err).strip()}") from err
    missing = [c for c in entry.required_columns if c not in df.columns]
    if missing:
        raise ContractError(f"Dataset '{entry.id}' is missing required columns: {', '.join(missing)}")
    return df


def _dataset_stats(df: DataFrame, keys: tuple[str, ...]) -> dict:
    mtime = F.col("_metadata.file_modification_time")
    if keys:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max(mtime).alias("__t"))
        row = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                          F.count(F.when(F.col("__n") > 1, F.lit(1))).alias("dups"),
                          F.max("__t").alias("mtime")).first()
    else:
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).alias("dups"), F.max(mtime).alias("mtime")).first()
    return row.asDict()


def verify_entry(spark: SparkSession, contract: Contract, entry: DatasetEntry,
                 now: float | None = None) -> list[dict]:
    """Issues of one dataset (empty list = pass)."""
    path = contract.path_of(entry)

    def issue(kind: str, detail: str) -> dict:
        return {"type": kind, "id": entry.id, "output_path": entry.output_path,
                "produced_by": entry.produced_by, "detail": detail, "regenerate": contract.regenerate}

    if entry.format not in READ_FORMATS:
        return [issue("unreadable", f"Unsupported dataset format '{entry.format}'.")]
    try:
        df = read_table(spark, path, entry.format)
        checks_schema = entry.required_columns or entry.key_columns or entry.row_count_min is not None
        absent = [k for k in entry.key_columns if k not in df.columns] if entry.unique_key else []
        keys = tuple(entry.key_columns) if entry.unique_key and not absent else ()
        stats = _dataset_stats(df, keys) if (checks_schema or entry.max_age_hours is not None) else None
    except AnalysisException as err:
        if _is_missing(err):
            return [issue("missing", "File does not exist.")]
        return [issue("unreadable", str(err).strip())]
    except (PySparkException, Py4JJavaError) as err:  # e.g. a corrupt file footer
        return [issue("unreadable", str(err).strip())]
    out = []
    if checks_schema:
        missing = [c for c in entry.required_columns if c not in df.columns]
        if missing:
            out.append(issue("schema", f"Missing required columns: {', '.join(missing)}"))
        if entry.row_count_min is not None and stats["rows"] < entry.row_count_min:
            out.append(issue("row_count", f"Row count {stats['rows']} is below minimum {entry.row_count_min}."))
        if entry.unique_key:
            if not entry.key_columns:
                out.append(issue("schema", "unique_key is true but key_columns is empty."))
            elif absent:
                out.append(issue("schema", f"Missing key columns: {', '.join(absent)}"))
            elif stats["dups"] > 0:
                out.append(issue("schema", f"Duplicate rows found for key columns: {', '.join(entry.key_columns)}"))
    if entry.max_age_hours is not None:
        now = time.time() if now is None else now
        mtime = stats["mtime"]
        age = None if mtime is None else (now - mtime.timestamp()) / 3600.0
        if age is None or age > entry.max_age_hours:
            shown = "NA" if age is None else f"{age:.2f}"
            out.append(issue("stale", f"File age {shown} hours exceeds max_age_hours {entry.max_age_hours}."))
    return out


def verify_contract(spark: SparkSession, contract: Contract, now: float | None = None) -> DataFrame:
    """All issues of all datasets as a DataFrame (DQ-06); empty means PASS."""
    issues: list[dict] = []
    for entry in contract.entries:
        issues.extend(verify_entry(spark, contract, entry, now))
    return issues_frame(spark, issues)
