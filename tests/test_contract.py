import json
import time

import pytest

from ledgerlake.sources.contract import Contract, ContractError, read_required_dataset, verify_contract
from tests.conftest import rows


@pytest.fixture()
def landed(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string").write.parquet(str(tmp_path / "dup"))
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "ok"))
    doc = {"required_datasets": [
        {"id": "ok", "output_path": "ok", "format": "parquet", "produced_by": "job",
         "minimum_schema": {"required_columns": ["k", "v"], "key_columns": ["k"]},
         "freshness": {"max_age_hours": 1.0}, "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "dup", "output_path": "dup", "format": "parquet",
         "minimum_schema": {"required_columns": ["k", "w"], "key_columns": ["k"]},
         "validation_rules": {"row_count_min": 5, "unique_key": True}},
        {"id": "nokeys", "output_path": "ok", "format": "parquet",
         "validation_rules": {"row_count_min": 1, "unique_key": True}},
        {"id": "unchecked", "output_path": "ok", "format": "parquet", "validation_rules": {"unique_key": True}},
        {"id": "gone", "output_path": "gone", "format": "parquet"},
        {"id": "rds", "output_path": "ok", "format": "rds"},
        {"id": "old", "output_path": "ok", "format": "parquet", "freshness": {"max_age_hours": 1.0}},
    ]}
    return Contract.from_json(json.dumps(doc), root=str(tmp_path))


def test_verify_contract_issue_rows(spark, landed):
    later = time.time() + 7200
    issues = verify_contract(spark, landed, now=later)
    got = rows(issues, "id", "type")
    assert got == [("dup", "row_count"), ("dup", "schema"), ("dup", "schema"), ("gone", "missing"),
                   ("nokeys", "schema"), ("ok", "stale"), ("old", "stale"), ("rds", "unreadable")]
    assert verify_contract(spark, landed).where("id = 'ok'").count() == 0
    details = {r["detail"] for r in issues.collect()}
    assert "Missing required columns: w" in details and "Row count 3 is below minimum 5." in details
    assert "Duplicate rows found for key columns: k" in details


def test_read_required_dataset(spark, landed):
    assert read_required_dataset(spark, landed, "ok").count() == 1
    with pytest.raises(ContractError, match="missing required columns: w"):
        read_required_dataset(spark, landed, "dup")
    with pytest.raises(ContractError, match="is missing at"):
        read_required_dataset(spark, landed, "gone")
    with pytest.raises(KeyError, match="not declared"):
        read_required_dataset(spark, landed, "nope")


def test_corrupt_file_is_unreadable(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not a parquet file at all")
    doc = {"required_datasets": [{"id": "bad", "output_path": "bad", "format": "parquet",
                                  "validation_rules": {"row_count_min": 1}}]}
    got = verify_contract(spark, Contract.from_json(json.dumps(doc), root=str(tmp_path))).collect()
    assert [(r["id"], r["type"]) for r in got] == [("bad", "unreadable")]
    with pytest.raises(ContractError, match="Failed to read required dataset 'bad'"):
        read_required_dataset(spark, Contract.from_json(json.dumps(doc), root=str(tmp_path)), "bad")
