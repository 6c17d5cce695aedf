"""Run and version tables on storage."""

from pathlib import Path

import pytest

from marea.operators import registry


def files(root, part):
    return {p.name: p.stat().st_mtime_ns for p in Path(root, part).glob("*.parquet")}


def test_runs_are_appended_and_repeats_change_nothing(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert registry.stored_runs(spark, root).count() == 0
    row = lambda e, i, auc: registry.run_row(spark, e, i, "logistic_1", {"C": "1"}, {"auc": auc}, {"env": "dev"}, "FINISHED")
    for run in (row("churn", "a", 0.5), row("churn", "b", 0.9), row("other", "a", 0.1), row("churn", "a", 0.7), row("churn", "b", 0.9)):
        registry.log_runs(run, root)
    rows = {(r["experiment"], r["run_id"]): r["metrics"]["auc"] for r in registry.stored_runs(spark, root).collect()}
    assert rows == {("churn", "a"): 0.7, ("churn", "b"): 0.9, ("other", "a"): 0.1}
    assert registry.stored_runs(spark, root).count() == 3
    assert registry.find_champion(registry.stored_runs(spark, root), "churn")["run_id"] == "b"


def test_a_tag_change_leaves_other_names_alone(spark, tmp_path):
    root = str(tmp_path / "versions")
    versions = spark.createDataFrame([(n, v, None, {"env": "dev"} if v == "1" else None) for n in ("a b/c", "m") for v in ("1", "2", "10")],
                                     registry.VERSION_SCHEMA)
    registry.save_versions(versions, root)
    before = files(root, "name=m")
    target = spark.createDataFrame([("a b/c", "10"), ("a b/c", "1"), ("none", "1")], "name string, version string")
    for _ in range(2):
        registry.set_tags(spark, root, target, {"env": "prod"})
    assert files(root, "name=m") == before and before
    tags = {(r["name"], r["version"]): r["tags"] for r in registry.stored_versions(spark, root).collect()}
    assert tags == {("a b/c", "1"): {"env": "prod"}, ("a b/c", "2"): None, ("a b/c", "10"): {"env": "prod"},
                    ("m", "1"): {"env": "dev"}, ("m", "2"): None, ("m", "10"): None}
    with pytest.raises(ValueError, match="name"):
        registry.save_versions(spark.createDataFrame([(None, "1", None, None)], registry.VERSION_SCHEMA), root)
