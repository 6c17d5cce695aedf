"""What the fits of ``run_log`` keep between their passes."""

import pytest

from marea.operators import models
from marea.plans import tabular_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def rows(spark):
    cells = [(n, float(n % 7), float(n * n % 11), int((n * n % 11 > 4) ^ (n % 5 == 0))) for n in range(300)]
    return spark.createDataFrame(cells, "id long, a double, b double, y int")


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(rows):
    classifier = models.forest(trees=8, depth=5)
    kept = classifier.build(300, "y")
    assert kept.getCacheNodeIds() and kept.getCheckpointInterval() == -1
    walked = models.Classifier("walked", lambda n, y: classifier.build(n, y).setCacheNodeIds(False))
    trees = [models.fit(c, rows.coalesce(1), ["a", "b"], "y").stages[-1] for c in (classifier, walked)]
    texts = [forest.toDebugString.split("\n", 1)[1] for forest in trees]      # after the line with the uid
    assert texts[0] == texts[1] and "If (feature" in texts[0]


def test_fits_read_written_rows(spark, monkeypatch):
    """The rows are joined with the cut of the split and encoded once, not in every pass."""
    seen, log = [], models.train_and_log

    def watched(classifier, train, test, *args):
        seen.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (train, test))
        return log(models.logistic(), train, test, *args)

    monkeypatch.setattr(models, "train_and_log", watched)
    assert tabular_queries.run_log(spark, SF_DIR).count() > 0
    assert len(seen) == 4
    for plan in seen:
        assert "Join" not in plan and "md5" not in plan
