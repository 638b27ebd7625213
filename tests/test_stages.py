"""Split, features and scorers in one pipeline, saved and loaded."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from cardsentry.sources.tables import transactions
from cardsentry.stages import FeatureEngineer, RiskScorer, TimeSplitter


@pytest.mark.parametrize("network", [False, True])
def test_pipeline_is_saved_and_loaded(spark, sf_dir, tmp_path, network):
    df = transactions(spark, sf_dir)
    scorer = RiskScorer(network=network, trees=10, maxSamples=0.5, rounds=4, epochs=2)
    pipeline = Pipeline(stages=[TimeSplitter(trainShare=0.6), FeatureEngineer(), scorer])
    pipeline.write().overwrite().save(str(tmp_path / "plan"))
    again = Pipeline.load(str(tmp_path / "plan"))
    assert again.getStages()[0].getOrDefault("trainShare") == 0.6
    assert [s.uid for s in again.getStages()] == [s.uid for s in pipeline.getStages()]

    model = pipeline.fit(df)
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    got, want = loaded.transform(df), model.transform(df)
    assert got.columns == want.columns and got.count() == 1000
    assert got.exceptAll(want).count() == 0
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": 600, "val": 150, "test": 250}
    assert all(0 <= r["fraud_score"] <= 1 for r in got.collect())
