"""Split, features and scorers as estimators and models of ``pyspark.ml``: they run in a ``Pipeline``, and a fitted pipeline
is saved and loaded as a whole.

    pipeline = Pipeline(stages=[TimeSplitter(), FeatureEngineer(), RiskScorer(network=False)])
    pipeline.fit(transactions).write().save(path)
    PipelineModel.load(path).transform(transactions)
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsReadable,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.models.boosted import ROUNDS, BoostedTrees
from cardsentry.models.forest import MAX_SAMPLES, TREES, IsolationForest
from cardsentry.models.reconstruction import EPOCHS, LinearReconstruction, NetworkReconstruction
from cardsentry.operators.features import FeatureStore, feature_names
from cardsentry.operators.scoring import SCORES, Ensemble
from cardsentry.operators.split import TRAIN_SHARE, VALIDATION_SHARE, TimeSplit
from cardsentry.schema import LABEL, ROW_ID, TIME
from cardsentry.session import materialise
from cardsentry.sources.state import (
    load_ensemble,
    load_feature_store,
    load_scalars,
    save_ensemble,
    save_feature_store,
    save_scalars,
)

SPLIT = "split"


class _Fitted(Model, MLWritable, MLReadable):
    """A model whose state is saved as tables beside its parameters."""

    def save_state(self, spark: SparkSession, path: str) -> None:
        raise NotImplementedError

    def load_state(self, spark: SparkSession, path: str) -> None:
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: _Fitted) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.save_state(self.sparkSession, f"{path}/state")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.load_state(self.sparkSession, f"{path}/state")
        return model


class TimeSplitter(Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Learns the two times that cut the rows into train, val and test."""

    trainShare = Param(Params._dummy(), "trainShare", "share of the rows to train on", TypeConverters.toFloat)
    valShare = Param(Params._dummy(), "valShare", "share of the rows to validate on", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, trainShare: float = TRAIN_SHARE, valShare: float = VALIDATION_SHARE) -> None:
        super().__init__()
        self._setDefault(trainShare=TRAIN_SHARE, valShare=VALIDATION_SHARE)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TimeSplitModel:
        return TimeSplitModel(TimeSplit.fit(dataset, self.getOrDefault("trainShare"), self.getOrDefault("valShare")))


class TimeSplitModel(_Fitted):
    def __init__(self, split: TimeSplit | None = None) -> None:
        super().__init__()
        self.split = split

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.split.label(dataset)

    def save_state(self, spark: SparkSession, path: str) -> None:
        save_scalars(spark, self.split.__dict__, path)

    def load_state(self, spark: SparkSession, path: str) -> None:
        self.split = TimeSplit(**load_scalars(spark, path))


class _HasVelocity(Params):
    velocity = Param(Params._dummy(), "velocity", "stateful, stateless or present", TypeConverters.toString)


class FeatureEngineer(_HasVelocity, Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Fits the feature store, to the rows of the train part where there is a column ``split``."""

    category = Param(Params._dummy(), "category", "column of the merchant category", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, velocity: str = "stateful", category: str = "category") -> None:
        super().__init__()
        self._setDefault(velocity="stateful", category="category")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FeatureModel:
        rows = dataset.where(F.col(SPLIT) == "train").drop(SPLIT) if SPLIT in dataset.columns else dataset
        return FeatureModel(FeatureStore.fit(rows, self.getOrDefault("category")))._set(velocity=self.getOrDefault("velocity"))


class FeatureModel(_HasVelocity, _Fitted):
    """Transactions to the feature matrix, with the id, the label, the time and the part of every row."""

    def __init__(self, store: FeatureStore | None = None) -> None:
        super().__init__()
        self._setDefault(velocity="stateful")
        self.store = store

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.store.transform(dataset, self.getOrDefault("velocity"), keep=(ROW_ID, LABEL, TIME, SPLIT))

    def save_state(self, spark: SparkSession, path: str) -> None:
        save_feature_store(self.store, spark, path)

    def load_state(self, spark: SparkSession, path: str) -> None:
        self.store = load_feature_store(spark, path)


class RiskScorer(Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Fits the three scorers to the train part of a feature matrix, and the blend and the number of trees to its val part."""

    network = Param(Params._dummy(), "network", "reconstruct by the network, not by components", TypeConverters.toBoolean)
    trees = Param(Params._dummy(), "trees", "trees of the forest", TypeConverters.toInt)
    maxSamples = Param(Params._dummy(), "maxSamples", "share of the normal rows per tree of the forest", TypeConverters.toFloat)
    rounds = Param(Params._dummy(), "rounds", "boosted trees at most", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "epochs of the network at most", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, network: bool = True, trees: int = TREES, maxSamples: float = MAX_SAMPLES, rounds: int = ROUNDS, epochs: int = EPOCHS
    ) -> None:
        super().__init__()
        self._setDefault(network=True, trees=TREES, maxSamples=MAX_SAMPLES, rounds=ROUNDS, epochs=EPOCHS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RiskModel:
        get, names = self.getOrDefault, feature_names(dataset.columns)
        stored = materialise(dataset.select(ROW_ID, LABEL, TIME, SPLIT, *names))  # read many times below
        train, val = stored.where(F.col(SPLIT) == "train"), stored.where(F.col(SPLIT) == "val")
        forest = IsolationForest.fit(train, names, trees=get("trees"), max_samples=get("maxSamples"))
        if get("network"):
            reconstruction = NetworkReconstruction.fit(train, names, order=TIME, epochs=get("epochs"))
        else:
            reconstruction = LinearReconstruction.fit(train, names)
        model = RiskModel(forest, reconstruction, BoostedTrees.fit(train, names, val, rounds=get("rounds")), Ensemble())
        model.ensemble = Ensemble().fit(materialise(model.scores(val).select(ROW_ID, LABEL, *SCORES)))
        return model


class RiskModel(_Fitted):
    """A feature matrix to the three scores, the blended score, tier and alert of every row."""

    def __init__(self, forest=None, reconstruction=None, boosted=None, ensemble=None) -> None:
        super().__init__()
        self.forest, self.reconstruction, self.boosted, self.ensemble = forest, reconstruction, boosted, ensemble

    def scores(self, matrix: DataFrame) -> DataFrame:
        return self.boosted.score(self.reconstruction.score(self.forest.score(matrix)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in (ROW_ID, LABEL, TIME, SPLIT) if c in dataset.columns]
        return self.ensemble.score(self.scores(dataset)).select(*kept, "fraud_score", "risk_tier", *SCORES, "should_alert")

    def save_state(self, spark: SparkSession, path: str) -> None:
        save_scalars(spark, {"network": isinstance(self.reconstruction, NetworkReconstruction)}, f"{path}/kind")
        self.forest.save(spark, f"{path}/forest")
        self.reconstruction.save(spark, f"{path}/reconstruction")
        self.boosted.save(spark, f"{path}/boosted")
        save_ensemble(self.ensemble, spark, f"{path}/ensemble")

    def load_state(self, spark: SparkSession, path: str) -> None:
        kind = NetworkReconstruction if load_scalars(spark, f"{path}/kind")["network"] else LinearReconstruction
        self.forest = IsolationForest.load(spark, f"{path}/forest")
        self.reconstruction = kind.load(spark, f"{path}/reconstruction")
        self.boosted = BoostedTrees.load(spark, f"{path}/boosted")
        self.ensemble = load_ensemble(spark, f"{path}/ensemble")
