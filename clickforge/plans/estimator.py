"""Boosted trees as an MLlib ``Estimator`` so that they fit into pipelines and tuning."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.functions import predicted_class, sigmoid
from clickforge.operators.booster import BoostOptions, fit_boosted_grid, fit_boosted_trees
from clickforge.operators.trees import (
    TreeEnsemble,
    feature_importance,
    margin_from_leaves,
    softmax,
    tree_leaf,
)


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    numRound = Param(Params._dummy(), "numRound", "boosting rounds", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    eta = Param(Params._dummy(), "eta", "step size", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf weights", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "L1 penalty of leaf weights", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a child", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "row share per round", TypeConverters.toFloat)
    colsampleByTree = Param(Params._dummy(), "colsampleByTree", "feature share per round", TypeConverters.toFloat)
    scalePosWeight = Param(Params._dummy(), "scalePosWeight", "weight of positives", TypeConverters.toFloat)
    numClass = Param(Params._dummy(), "numClass", "classes; 1 for binary", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "cut points per feature", TypeConverters.toInt)
    missing = Param(Params._dummy(), "missing", "value that stands for an absent feature; none when not set", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the samples", TypeConverters.toInt)
    splitCol = Param(Params._dummy(), "splitCol", "column naming the training rows 'train'", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique key of the row sample", TypeConverters.toString)
    leafCol = Param(Params._dummy(), "leafCol", "output column of leaf ids", TypeConverters.toString)

    def options(self) -> BoostOptions:
        get = self.getOrDefault
        return BoostOptions(
            num_round=get(self.numRound), max_depth=get(self.maxDepth), eta=get(self.eta),
            reg_lambda=get(self.regLambda), alpha=get(self.alpha), gamma=get(self.gamma),
            min_child_weight=get(self.minChildWeight), subsample=get(self.subsample),
            colsample_bytree=get(self.colsampleByTree), scale_pos_weight=get(self.scalePosWeight),
            num_class=get(self.numClass), max_bins=get(self.maxBins), seed=get(self.seed),
            missing=get(self.missing) if self.isDefined(self.missing) else None,
        )

    def _set_boost_defaults(self) -> None:
        self._setDefault(
            numRound=100, maxDepth=8, eta=0.1, regLambda=1.0, alpha=0.0, gamma=0.2, minChildWeight=2.0,
            subsample=0.8, colsampleByTree=0.8, scalePosWeight=1.0, numClass=1, maxBins=256, seed=123,
            splitCol="", idCol="", leafCol="",
        )


class BoostedTreesClassifier(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator over :func:`fit_boosted_trees`."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set_boost_defaults()
        self._set(**self._input_kwargs)

    def setParams(self, **kwargs) -> BoostedTreesClassifier:
        return self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        split = self.getOrDefault(self.splitCol) or None
        row_id = self.getOrDefault(self.idCol) or None
        fitted = fit_boosted_trees(dataset, self.getFeaturesCol(), self.getLabelCol(), self.options(), split=split, row_id=row_id)
        return self._copyValues(BoostedTreesModel(fitted.model))


    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, BoostedTreesModel]]:
        """Models for all param maps; those that agree on columns grow together, in the same passes over one binned table."""
        estimators = [self.copy(m) for m in paramMaps]
        columns = [(e.getFeaturesCol(), e.getLabelCol(), e.getOrDefault(e.splitCol), e.getOrDefault(e.idCol)) for e in estimators]

        def fitted() -> Iterator[tuple[int, BoostedTreesModel]]:
            for same in dict.fromkeys(columns):
                mine = [i for i, c in enumerate(columns) if c == same]
                features, label, split, row_id = same
                results = fit_boosted_grid(dataset, features, label, [estimators[i].options() for i in mine], split=split or None, row_id=row_id or None)
                for i, result in zip(mine, results):
                    yield i, estimators[i]._copyValues(BoostedTreesModel(result.model))

        return _OneAtATime(fitted())


class _OneAtATime:
    """An iterator that several threads may ask."""

    def __init__(self, source: Iterator):
        self.source, self.lock = source, threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            return next(self.source)


class BoostedTreesModel(Model, _BoostParams, MLReadable, MLWritable):
    """Appends raw prediction, probability, prediction and, when asked for, leaf ids."""

    def __init__(self, ensemble: TreeEnsemble | None = None):
        super().__init__()
        self._set_boost_defaults()
        self.ensemble = ensemble

    def _transform(self, dataset: DataFrame) -> DataFrame:
        wanted = self.getOrDefault(self.leafCol)
        leaves = wanted or "__leaves"
        df = tree_leaf(dataset, self.ensemble, self.getFeaturesCol(), leaves)
        df = margin_from_leaves(df, self.ensemble, leaves, "__margin")
        if self.ensemble.num_class == 1:
            margin, p = F.col("__margin"), sigmoid(F.col("__margin"))
            raw, probability = F.array(-margin, margin), F.array(1 - p, p)
            prediction = predicted_class(p)
        else:
            raw, probability = F.col("__margin"), softmax("__margin")
            prediction = (F.array_position(raw, F.array_max(raw)) - 1).cast("double")
        df = df.withColumns({
            self.getRawPredictionCol(): array_to_vector(raw),
            self.getProbabilityCol(): array_to_vector(probability),
            self.getPredictionCol(): prediction,
        })
        return df.drop("__margin", *([] if wanted else ["__leaves"]))

    def importance(self, spark, kind: str = "weight") -> DataFrame:
        return feature_importance(self.ensemble.to_df(spark), kind)

    def write(self) -> MLWriter:
        return _BoostedTreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoostedTreesReader(cls)

    def copy(self, extra=None) -> BoostedTreesModel:
        that = super().copy(extra)
        that.ensemble = self.ensemble
        return that


class _BoostedTreesWriter(MLWriter):
    def __init__(self, instance: BoostedTreesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.ensemble.save(self.sparkSession, f"{path}/trees")


class _BoostedTreesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedTreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(TreeEnsemble.load(self.sparkSession, f"{path}/trees"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
