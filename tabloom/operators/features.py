"""Feature vectors: assembly, scaling to unit deviation, and the regression on top of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNSCALED = "unscaled_features"
SCALED = "features"


def to_label(
    df: DataFrame, target: str, features: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """The target as ``label``, then the features; ``keys`` are carried along in front."""
    return df.select(*keys, F.col(target).alias("label"), *features)


def assembler(cols: Sequence[str], out: str = UNSCALED) -> VectorAssembler:
    """Numeric columns to one vector; a null raises when the rows are read."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error")


def scaler(col: str = UNSCALED, out: str = SCALED) -> StandardScaler:
    """Divide by the sample standard deviation of all rows, without centring.

    A constant column becomes 0.
    """
    return StandardScaler(inputCol=col, outputCol=out, withStd=True, withMean=False)


def feature_pipeline(cols: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[assembler(cols), scaler()])


def feature_frames(
    train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str]
) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit the feature pipeline on ``train`` alone and apply it to ``train`` and the others."""
    model = feature_pipeline(cols).fit(train)
    kept = [c for c in train.columns if c not in cols]
    return model, [model.transform(df).select(*kept, SCALED) for df in (train, *others)]


def scaled_regression(
    df: DataFrame,
    cols: Sequence[str],
    max_iter: int = 10,
    reg_param: float = 0.01,
    solver: str = "auto",
) -> tuple[PipelineModel, DataFrame]:
    """Linear regression of ``label`` on scaled features; the model and the rows with predictions."""
    regression = LinearRegression(maxIter=max_iter, regParam=reg_param, solver=solver)
    model = Pipeline(stages=[assembler(cols), scaler(), regression]).fit(df)
    return model, model.transform(df)

