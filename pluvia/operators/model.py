"""Linear regression over feature frames with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.schemas import ACTUAL, PREDICTED


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """One vector column from the feature columns. Rows with a null or NaN feature are skipped."""
    return VectorAssembler(inputCols=[c for c in features if c != "label"], outputCol=output, handleInvalid="skip").transform(df)


def vector_columns(df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """The elements of a vector column as plain columns."""
    array = vector_to_array(vector)
    return df.select(*[c for c in df.columns if c != vector], *[array[i].alias(n) for i, n in enumerate(names)])


def fit(df: DataFrame, features: str = "features", label: str = "label") -> LinearRegressionModel:
    """Least squares with intercept. Up to 4096 features this is one distributed pass over the rows."""
    return LinearRegression(featuresCol=features, labelCol=label).fit(df)


def is_direct(model: LinearRegressionModel) -> bool:
    """Whether the model comes from the normal equations as they are. Where inputs depend on each other Spark turns to an
    iterative solver, without a word, and its answer is one of many."""
    return model.summary.totalIterations == 0


def coefficients(model: LinearRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(term, coefficient), one row per feature and one for the intercept."""
    terms = [*zip(features, (float(c) for c in model.coefficients), strict=True), ("intercept", float(model.intercept))]
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType())])
    return df.sparkSession.createDataFrame(terms, schema)


def score(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def refined(scored: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The output shape: keys, features, the actual next value and the predicted one."""
    return scored.select(*keys, *features, F.col("label").alias(ACTUAL), F.col("prediction").alias(PREDICTED))
