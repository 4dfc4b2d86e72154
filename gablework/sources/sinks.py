"""Predictions and models out."""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame

from ..functions.columns import col


def write_predictions(df: DataFrame, path: str, key: str, prediction: str,
                      header: tuple[str, str] | None = None) -> None:
    """Key and prediction as CSV, one file per partition."""
    names = header or (key, prediction)
    (df.select(col(key).alias(names[0]), col(prediction).alias(names[1]))
       .write.mode("errorifexists").csv(path, header=True))


def save_model(model, path: str) -> None:
    model.save(path)


def load_model(path: str):
    """Any stage saved with ``save_model``, whatever its class."""
    from pyspark.sql import SparkSession

    context = SparkSession.active()
    metadata = DefaultParamsReader.loadMetadata(path, context)
    name = metadata["class"]
    if name.startswith("org.apache.spark"):
        name = name.replace("org.apache.spark", "pyspark")
    module, _, cls = name.rpartition(".")
    if module == "pyspark.ml":
        from pyspark import ml
        return getattr(ml, cls).load(path)
    from importlib import import_module
    return getattr(import_module(module), cls).load(path)
