"""Saved models: Spark's own layout (Parquet factors plus metadata)."""

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from palate.sources.paths import checked


def save_model(model: ALSModel, path: str) -> None:
    path = checked(path)
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(checked(path))


def save_restricted(model: ALSModel, path: str, item_ids: DataFrame) -> None:
    """Save a model that knows only the items in ``item_ids``, a frame with the column ``id``."""
    save_model(model, path)
    kept = model.itemFactors.join(item_ids.select("id"), "id", "left_semi")
    kept.write.mode("overwrite").parquet(f"{path}/itemFactors")


def save_without_factors(model: ALSModel, path: str) -> None:
    """Save a model of the same settings that knows no user and no item."""
    save_model(model, path)
    for side, factors in (("userFactors", model.userFactors), ("itemFactors", model.itemFactors)):
        factors.limit(0).write.mode("overwrite").parquet(f"{path}/{side}")
