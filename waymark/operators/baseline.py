"""Linear Huber baseline beside the regression head (I3): one robust linear
regression per coordinate, by Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_km


@dataclass
class LinearModel:
    """Intercept and coefficients per z-scored coordinate."""
    latitude: tuple[float, list[float]]
    longitude: tuple[float, list[float]]
    stats: dict

    def predict(self, vector: Column, axis: str) -> Column:
        """The de-normalised coordinate, as one native expression."""
        intercept, weights = getattr(self, axis)
        short = axis[:3]
        dot = F.aggregate(F.zip_with(vector, F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w),
                          F.lit(0.0), lambda s, x: s + x)
        return F.lit(self.stats[f"{short}_mean"]) + F.lit(self.stats[f"{short}_std"]) * (F.lit(intercept) + dot)


def fit_linear(train: DataFrame, feat: str, stats: dict, lat: str = "latitude", lon: str = "longitude",
               epsilon: float = 1.35, ridge: float = 1e-3, max_iter: int = 100) -> LinearModel:
    """Two fits with Huber loss on z-scored targets. Rows without a vector or a
    coordinate are left out; without any row the fit is an error."""
    rows = train.where(F.col(feat).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        array_to_vector(F.col(feat).cast("array<double>")).alias("features"),
        ((F.col(lat) - stats["lat_mean"]) / stats["lat_std"]).alias("latitude"),
        ((F.col(lon) - stats["lon_mean"]) / stats["lon_std"]).alias("longitude"))
    if not rows.take(1):
        raise ValueError("there is no training row")
    found = {}
    for axis in ("latitude", "longitude"):
        model = LinearRegression(featuresCol="features", labelCol=axis, loss="huber", epsilon=epsilon, regParam=ridge,
                                 maxIter=max_iter).fit(rows)
        found[axis] = (float(model.intercept), [float(w) for w in model.coefficients])
    return LinearModel(found["latitude"], found["longitude"], stats)


def with_linear(df: DataFrame, feat: str, model: LinearModel, prefix: str = "linear_") -> DataFrame:
    """Add ``<prefix>latitude`` and ``<prefix>longitude``."""
    return df.withColumns({f"{prefix}{axis}": model.predict(F.col(feat), axis) for axis in ("latitude", "longitude")})


def compare_errors(scored: DataFrame, stats: dict, prefixes=("predicted_", "linear_"), lat: str = "latitude",
                   lon: str = "longitude") -> DataFrame:
    """``split, model, n, mean_km``: the mean error of every prediction (by its
    column prefix) and of the mean predictor, in one aggregation."""
    errors = {p.rstrip("_"): haversine_km(f"{p}latitude", f"{p}longitude", lat, lon) for p in prefixes}
    errors["mean_predictor"] = haversine_km(F.lit(stats["lat_mean"]), F.lit(stats["lon_mean"]), lat, lon)
    means = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), *[F.avg(e).alias(m) for m, e in errors.items()])
    return means.unpivot(["split", "n"], list(errors), "model", "mean_km").select("split", "model", "n", "mean_km")
