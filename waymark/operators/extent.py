"""Closest and farthest pair of points on the sphere without all pairs.

Points are unit vectors, so a chord orders pairs as the great circle does.

Closest pair: the finest grid that still holds two points in one cell is found
by bisection over the cell size (one count per step). In the grid one step
coarser no cell holds more than 64 points, since at the next finer size every
cell holds one, and the closest pair lies in one cell or in neighbouring ones.

Farthest pair: cells are paired, and a pair of cells is kept while the upper
bound of its distances (between the cells' centres, plus their radii) is not
below the greatest distance known; kept cells are cut finer until few points
are left in them, and only their points meet.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import EARTH_RADIUS_KM, MAX_DISTANCE_KM, haversine_km
from waymark.sources.staging import stage_table

#: Halvings of the cube around the sphere: cells down to 2^-40 of its radius (some micrometres).
FINEST = 41
#: Cells that are paired at once in the search for the farthest pair.
FIRST_LEVEL = 3
#: Points of two cells meet once their cells hold about so many.
FEW_POINTS = 64


def _vectors(points: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct places: ``lat, lon``, unit vector ``x, y, z`` and how many
    points share the place (to the radian)."""
    p, l = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    rows = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy((p + 0.0).alias("p"), (l + 0.0).alias("l")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col(lat).cast("double")).alias("lat"), F.min(F.col(lon).cast("double")).alias("lon"))
    return rows.select("lat", "lon", "n", (F.cos("p") * F.cos("l")).alias("x"), (F.cos("p") * F.sin("l")).alias("y"),
                       F.sin("p").alias("z"))


def _cell(level: int, *axes: str) -> list[Column]:
    """Grid cell of a point: 2^level cells along each unit."""
    return [F.floor((F.col(a) + 1.0) * float(2 ** level)).cast("bigint").alias(f"c{a}") for a in axes]


def _shared(places: DataFrame, level: int) -> bool:
    cells = places.groupBy(*_cell(level, "x", "y", "z")).agg(F.count(F.lit(1)).alias("m"))
    return bool(cells.where("m > 1").take(1))


def closest_km(places: DataFrame, radius_km: float = EARTH_RADIUS_KM) -> float | None:
    """Least distance of two different places; None for fewer than two."""
    if len(places.take(2)) < 2:
        return None
    # Level -1: the whole cube is one cell per axis pair of halves.
    low, high = -1, FINEST
    while high - low > 1:
        middle = (low + high) // 2
        if _shared(places, middle):
            low = middle
        else:
            high = middle
    # Two points in one cell of this level are at most 1.74 cells apart.
    level = low - 1
    here = stage_table(places.select(F.monotonically_increasing_id().alias("no"), "lat", "lon",
                                     *_cell(level, "x", "y", "z")), "extent-cells")
    around = F.array(*[F.struct(*[(F.col(f"c{a}") + d).alias(f"c{a}") for a, d in zip("xyz", step, strict=True)])
                       for step in itertools.product((-1, 0, 1), repeat=3)])
    near = here.select(F.col("no").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"),
                       F.explode(around).alias("c")).select("other", "lat2", "lon2", "c.*")
    pairs = here.join(near, ["cx", "cy", "cz"]).where(F.col("no") < F.col("other"))
    return pairs.agg(F.min(haversine_km("lat", "lon", "lat2", "lon2", radius_km))).first()[0]


def _summaries(places: DataFrame, level: int) -> DataFrame:
    """Per cell: its numbers, points, and one of its points."""
    cells = _cell(level, "x", "y", "z")
    one = F.min(F.struct("lat", "lon", "x", "y", "z"))
    return places.groupBy(*cells).agg(F.count(F.lit(1)).alias("m"), one.alias("one")).select("cx", "cy", "cz", "m", "one.*")


def farthest_km(places: DataFrame, radius_km: float = EARTH_RADIUS_KM) -> float | None:
    """Greatest distance of two different places; None for fewer than two."""
    if len(places.take(2)) < 2:
        return None
    kept = None
    level = FIRST_LEVEL
    while True:
        cells = stage_table(_summaries(places, level), "extent-level")
        a, b = (cells.select(F.struct("cx", "cy", "cz").alias(f"cell_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in
                             ("m", "lat", "lon", "x", "y", "z")]) for s in "ab")
        if kept is None:
            # At most 17^3 cells of the cube, some hundreds of them on the sphere.
            pairs = a.join(F.broadcast(b), F.col("cell_a") <= F.col("cell_b"))
        else:
            up = lambda c: F.struct(*[F.floor(F.col(c)[f"c{x}"] / 2).cast("bigint").alias(f"c{x}") for x in "xyz"])
            pairs = (kept.join(a.withColumn("up_a", up("cell_a")), "up_a").join(b.withColumn("up_b", up("cell_b")), "up_b")
                         .where((F.col("up_a") != F.col("up_b")) | (F.col("cell_a") <= F.col("cell_b"))))
        chord = F.sqrt(sum((F.col(f"{x}_a") - F.col(f"{x}_b")) ** 2 for x in "xyz"))
        # Any point is within a cell's diagonal of the cell's one point.
        bound = chord + F.lit(2 * 3 ** 0.5 / 2 ** level + 1e-9)
        judged = stage_table(pairs.select("cell_a", "cell_b", "m_a", "m_b", chord.alias("chord"), bound.alias("bound")), "extent-pairs")
        best = judged.agg(F.max("chord")).first()[0]
        left = judged.where(F.col("bound") >= best)
        work, cells_left = left.agg(F.sum(F.col("m_a") * F.col("m_b")), F.count(F.lit(1))).first()
        if work <= FEW_POINTS * max(cells_left, FEW_POINTS) or level >= FINEST:
            break
        kept = stage_table(left.select(F.col("cell_a").alias("up_a"), F.col("cell_b").alias("up_b")), "extent-kept")
        level += 1
    spots = places.select(F.struct(*_cell(level, "x", "y", "z")).alias("cell"), "lat", "lon")
    pairs = (left.select("cell_a", "cell_b")
                 .join(spots.select(F.col("cell").alias("cell_a"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1")), "cell_a")
                 .join(spots.select(F.col("cell").alias("cell_b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), "cell_b"))
    return pairs.agg(F.max(haversine_km("lat1", "lon1", "lat2", "lon2", radius_km))).first()[0]


def distance_extent(points: DataFrame, lat: str = "latitude", lon: str = "longitude",
                    max_km: float = MAX_DISTANCE_KM, radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """Sanity summary of the great-circle distances of all unordered pairs of
    points, from the points alone: ``min_km, max_km, n_pairs,
    n_out_of_bounds`` (pairs at no distance, or at ``max_km`` and beyond). One
    row; without a pair the distances are null. Points without a coordinate are
    left out."""
    places = stage_table(_vectors(points, lat, lon), "extent-places")
    n, same = places.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
    n, same = n or 0, int(same or 0)
    least, most = closest_km(places, radius_km), farthest_km(places, radius_km)
    if same:
        least, most = 0.0, most if most is not None else 0.0
    if most is not None and most >= max_km:
        raise ValueError(f"{most} km is not below the bound of {max_km} km: the radius and the bound do not fit")
    return points.sparkSession.createDataFrame([(least, most, n * (n - 1) // 2, same)],
                                               "min_km double, max_km double, n_pairs bigint, n_out_of_bounds bigint")
