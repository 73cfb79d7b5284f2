"""Queries: error analytics over scored bags, grouping, coordinate scaling
(A5, A7, C7, C9, C11, E1, E2, E4, E5, E6, E7, E9, E11, G1, I7, I8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions.geo import EARTH_RADIUS_UTILITY_KM
from waymark.operators import metrics as M
from waymark.operators import split as S
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.q_bags import SEED, _bags, _rounded, _split_sql, bags_sql
from waymark.plans.registry import r6, register
from waymark.session import scratch_path
from waymark.sources.tables import read_bags, stage_table, write_table

COORDS = ["latitude", "longitude", "predicted_latitude", "predicted_longitude"]


def scored_df(spark, d, with_initial=False):
    """Scored bags: arithmetic predictions, error in km, group split."""
    s = fx.scored(spark, d, with_initial)
    return S.split(M.with_error_km(s), "intersection", test_size=0.2, seed=SEED)


def scored_sql(with_initial=False) -> tuple:
    err = q.haversine("predicted_latitude", "predicted_longitude", "latitude", "longitude")
    return (X.scored(with_initial),
            "ssplit AS (" + _split_sql("SELECT DISTINCT intersection FROM scored_raw", "intersection") + ")",
            f"""scored AS (
  SELECT s.*, {err} AS error_km, p.split
  FROM scored_raw s JOIN ssplit p ON s.intersection = p.intersection)""")


_IE_SQL = f"""ie AS (
  SELECT split, intersection, avg(predicted_latitude) AS pred_lat, avg(predicted_longitude) AS pred_lon,
         min(latitude) AS true_lat, min(longitude) AS true_lon, count(*) AS n_bags
  FROM scored GROUP BY split, intersection),
ie_err AS (SELECT *, {q.haversine('pred_lat', 'pred_lon', 'true_lat', 'true_lon')} AS error_km FROM ie)"""


@register("scored_bags", X.with_ctes(*scored_sql(), body="""
SELECT intersection, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
       round(predicted_latitude, 6) AS predicted_latitude, round(predicted_longitude, 6) AS predicted_longitude,
       round(error_km, 6) AS error_km, split
FROM scored"""))
def q_scored_bags(spark, d):
    s = scored_df(spark, d)
    return s.select("intersection", *[r6(c) for c in COORDS], r6("error_km"), "split")


@register("error_summary", X.with_ctes(*scored_sql(), _IE_SQL, body="""
SELECT scope, level, count(*) AS n, round(avg(err), 6) AS mean_km,
       round(quantile_cont(err, 0.5), 6) AS median_km, round(quantile_cont(err, 0.9), 6) AS p90_km
FROM (SELECT split AS scope, 'bag' AS level, error_km AS err FROM scored
      UNION ALL SELECT 'all', 'bag', error_km FROM scored
      UNION ALL SELECT split, 'intersection', error_km FROM ie_err)
GROUP BY scope, level"""))
def q_error_summary(spark, d):
    out = M.error_summary(stage_table(scored_df(spark, d), "scored-bags"))
    return out.select("scope", "level", "n", r6("mean_km"), r6("median_km"), r6("p90_km"))


@register("intersection_errors", X.with_ctes(*scored_sql(), _IE_SQL, body="""
SELECT split, intersection, round(pred_lat, 6) AS pred_lat, round(pred_lon, 6) AS pred_lon,
       round(true_lat, 6) AS true_lat, round(true_lon, 6) AS true_lon, n_bags, round(error_km, 6) AS error_km
FROM ie_err"""))
def q_intersection_errors(spark, d):
    ie = M.intersection_errors(scored_df(spark, d))
    return ie.select("split", "intersection", *[r6(c) for c in ["pred_lat", "pred_lon", "true_lat", "true_lon"]],
                     "n_bags", r6("error_km"))


@register("intersection_error_summary", X.with_ctes(*scored_sql(), _IE_SQL, body="""
SELECT split, count(*) AS n, round(avg(error_km), 6) AS mean_km,
       round(quantile_cont(error_km, 0.5), 6) AS median_km, round(quantile_cont(error_km, 0.9), 6) AS p90_km
FROM ie_err GROUP BY split"""))
def q_intersection_error_summary(spark, d):
    ie = stage_table(M.intersection_errors(scored_df(spark, d)), "intersection-errors")
    stats = ie.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("error_km").alias("mean_km"))
    qs = M.quantiles(ie, "error_km", ["split"], [0.5, 0.9])
    return stats.join(qs, "split").select("split", "n", r6("mean_km"), r6("q50", "median_km"),
                                          r6("q90", "p90_km"))


@register("split_group_counts", X.with_ctes(*scored_sql(), body="""
SELECT split, count(DISTINCT intersection) AS n_groups FROM scored GROUP BY split"""))
def q_split_group_counts(spark, d):
    return M.split_group_counts(scored_df(spark, d))


@register("axis_bounds", X.with_ctes(X.scored(True), body="""
SELECT 'latitude' AS axis,
       round(least(min(latitude), min(predicted_latitude), min(initial_predicted_latitude)), 6) AS lower,
       round(greatest(max(latitude), max(predicted_latitude), max(initial_predicted_latitude)), 6) AS upper
FROM scored_raw
UNION ALL
SELECT 'longitude',
       round(least(min(longitude), min(predicted_longitude), min(initial_predicted_longitude)), 6),
       round(greatest(max(longitude), max(predicted_longitude), max(initial_predicted_longitude)), 6)
FROM scored_raw"""))
def q_axis_bounds(spark, d):
    return M.axis_bounds(fx.scored(spark, d, True)).select("axis", r6("lower"), r6("upper"))


@register("calibration_points", X.with_ctes(X.scored(True), body="""
SELECT 'latitude' AS axis, round(latitude, 6) AS actual, round(predicted_latitude, 6) AS predicted,
       round(initial_predicted_latitude, 6) AS initial FROM scored_raw
UNION ALL
SELECT 'longitude', round(longitude, 6), round(predicted_longitude, 6), round(initial_predicted_longitude, 6)
FROM scored_raw"""))
def q_calibration_points(spark, d):
    cp = M.calibration_points(fx.scored(spark, d, True))
    return cp.select("axis", r6("actual"), r6("predicted"), r6("initial"))


@register("error_segments", X.with_ctes(X.scored(), body="""
SELECT round(latitude, 6) AS from_lat, round(longitude, 6) AS from_lon,
       round(predicted_latitude, 6) AS to_lat, round(predicted_longitude, 6) AS to_lon,
       round((latitude + predicted_latitude) / 2, 6) AS mid_lat,
       round((longitude + predicted_longitude) / 2, 6) AS mid_lon
FROM scored_raw"""))
def q_error_segments(spark, d):
    seg = M.error_segments(fx.scored(spark, d))
    return seg.select(*[r6(c) for c in seg.columns])


@register("haversine", X.with_ctes(X.scored(), body=f"""
SELECT intersection, round({q.haversine('predicted_latitude', 'predicted_longitude', 'latitude', 'longitude')}, 6)
       AS error_km FROM scored_raw"""))
def q_haversine(spark, d):
    return M.with_error_km(fx.scored(spark, d)).select("intersection", r6("error_km"))


@register("haversine_r6371", X.with_ctes(X.scored(), body=f"""
SELECT intersection, round({q.haversine('predicted_latitude', 'predicted_longitude', 'latitude', 'longitude',
                                       EARTH_RADIUS_UTILITY_KM)}, 6) AS error_km FROM scored_raw"""))
def q_haversine_r6371(spark, d):
    return M.with_error_km(fx.scored(spark, d), EARTH_RADIUS_UTILITY_KM).select("intersection", r6("error_km"))


_STATS_SQL = """SELECT avg(latitude) AS lat_mean, avg(longitude) AS lon_mean,
       CASE WHEN stddev_pop(latitude) = 0 THEN 1.0 ELSE stddev_pop(latitude) END AS lat_std,
       CASE WHEN stddev_pop(longitude) = 0 THEN 1.0 ELSE stddev_pop(longitude) END AS lon_std
FROM scored_raw"""


@register("coord_stats", X.with_ctes(X.scored(), body=f"""
SELECT round(lat_mean, 6) AS lat_mean, round(lon_mean, 6) AS lon_mean, round(lat_std, 6) AS lat_std,
       round(lon_std, 6) AS lon_std FROM ({_STATS_SQL})"""))
def q_coord_stats(spark, d):
    st = M.coord_stats(fx.scored(spark, d))
    return st.select(*[r6(c) for c in st.columns])


@register("zscore_coords", X.with_ctes(X.scored(), f"st AS ({_STATS_SQL})", body="""
SELECT s.intersection, round((s.latitude - st.lat_mean) / st.lat_std, 6) AS z_lat,
       round((s.longitude - st.lon_mean) / st.lon_std, 6) AS z_lon
FROM scored_raw s CROSS JOIN st"""))
def q_zscore_coords(spark, d):
    s = fx.scored(spark, d)
    stats = M.fit_coord_stats(s)
    z = M.with_zscores(s, stats, {"z_lat": ("latitude", "lat"), "z_lon": ("longitude", "lon")})
    return z.select("intersection", r6("z_lat"), r6("z_lon"))


@register("denormalize", X.with_ctes(X.scored(), f"st AS ({_STATS_SQL})", body="""
SELECT s.intersection, round((length(s.intersection) - 4) / 8 * st.lat_std + st.lat_mean, 6) AS predicted_latitude,
       round((s.latitude - 39.5) * st.lon_std + st.lon_mean, 6) AS predicted_longitude
FROM scored_raw s CROSS JOIN st"""))
def q_denormalize(spark, d):
    """Given z-values (arithmetic on the rows) mapped back with the truth's
    statistics."""
    s = fx.scored(spark, d)
    stats = M.fit_coord_stats(s)
    z = s.withColumns({"zp_lat": (F.length("intersection") - 4) / 8, "zp_lon": F.col("latitude") - 39.5})
    back = M.with_denormalized(z, stats, {"predicted_latitude": ("zp_lat", "lat"),
                                          "predicted_longitude": ("zp_lon", "lon")})
    return back.select("intersection", r6("predicted_latitude"), r6("predicted_longitude"))


def _huber_sql_term(p, t):
    r = f"abs({p} - {t})"
    return f"(CASE WHEN {r} < 1.0 THEN 0.5 * {r} * {r} ELSE {r} - 0.5 END)"


@register("huber_loss", X.with_ctes(*scored_sql(), f"st AS ({_STATS_SQL})", body=f"""
SELECT split, count(*) AS n,
       round(avg(({_huber_sql_term('(s.predicted_latitude - st.lat_mean) / st.lat_std',
                                   '(s.latitude - st.lat_mean) / st.lat_std')}
                + {_huber_sql_term('(s.predicted_longitude - st.lon_mean) / st.lon_std',
                                   '(s.longitude - st.lon_mean) / st.lon_std')}) / 2), 6) AS loss
FROM scored s CROSS JOIN st GROUP BY split"""))
def q_huber_loss(spark, d):
    s = scored_df(spark, d)
    stats = M.fit_coord_stats(fx.scored(spark, d))
    z = M.with_zscores(s, stats, {"zl": ("latitude", "lat"), "zo": ("longitude", "lon"),
                                  "pl": ("predicted_latitude", "lat"), "po": ("predicted_longitude", "lon")})
    return M.huber_loss(z, ["pl", "po"], ["zl", "zo"], by=["split"]).select("split", "n", r6("loss"))


# ---------------------------------------------------------------- grouping of mixed frames

def _frames(spark, d):
    s = fx.signs(spark, d)
    a = s.where(F.col("src_order") % 2 == 0).select("intersection", "text_on_sign_exact", "src_line")
    b = s.where(F.col("src_order") % 2 == 1).select("text_on_sign_exact", "intersection",
                                                    F.col("code_type").alias("notes"), "src_order")
    return [a, b]


_FRAMES_SQL = f"""frames AS (
  SELECT intersection, {q.clean('text_on_sign_exact')} AS text_on_sign_exact, src_line,
         CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS BIGINT) AS src_order
  FROM signs WHERE src_order % 2 = 0
  UNION ALL
  SELECT intersection, {q.clean('text_on_sign_exact')}, CAST(NULL AS BIGINT), code_type, src_order
  FROM signs WHERE src_order % 2 = 1)"""


@register("group_and_clean", X.with_ctes(X.SIGNS, _FRAMES_SQL, body="SELECT * FROM frames"))
def q_group_and_clean(spark, d):
    """A frame and a CSV table in one union."""
    a, b = _frames(spark, d)
    path = write_table(b, scratch_path(spark, "frame-csv"), fmt="csv")
    out = M.group_and_clean([a, path], columns=["text_on_sign_exact"])
    return out.select("intersection", "text_on_sign_exact", "src_line", "notes", F.col("src_order").cast("bigint").alias("src_order"))


@register("group_count", X.with_ctes(X.SIGNS, _FRAMES_SQL, body="""
SELECT notes, count(*) AS count FROM frames GROUP BY notes"""))
def q_group_count(spark, d):
    return M.group_and_clean(_frames(spark, d), columns=["text_on_sign_exact"], group_by="notes")


@register("group_agg_map", X.with_ctes(X.SIGNS, _FRAMES_SQL, body="""
SELECT intersection, count(DISTINCT text_on_sign_exact) AS text_on_sign_exact, max(src_line) AS src_line,
       round(avg(src_order), 6) AS src_order
FROM frames GROUP BY intersection"""))
def q_group_agg_map(spark, d):
    out = M.group_and_clean(_frames(spark, d), columns=["text_on_sign_exact"], group_by=["intersection"],
                            agg={"text_on_sign_exact": "nunique", "src_line": "max", "src_order": "mean"})
    return out.select("intersection", "text_on_sign_exact", "src_line", r6("src_order"))


# ---------------------------------------------------------------- bag table sink and scan

@register("scan_bags", bags_sql(True))
def q_scan_bags(spark, d):
    """Bags written as header CSV (the table sink), then read back with the
    bag reader (drop incomplete rows, typed columns)."""
    path = write_table(_bags(spark, d, True), scratch_path(spark, "bags-csv"), fmt="csv")
    bags = read_bags(spark, path)
    return _rounded(bags.withColumns({"unique_sign_count": F.col("unique_sign_count").cast("bigint"),
                                      "raw_sign_count": F.col("raw_sign_count").cast("bigint")}))
