"""Coordinate column functions: DMS parsing, great-circle and ellipsoidal
distances, z-scores, error segments. Native expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.text import WS

# Earth radii in km (mean radius used by training, evaluation and
# scoring; the rounder value used by the utility function), the WGS-84
# ellipsoid, and the distance bound used by the sanity check.
EARTH_RADIUS_KM = 6371.0088
EARTH_RADIUS_UTILITY_KM = 6371.0
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
MAX_DISTANCE_KM = 20037.5

# Fixed value: one degree-minute-second part, e.g. 39°44'24.7"N
# (whitespace as Python's regex class, see ``text.WS``).
DMS_PATTERN = f"(\\d+)°{WS}*(\\d+)'{WS}*([\\d.]+)\"{WS}*([NSEW])"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dms_to_decimal(degrees, minutes, seconds, direction) -> Column:
    """degrees + minutes/60 + seconds/3600, negative for S and W."""
    value = _col(degrees).cast("double") + _col(minutes).cast("double") / 60 \
        + _col(seconds).cast("double") / 3600
    return F.when(F.upper(_col(direction)).isin("S", "W"), -value).otherwise(value)


def dms_pair(c: str | Column, mode: str = "strict") -> Column:
    """Parse a string holding exactly two DMS parts, latitude first, into
    ``struct(latitude, longitude)``. Null input gives nulls. Anything else
    that does not hold exactly two parts, or whose seconds are not a number,
    raises in ``strict`` mode and gives nulls in ``permissive`` mode.

    One expression: the regex capture groups are computed once and bound to
    a lambda variable (a one-element ``transform``), which derives both
    coordinates from them. A filter on the result copies this one
    expression, not a chain of projections that would repeat the regexes.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    s = _col(c)
    groups = F.struct(*[F.regexp_extract_all(s, F.lit(DMS_PATTERN), F.lit(i)).alias(n)
                        for i, n in enumerate(["deg", "mins", "secs", "hemi"], start=1)])

    def parse(g):
        def part(i):
            return dms_to_decimal(F.try_element_at(g["deg"], F.lit(i)).cast("double"),
                                  F.try_element_at(g["mins"], F.lit(i)).cast("double"),
                                  _try_double(F.try_element_at(g["secs"], F.lit(i))),
                                  F.try_element_at(g["hemi"], F.lit(i)))
        lat, lon = part(1), part(2)
        ok = (F.size(g["deg"]) == 2) & lat.isNotNull() & lon.isNotNull()
        null = F.lit(None).cast("double")
        if mode == "strict":
            fail = F.raise_error(F.concat(F.lit("no coordinate pair in: "), s)).cast("double")
            lat = F.when(s.isNull(), null).when(ok, lat).otherwise(fail)
            lon = F.when(s.isNull(), null).when(ok, lon).otherwise(fail)
        else:
            lat, lon = F.when(ok, lat), F.when(ok, lon)
        return F.struct(lat.alias("latitude"), lon.alias("longitude"))

    return F.element_at(F.transform(F.array(groups), parse), 1)


def with_dms(df, column: str, lat_name: str = "latitude", lon_name: str = "longitude",
             mode: str = "strict"):
    """Add ``lat_name``/``lon_name`` parsed from ``column`` with
    :func:`dms_pair` (evaluated once per row)."""
    out = df.withColumn("_wm_ll", dms_pair(column, mode))
    return out.withColumns({lat_name: F.col("_wm_ll.latitude"),
                            lon_name: F.col("_wm_ll.longitude")}).drop("_wm_ll")


def _try_double(c: Column) -> Column:
    """String to double, null when it is not a number (e.g. ``1.2.3``)."""
    return F.when(c.rlike("^[0-9]*\\.?[0-9]*$") & c.rlike("[0-9]"), c.cast("double"))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance on a sphere. The square-root argument is clamped
    to 1 so rounding can never produce NaN."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dlat = p2 - p1
    dlon = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


_GEO_FIELDS = ["su1", "cu1", "su2", "cu2", "L", "lam", "ss", "cs", "sig", "sa", "c2a", "c2sm", "delta"]


def _geo_state(**vals) -> Column:
    return F.struct(*[vals[k].alias(k) for k in _GEO_FIELDS])


def _vincenty_phase(st: Column, phase: Column) -> Column:
    """One phase of a Vincenty iteration. Every value is read from a field
    of the state, so the expression stays linear in size (a lambda has no
    common-subexpression elimination):

    0: sin/cos of sigma from lambda; 1: sigma, sin alpha, cos^2 alpha,
    cos 2 sigma_m; 2: the next lambda and its change."""
    f = WGS84_F
    keep = {k: st[k] for k in _GEO_FIELDS}
    lam = st["lam"]
    p0 = dict(keep,
              ss=F.sqrt(F.pow(st["cu2"] * F.sin(lam), 2)
                        + F.pow(st["cu1"] * st["su2"] - st["su1"] * st["cu2"] * F.cos(lam), 2)),
              cs=st["su1"] * st["su2"] + st["cu1"] * st["cu2"] * F.cos(lam))
    sa = F.when(st["ss"] == 0, F.lit(0.0)).otherwise(st["cu1"] * st["cu2"] * F.sin(lam) / st["ss"])
    p1 = dict(keep, sig=F.atan2(st["ss"], st["cs"]), sa=sa,
              c2a=1 - sa * sa,
              c2sm=F.when(sa * sa == 1, F.lit(0.0))
                    .otherwise(st["cs"] - 2 * st["su1"] * st["su2"] / (1 - sa * sa)))
    c = f / 16 * st["c2a"] * (4 + f * (4 - 3 * st["c2a"]))
    new_lam = st["L"] + (1 - c) * f * st["sa"] * (
        st["sig"] + c * st["ss"] * (st["c2sm"] + c * st["cs"] * (-1 + 2 * st["c2sm"] * st["c2sm"])))
    p2 = dict(keep, lam=new_lam, delta=F.abs(new_lam - lam))
    # Once a round has moved lambda by at most 1e-12 the state is final and
    # the remaining steps only carry it along.
    return (F.when(st["delta"] <= F.lit(1e-12), st)
             .when(phase == 0, _geo_state(**p0))
             .when(phase == 1, _geo_state(**p1))
             .otherwise(_geo_state(**p2)))


def _bind(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once (a let in one expression)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _vincenty_km(c2a: Column, ss: Column, cs: Column, c2sm: Column, sig: Column) -> Column:
    """Length of the arc ``sig`` on the geodesic with this ``cos^2 alpha_0``."""
    a, b = WGS84_A_KM, WGS84_A_KM * (1 - WGS84_F)
    usq = c2a * (a * a - b * b) / (b * b)
    big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    d_sigma = big_b * ss * (c2sm + big_b / 4 * (
        cs * (-1 + 2 * c2sm * c2sm) - big_b / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm)))
    return F.lit(b) * big_a * (sig - d_sigma)


#: Halvings of the azimuth's interval: pi / 2^60 is below its rounding.
AZIMUTH_STEPS = 60


def _course(p: Column, azimuth: Column) -> Column:
    """The geodesic that leaves the first point at ``azimuth``, up to the
    second point's latitude: its spherical quantities and the difference of
    longitude it covers. ``p`` holds sine and cosine of both reduced latitudes
    with the first point the southern and farther from the equator."""
    turn = F.struct((F.sin(azimuth) * p["c1"]).alias("s0"), (F.cos(azimuth) * p["c1"]).alias("k1"))
    ends = lambda t: F.struct(
        t["s0"].alias("s0"), t["k1"].alias("k1"),
        F.sqrt(F.greatest(F.lit(0.0), t["k1"] * t["k1"] + (p["s1"] - p["s2"]) * (p["s1"] + p["s2"]))).alias("k2"))
    arcs = lambda t: F.struct(
        (1 - t["s0"] * t["s0"]).alias("c2a"), t["s0"].alias("s0"),
        F.atan2(p["s1"], t["k1"]).alias("sig1"), F.atan2(p["s2"], t["k2"]).alias("sig2"),
        (F.atan2(t["s0"] * p["s2"], t["k2"]) - F.atan2(t["s0"] * p["s1"], t["k1"])).alias("omega"))
    sums = lambda t: F.struct(
        t["c2a"].alias("c2a"), t["s0"].alias("s0"), t["omega"].alias("omega"), (t["sig2"] - t["sig1"]).alias("sig"),
        F.sin(t["sig2"] - t["sig1"]).alias("ss"), F.cos(t["sig2"] - t["sig1"]).alias("cs"),
        F.cos(t["sig1"] + t["sig2"]).alias("c2sm"),
        (WGS84_F / 16 * t["c2a"] * (4 + WGS84_F * (4 - 3 * t["c2a"]))).alias("c"))
    done = lambda t: F.struct(
        *[t[k].alias(k) for k in ("c2a", "sig", "ss", "cs", "c2sm")],
        (t["omega"] - (1 - t["c"]) * WGS84_F * t["s0"] * (t["sig"] + t["c"] * t["ss"] * (
            t["c2sm"] + t["c"] * t["cs"] * (-1 + 2 * t["c2sm"] * t["c2sm"])))).alias("turned"))
    return _bind(_bind(_bind(_bind(turn, ends), arcs), sums), done)


def _far_km(su1: Column, cu1: Column, su2: Column, cu2: Column, big_l: Column) -> Column:
    """Distance where the iteration over the longitude does not settle (nearly
    antipodal points): the azimuth is searched instead. The longitude covered
    rises with the azimuth from 0 to pi, so halving the interval finds it, in
    a fixed number of steps."""
    swap = F.abs(su2) > F.abs(su1)
    first, second = F.when(swap, su2).otherwise(su1), F.when(swap, su1).otherwise(su2)
    # South of the equator, never on it: the sign tells the quadrant.
    south = -F.greatest(F.abs(first), F.lit(1e-300))
    points = F.struct(south.alias("s1"), F.when(swap, cu2).otherwise(cu1).alias("c1"),
                      F.when(first > 0, -second).otherwise(second).alias("s2"),
                      F.when(swap, cu1).otherwise(cu2).alias("c2"),
                      F.abs(F.atan2(F.sin(big_l), F.cos(big_l))).alias("L"))

    def search(p: Column) -> Column:
        def halve(s, _):
            middle = (s["low"] + s["high"]) / 2
            short = _course(p, middle)["turned"] < p["L"]
            return _bind(F.struct(middle.alias("m"), short.alias("short")), lambda t: F.struct(
                F.when(t["short"], t["m"]).otherwise(s["low"]).alias("low"),
                F.when(t["short"], s["high"]).otherwise(t["m"]).alias("high")))

        whole = F.struct(F.lit(0.0).alias("low"), F.lit(math.pi).alias("high"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(AZIMUTH_STEPS)), whole, halve,
                           lambda s: _bind(_course(p, (s["low"] + s["high"]) / 2), lambda t: _vincenty_km(
                               t["c2a"], t["ss"], t["cs"], t["c2sm"], t["sig"])))

    return _bind(points, search)


def geodesic(lat1, lon1, lat2, lon2, iterations: int = 20) -> Column:
    """WGS-84 distance as ONE column expression, a struct of ``km`` and
    ``searched``: Vincenty's rounds run as the steps of a higher-order
    ``aggregate`` whose finish function turns the final state into the
    distance. Being a single expression matters: predicate pushdown may copy
    it into a filter on the distance, but it copies one node, never an
    unrolled chain whose inlined size grows exponentially. Coincident points
    give 0; if the last step still moved lambda by more than 1e-12 (nearly
    antipodal points) the azimuth is searched for instead, and ``searched`` is
    true."""
    f = WGS84_F
    u1 = F.atan((1 - f) * F.tan(F.radians(_col(lat1))))
    u2 = F.atan((1 - f) * F.tan(F.radians(_col(lat2))))
    big_l = F.radians(_col(lon2)) - F.radians(_col(lon1))
    zero = F.lit(0.0)
    start = _geo_state(su1=F.sin(u1), cu1=F.cos(u1), su2=F.sin(u2), cu2=F.cos(u2), L=big_l, lam=big_l,
                       ss=zero, cs=zero, sig=zero, sa=zero, c2a=zero, c2sm=zero, delta=F.lit(1.0))

    def finish(st):
        # Not settled, or settled beyond the antipode.
        open_ = (st["delta"] > F.lit(1e-12)) | (F.abs(st["lam"]) > F.lit(math.pi)) | F.isnan(st["delta"])
        km = (F.when(open_, _far_km(st["su1"], st["cu1"], st["su2"], st["cu2"], st["L"]))
               .when(st["ss"] == 0, F.lit(0.0))
               .otherwise(_vincenty_km(st["c2a"], st["ss"], st["cs"], st["c2sm"], st["sig"])))
        return F.struct(km.alias("km"), open_.alias("searched"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(3 * iterations - 1)), start,
                       lambda st, i: _vincenty_phase(st, i % 3), finish)


def geodesic_km(lat1, lon1, lat2, lon2, iterations: int = 20) -> Column:
    """The distance of :func:`geodesic` alone."""
    return geodesic(lat1, lon1, lat2, lon2, iterations)["km"]


def with_geodesic(df, name: str, lat1, lon1, lat2, lon2, iterations: int = 20):
    """Add column ``name`` with the ellipsoidal distance."""
    return df.withColumn(name, geodesic_km(lat1, lon1, lat2, lon2, iterations))


def zscore(c, mean: float, sd: float) -> Column:
    return (_col(c) - F.lit(mean)) / F.lit(sd)


def denormalize(c, mean: float, sd: float) -> Column:
    return _col(c) * F.lit(sd) + F.lit(mean)


def huber(residual: Column, delta: float = 1.0) -> Column:
    """Element Huber loss: quadratic inside ``delta``, linear outside."""
    r = F.abs(residual)
    return F.when(r < delta, 0.5 * r * r).otherwise(delta * (r - 0.5 * delta))

