"""The column functions restated as DuckDB SQL text, for oracle queries.

Each helper returns an SQL expression string built from the same patterns the
Spark expressions use (``waymark.functions``), so one rule has one spelling.
"""

from __future__ import annotations

from waymark.functions.geo import DMS_PATTERN, EARTH_RADIUS_KM, WGS84_A_KM, WGS84_F
from waymark.functions.text import WHITESPACE_CHARS, WS, _class_escape


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def clean(e: str, extra_chars: str = "", lowercase=True, remove_punctuation=True,
          collapse_whitespace=True, do_strip=True, keep_numbers=True, keep_underscore=True) -> str:
    out = f"CAST({e} AS VARCHAR)"
    if lowercase:
        out = f"lower({out})"
    if remove_punctuation:
        allowed = ("a-z0-9" if keep_numbers else "a-z") + ("_" if keep_underscore else "") \
            + _class_escape(extra_chars)
        out = f"regexp_replace({out}, {lit(f'[^{allowed}{WHITESPACE_CHARS}]+')}, '', 'g')"
    if collapse_whitespace:
        out = f"regexp_replace({out}, {lit(f'{WS}+')}, ' ', 'g')"
        out = f"regexp_replace({out}, ' ?- ?', '-', 'g')"
        if do_strip:
            out = f"trim({out})"
    elif do_strip:
        out = strip(out)
    return out


def key(e: str) -> str:
    out = f"lower({strip(f'CAST({e} AS VARCHAR)')})"
    out = f"replace({out}, '&', ' and ')"
    out = f"replace({out}, '/', '-')"
    out = f"regexp_replace({out}, {lit(f'{WS}+')}, ' ', 'g')"
    out = f"regexp_replace({out}, ' ?- ?', '-', 'g')"
    out = f"regexp_replace({out}, {lit(f'[^a-z0-9\\-_{WHITESPACE_CHARS}]+')}, '', 'g')"
    out = f"regexp_replace({out}, {lit(f'{WS}+')}, '-', 'g')"
    out = f"regexp_replace({out}, '^-+|-+$', '', 'g')"
    return f"coalesce({out}, '')"


def dms_parts(e: str) -> dict:
    """List expressions of the four capture groups of every DMS part."""
    return {name: f"regexp_extract_all({e}, {lit(DMS_PATTERN)}, {i})"
            for i, name in enumerate(["deg", "mins", "secs", "hemi"], start=1)}


def dms_value(parts: dict, i: int) -> str:
    secs = f"{parts['secs']}[{i}]"
    secs_num = (f"CASE WHEN regexp_full_match({secs}, '[0-9]*\\.?[0-9]*') AND regexp_matches({secs}, '[0-9]') "
                f"THEN CAST({secs} AS DOUBLE) END")
    v = (f"(CAST({parts['deg']}[{i}] AS DOUBLE) + CAST({parts['mins']}[{i}] AS DOUBLE) / 60 "
         f"+ {secs_num} / 3600)")
    return f"(CASE WHEN upper({parts['hemi']}[{i}]) IN ('S', 'W') THEN -{v} ELSE {v} END)"


def haversine(lat1, lon1, lat2, lon2, radius=EARTH_RADIUS_KM) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"({2 * radius!r} * asin(sqrt(least(1.0, {a}))))"


def hash32(*parts: str) -> str:
    """Same value as ``waymark.operators.ordinal.hash32``."""
    joined = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"CAST(('0x' || substr(md5({joined}), 1, 8)) AS BIGINT)"


def r6(e: str) -> str:
    return f"round({e}, 6)"


def geodesic_ctes(source: str, key_cols: list[str], lat1: str, lon1: str, lat2: str, lon2: str,
                  iterations: int = 20) -> str:
    """Recursive CTEs ``geo_it`` / ``geo_dist`` that run the same Vincenty
    phases as ``waymark.functions.geo.geodesic`` (three phases per
    iteration, ``3 * iterations`` steps) over the rows of ``source`` and give
    ``distance`` per ``key_cols``. Start the WITH clause with RECURSIVE."""
    f = WGS84_F
    a = WGS84_A_KM
    b = a * (1 - f)
    keys = ", ".join(key_cols)
    st = ["su1", "cu1", "su2", "cu2", "L", "lam", "ss", "cs", "sig", "sa", "c2a", "c2sm", "delta"]
    new_sa = "(CASE WHEN ss = 0 THEN CAST(0 AS DOUBLE) ELSE cu1 * cu2 * sin(lam) / ss END)"
    c = f"({f!r} / 16 * c2a * (4 + {f!r} * (4 - 3 * c2a)))"
    new_lam = (f"(L + (1 - {c}) * {f!r} * sa * (sig + {c} * ss * (c2sm + {c} * cs * "
               f"(-1 + 2 * c2sm * c2sm))))")
    step = {
        "ss": ("0", "sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2))"),
        "cs": ("0", "su1 * su2 + cu1 * cu2 * cos(lam)"),
        "sig": ("1", "atan2(ss, cs)"),
        "sa": ("1", new_sa),
        "c2a": ("1", f"1 - {new_sa} * {new_sa}"),
        "c2sm": ("1", f"(CASE WHEN {new_sa} * {new_sa} = 1 THEN CAST(0 AS DOUBLE) "
                      f"ELSE cs - 2 * su1 * su2 / (1 - {new_sa} * {new_sa}) END)"),
        "lam": ("2", new_lam),
        "delta": ("2", f"abs({new_lam} - lam)"),
    }
    cols = []
    for name in st:
        if name in step:
            ph, expr = step[name]
            cols.append(f"CASE WHEN delta <= 1e-12 THEN {name} WHEN k % 3 = {ph} THEN {expr} ELSE {name} END")
        else:
            cols.append(name)
    u1 = f"atan({1 - f!r} * tan(radians({lat1})))"
    u2 = f"atan({1 - f!r} * tan(radians({lat2})))"
    big_l = f"(radians({lon2}) - radians({lon1}))"
    usq = f"(c2a * ({a * a - b * b!r}) / ({b * b!r}))"
    big_a = f"(1 + {usq} / 16384 * (4096 + {usq} * (-768 + {usq} * (320 - 175 * {usq}))))"
    big_b = f"({usq} / 1024 * (256 + {usq} * (-128 + {usq} * (74 - 47 * {usq}))))"
    d_sig = (f"({big_b} * ss * (c2sm + {big_b} / 4 * (cs * (-1 + 2 * c2sm * c2sm) - {big_b} / 6 * c2sm * "
             f"(-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm))))")
    return f"""geo_it({keys}, k, {", ".join(st)}, glat1, glon1, glat2, glon2) AS (
  SELECT {keys}, 0, sin({u1}), cos({u1}), sin({u2}), cos({u2}), {big_l}, {big_l},
         {", ".join(["CAST(0 AS DOUBLE)"] * 6)}, CAST(1 AS DOUBLE),
         CAST({lat1} AS DOUBLE), CAST({lon1} AS DOUBLE), CAST({lat2} AS DOUBLE), CAST({lon2} AS DOUBLE)
  FROM {source}
  UNION ALL
  SELECT {keys}, k + 1, {", ".join(cols)}, glat1, glon1, glat2, glon2
  FROM geo_it WHERE k < {3 * iterations}),
geo_dist AS (
  SELECT {keys},
         CASE WHEN delta > 1e-12 THEN {haversine('glat1', 'glon1', 'glat2', 'glon2')}
              WHEN ss = 0 THEN CAST(0 AS DOUBLE)
              ELSE {b!r} * {big_a} * (sig - {d_sig}) END AS distance
  FROM geo_it WHERE k = {3 * iterations})"""
