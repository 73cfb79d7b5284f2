"""Guess validation and scoring.

The same functions take a batch or a streaming DataFrame of guesses; the
round table is static. A guess joins its round on ``round_id`` -- the round
table is one row per bag, so the planner broadcasts it while it is under the
broadcast threshold and shuffles both sides beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_km
from waymark.functions.text import strip_ws

MAX_TEXT_CHARS = 4000

# The rejection reasons, in the order the checks apply.
REASONS = ("text_invalid", "round_id_negative", "latitude_out_of_range",
           "longitude_out_of_range", "round_not_found")


def text_reason(text_col: str = "text") -> F.Column:
    """Reason a free text is rejected: length outside 1..4000 characters, or
    blank after stripping; null when acceptable."""
    t = F.col(text_col)
    bad = t.isNull() | (F.length(t) < 1) | (F.length(t) > MAX_TEXT_CHARS) | (strip_ws(t) == "")
    return F.when(bad, F.lit("text_invalid"))


def validate_guesses(guesses: DataFrame, rounds: DataFrame) -> DataFrame:
    """Add ``reason``: null for a playable guess, otherwise the first failed
    check -- text (when the guess carries one), round id >= 0, latitude in
    [-90, 90], longitude in [-180, 180], round exists."""
    known = rounds.select("round_id", F.lit(True).alias("_wm_known"))
    return _with_reason(guesses.join(known, "round_id", "left"), "text" in guesses.columns).drop("_wm_known")


def _with_reason(g: DataFrame, has_text: bool) -> DataFrame:
    """``reason`` of guesses joined with their round (``_wm_known`` is null
    where there is none)."""
    checks = []
    if has_text:
        checks.append((text_reason("text").isNotNull(), "text_invalid"))
    checks += [
        (F.col("round_id").isNull() | (F.col("round_id") < 0), "round_id_negative"),
        (F.col("latitude").isNull() | ~F.col("latitude").between(-90, 90), "latitude_out_of_range"),
        (F.col("longitude").isNull() | ~F.col("longitude").between(-180, 180), "longitude_out_of_range"),
        (F.col("_wm_known").isNull(), "round_not_found"),
    ]
    reason = F.lit(None).cast("string")
    for cond, name in reversed(checks):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    return g.withColumn("reason", reason)


def _playable(guesses: DataFrame, rounds: DataFrame, columns: dict) -> DataFrame:
    """Guesses without a reason, beside columns of their round: one join."""
    r = rounds.select("round_id", *[F.col(c).alias(n) for n, c in columns.items()], F.lit(True).alias("_wm_known"))
    joined = _with_reason(guesses.join(r, "round_id", "left"), "text" in guesses.columns)
    return joined.where(F.col("reason").isNull()).drop("reason", "_wm_known")


_TRUTH = {"actual_latitude": "latitude", "actual_longitude": "longitude",
          "predicted_latitude": "predicted_latitude", "predicted_longitude": "predicted_longitude"}


def _with_errors(joined: DataFrame) -> DataFrame:
    return joined.withColumns({
        "guess_error_km": haversine_km("latitude", "longitude", "actual_latitude", "actual_longitude"),
        "model_error_km": haversine_km("predicted_latitude", "predicted_longitude",
                                       "actual_latitude", "actual_longitude"),
    })


def score_guesses(guesses: DataFrame, rounds: DataFrame) -> DataFrame:
    """Playable guesses with their round's truth and model prediction:
    ``guess_error_km`` (guess to truth) and ``model_error_km`` (prediction
    to truth)."""
    return _with_errors(_playable(guesses, rounds, _TRUTH))


def judge_guesses(guesses: DataFrame, rounds: DataFrame) -> DataFrame:
    """Every guess with ``reason`` and its errors, from one join: the scores
    are the rows without a reason, the rejects those with one (their errors
    are null)."""
    r = rounds.select("round_id", *[F.col(c).alias(n) for n, c in _TRUTH.items()], F.lit(True).alias("_wm_known"))
    judged = _with_errors(_with_reason(guesses.join(r, "round_id", "left"), "text" in guesses.columns).drop("_wm_known"))
    return judged.withColumns({c: F.when(F.col("reason").isNull(), F.col(c)) for c in ("guess_error_km", "model_error_km")})


def score_open_estimates(estimates: DataFrame, predictions: DataFrame) -> DataFrame:
    """Distance between a user's playable estimate and the model's prediction
    for the same text (no truth needed)."""
    return _playable(estimates, predictions, {c: c for c in ("predicted_latitude", "predicted_longitude")}).withColumn(
        "distance_km", haversine_km("latitude", "longitude", "predicted_latitude", "predicted_longitude"))
