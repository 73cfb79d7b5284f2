"""Queries: guess validation and scoring, batch and streaming."""

from __future__ import annotations

import os

from waymark.operators import score as SC
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.registry import r6, register
from waymark.session import scratch_path
from waymark.streaming.guesses import guess_stream, run_to_table, run_with_rejects, score_guess_stream

_VALIDATED = f"""validated AS (
  SELECT g.guess_id, g.round_id, g.latitude, g.longitude,
         CASE WHEN g.text IS NULL OR length(g.text) NOT BETWEEN 1 AND 4000 OR {q.strip('g.text')} = '' THEN 'text_invalid'
              WHEN g.round_id IS NULL OR g.round_id < 0 THEN 'round_id_negative'
              WHEN g.latitude IS NULL OR NOT (g.latitude BETWEEN -90 AND 90) THEN 'latitude_out_of_range'
              WHEN g.longitude IS NULL OR NOT (g.longitude BETWEEN -180 AND 180) THEN 'longitude_out_of_range'
              WHEN r.round_id IS NULL THEN 'round_not_found' END AS reason
  FROM guesses g LEFT JOIN rounds r ON g.round_id = r.round_id)"""

_SCORED_SQL = X.with_ctes(X.ROUNDS, X.GUESSES, _VALIDATED, body=f"""
SELECT v.guess_id, v.round_id, round(v.latitude, 6) AS latitude, round(v.longitude, 6) AS longitude,
       round(r.latitude, 6) AS actual_latitude, round(r.longitude, 6) AS actual_longitude,
       round({q.haversine('v.latitude', 'v.longitude', 'r.latitude', 'r.longitude')}, 6) AS guess_error_km,
       round({q.haversine('r.predicted_latitude', 'r.predicted_longitude', 'r.latitude', 'r.longitude')}, 6)
         AS model_error_km
FROM validated v JOIN rounds r ON v.round_id = r.round_id WHERE v.reason IS NULL""")

SCORE_COLS = ["guess_id", "round_id"]


def _scored_out(df):
    return df.select(*SCORE_COLS, r6("latitude"), r6("longitude"), r6("actual_latitude"),
                     r6("actual_longitude"), r6("guess_error_km"), r6("model_error_km"))


@register("validate_guesses", X.with_ctes(X.ROUNDS, X.GUESSES, _VALIDATED, body="""
SELECT guess_id, round_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, reason
FROM validated"""))
def q_validate_guesses(spark, d):
    v = SC.validate_guesses(fx.guesses(spark, d), fx.rounds(spark, d))
    return v.select("guess_id", "round_id", r6("latitude"), r6("longitude"), "reason")


@register("score_guesses", _SCORED_SQL)
def q_score_guesses(spark, d):
    return _scored_out(SC.score_guesses(fx.guesses(spark, d), fx.rounds(spark, d)))


@register("score_open_estimates", X.with_ctes(X.ROUNDS, X.GUESSES, _VALIDATED, body=f"""
SELECT g.guess_id, round(r.predicted_latitude, 6) AS predicted_latitude,
       round(r.predicted_longitude, 6) AS predicted_longitude,
       round({q.haversine('g.latitude', 'g.longitude', 'r.predicted_latitude', 'r.predicted_longitude')}, 6)
         AS distance_km
FROM validated g JOIN rounds r ON g.round_id = r.round_id WHERE g.reason IS NULL"""))
def q_score_open_estimates(spark, d):
    out = SC.score_open_estimates(fx.guesses(spark, d), fx.rounds(spark, d))
    return out.select("guess_id", r6("predicted_latitude"), r6("predicted_longitude"), r6("distance_km"))


@register("score_guesses_stream", _SCORED_SQL)
def q_score_guesses_stream(spark, d):
    """The events table read as a file stream, scored micro-batch by
    micro-batch against the static rounds, written to a Parquet sink and read
    back."""
    events_schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    stream = guess_stream(spark, d, events_schema, file_glob="events.parquet")
    scored = score_guess_stream(fx.guesses_from_events(stream, fx.round_count(spark, d)), fx.rounds(spark, d))
    path = run_to_table(_scored_out(scored), "guess-scores")
    return spark.read.parquet(path)


@register("judge_guesses_stream", X.with_ctes(X.ROUNDS, X.GUESSES, _VALIDATED, body=f"""
SELECT v.guess_id, v.round_id, v.reason,
       CASE WHEN v.reason IS NULL THEN round({q.haversine('v.latitude', 'v.longitude', 'r.latitude', 'r.longitude')}, 6) END
         AS guess_error_km,
       CASE WHEN v.reason IS NULL
            THEN round({q.haversine('r.predicted_latitude', 'r.predicted_longitude', 'r.latitude', 'r.longitude')}, 6) END
         AS model_error_km
FROM validated v LEFT JOIN rounds r ON v.round_id = r.round_id"""))
def q_judge_guesses_stream(spark, d):
    """The events table as a file stream, judged into a table of scores and a
    table of rejects with their reasons; both read back."""
    events_schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    stream = guess_stream(spark, d, events_schema, file_glob="events.parquet")
    scores, rejects = run_with_rejects(fx.guesses_from_events(stream, fx.round_count(spark, d)), fx.rounds(spark, d),
                                       *[scratch_path(spark, n) for n in ("scores", "rejects", "judge-ckpt")])
    both = spark.read.parquet(scores).unionByName(spark.read.parquet(rejects), allowMissingColumns=True)
    return both.select("guess_id", "round_id", "reason", r6("guess_error_km"), r6("model_error_km"))
