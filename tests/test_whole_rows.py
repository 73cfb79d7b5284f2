"""No row is lost without a word, and plans keep their shape at scale."""

import os
import subprocess
import sys

import pytest
from conftest import SF001

from waymark.operators import bags, split
from waymark.operators.join import attach_coordinates, coord_lookup
from waymark.plans import fixtures as fx
from waymark.sources.sheets import scan_sheets, skipped_sheets
from waymark.sources.tables import read_bags, read_raw_signs, rejected_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rows_with_a_null_group_stay(spark):
    df = spark.createDataFrame([(k, g) for k, g in enumerate(["a", None, "b", "c", None])], "k int, place string")
    out = split.split(df, "place", test_size=0.25, seed=1).collect()
    assert sorted(r.k for r in out) == [0, 1, 2, 3, 4]
    assert len({r.split for r in out if r.place is None}) == 1


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_bad_numbers_fail_or_are_reported(spark, tmp_path):
    path = _write(tmp_path / "signs.csv", "intersection,text_on_sign_exact,latitude,longitude\n"
                                          "a,x,39.5,-104\nb,y,\"39,5\",-104\nc,z,,1\n")
    with pytest.raises(Exception, match="latitude holds no number"):
        read_raw_signs(spark, path).collect()
    assert [r.intersection for r in read_raw_signs(spark, path, mode="permissive").collect()] == ["a"]
    assert [(r.intersection, r.rejected) for r in rejected_rows(spark, path).collect()] == [("b", ["latitude"])]
    path = _write(tmp_path / "bags.csv", "text,latitude,longitude,sample_id\nx,1,2,3\ny,1,2,three\n")
    with pytest.raises(Exception, match="sample_id holds no number"):
        read_bags(spark, path).collect()
    assert len(read_bags(spark, path, mode="permissive").collect()) == 2


def test_a_blank_first_line_does_not_hide_a_sheet(spark, tmp_path):
    _write(tmp_path / "a.csv", "intersection,text_on_sign_exact\ni1,t1\n")
    _write(tmp_path / "b.csv", "\n  \nintersection,text_on_sign_exact\ni2,t2\n")
    _write(tmp_path / "c.csv", "intersection,code_type\ni3,c\n")
    rows = scan_sheets(spark, f"{tmp_path}/*.csv").collect()
    assert sorted((r.intersection, r.text_on_sign_exact) for r in rows) == [("i1", "t1"), ("i2", "t2")]
    left_out = skipped_sheets(spark, f"{tmp_path}/*.csv").collect()
    assert [(r.path.rsplit("/", 1)[1], r.missing) for r in left_out] == [("c.csv", ["text_on_sign_exact"])]


def _jobs(spark, build):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        build()
        return len(tracker.getJobIdsForGroup("plan-only"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_the_sign_join_starts_no_job(spark):
    signs, lookup = fx.signs(spark, SF001), coord_lookup(fx.coord_lookup_raw(spark, SF001), ["ord"])
    assert _jobs(spark, lambda: attach_coordinates(signs, lookup)) == 0


def test_the_slot_table_is_not_broadcast(spark):
    groups = spark.range(20_000).selectExpr("concat('g', id) AS intersection", "id AS o")
    signs = groups.selectExpr("intersection", "o", "'t' AS text_on_sign_exact", "1.0D AS latitude", "2.0D AS longitude")
    plan = bags.bootstrap_bags(signs, ["o"], code_col=None, samples=100, bag_size=8)
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [later for d, later in zip(depth[k + 1:], lines[k + 1:], strict=True) if d > depth[k]]
            assert not any("Generate" in later for later in below[:6])


def test_the_library_works_without_the_optional_package():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert 'raw_signs' in q and not any(n.startswith('op1_') for n in q); print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=False)
    assert out.returncode == 0, out.stderr
