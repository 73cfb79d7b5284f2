"""Header CSV in blocks: any cut of a file gives the rows of a plain reader."""

import contextlib
import csv
import io
import random

import pytest

from waymark.sources import csvblocks
from waymark.sources.csvblocks import csv_rows, ends_inside, first_header
from waymark.sources.sheets import scan_sheets, skipped_sheets
from waymark.sources.tables import read_raw_signs, read_table


@contextlib.contextmanager
def blocks_of(spark, size):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, str(size))
        yield
    finally:
        for k, v in zip(keys, old, strict=True):
            spark.conf.set(k, v)


def plain(text):
    """Rows of a plain reader of the whole file, header first, blank rows left out."""
    rows = csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""))
    return [r for r in rows if len(r) > 1 or (r and r[0].strip())]


def dicts(text, wanted):
    head, *rows = plain(text)
    names = csvblocks.column_names(head)
    return [tuple(r[names.index(w)] if w in names and names.index(w) < len(r) else None for w in wanted) for r in rows]


def read(spark, path, wanted, required=()):
    rows = csv_rows(spark, str(path), wanted, required).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: tuple(r.ord))]


def random_csv(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["", "name", "text", "name"])
    for k in range(rows):
        field = "".join(rng.choice(["a", "é", ",", '"', "\n", "\n\n", " ", "long words here ", '""', "x"])
                        for _ in range(rng.choice([0, 1, 3, 12, 60])))
        writer.writerow([k, field, "name" if k % 7 == 0 else field[::-1], "" if k % 3 else "5"])
        if k % 11 == 0:
            out.write(rng.choice(["\n", "  \n", "name\n", f'{k},5" pipe,6" pipe\n', f"{k}\n", "5,name,text,name\n"]))
    return out.getvalue()


@pytest.mark.parametrize("size", [301, 10 ** 7])
def test_any_cut_gives_the_same_rows(spark, tmp_path, size):
    rng, wanted = random.Random(size), ["text", "name", "Unnamed: 0", "name.1", "absent"]
    for k in range(2):
        text = ("﻿" if k else "") + random_csv(rng, 60)
        (tmp_path / f"f{k}.csv").write_text(text, encoding="utf-8")
    with blocks_of(spark, size):
        got = read(spark, tmp_path, wanted)
    want = [r for k in range(2) for r in dicts((tmp_path / f"f{k}.csv").read_text("utf-8"), wanted)]
    assert got == want


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    text = random_csv(random.Random(3), 250)
    (tmp_path / "one.csv").write_text(text, encoding="utf-8")
    with blocks_of(spark, 500):
        starts = csvblocks.block_starts(csvblocks._lines(spark, str(tmp_path / "one.csv"))).collect()
        assert len(starts) > 20 and any(r.inside for r in starts) and not starts[0].inside
        assert read(spark, tmp_path / "one.csv", ["text"]) == dicts(text, ["text"])


def test_an_unclosed_quote_and_crlf(spark, tmp_path):
    for text in ('a,b\r\n1,"x\r\ny"\r\n2,z\r\n', 'a,b\n1,2\n3,"never closed\nmore, and\nmore', "a,b\r1,2\r3,4\r", "a,b\n", "\n \n"):
        (tmp_path / "f.csv").write_bytes(text.encode())
        want = [tuple(f.replace("\r\n", "\n") for f in r) for r in dicts(text, ["a", "b"])] if plain(text) else []
        for size in (16, 10 ** 6):
            with blocks_of(spark, size):
                if size == 16 and not plain(text):
                    continue
                assert read(spark, tmp_path / "f.csv", ["a", "b"]) == want, (text, size)


def test_states_of_a_line():
    for line, outside, inside in [("a,b", False, True), ('"a', True, False), ('a" b', False, False), ('x,"a ""b"" c",d', False, False),
                                  ('"",""""', False, True), ('""",', True, False), ('5" pipe,"x', True, True)]:
        assert (ends_inside(line, False), ends_inside(line, True)) == (outside, inside), line


def test_extra_text_fails_and_extra_blanks_do_not(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,2,, \n")
    assert read(spark, tmp_path / "f.csv", ["a", "b"]) == [("1", "2")]
    (tmp_path / "f.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="3 fields, the header 2"):
        read(spark, tmp_path / "f.csv", ["a", "b"])


def test_index_column_duplicate_names_and_rows_like_the_header(spark, tmp_path):
    (tmp_path / "signs.csv").write_text(
        ",intersection,text_on_sign_exact,latitude,longitude,notes,notes\n0,a,Stop,39.5,-104.5,n,m\n1,b,\"Two\nlines\",39,-104,,\n")
    got = read_raw_signs(spark, str(tmp_path / "signs.csv")).collect()
    assert [(r.intersection, r.text_on_sign_exact, r.latitude) for r in got] == [("a", "Stop", 39.5), ("b", "Two\nlines", 39.0)]
    assert read_table(spark, str(tmp_path / "signs.csv")).columns == [
        "Unnamed: 0", "intersection", "text_on_sign_exact", "latitude", "longitude", "notes", "notes.1"]
    (tmp_path / "sheets").mkdir()
    (tmp_path / "sheets" / "a.csv").write_text(
        "intersection,text_on_sign_exact,notes,notes\nx,Stop,1,2\nintersection,text_on_sign_exact,notes,notes\ny,Go,3,4\n")
    (tmp_path / "sheets" / "b.csv").write_text('"inter\nsection",text_on_sign_exact\nz,lost\n')
    rows = scan_sheets(spark, f"{tmp_path}/sheets/*.csv").orderBy("ord").collect()
    assert [(r.intersection, r.text_on_sign_exact, r.notes) for r in rows] == [
        ("x", "Stop", "1"), ("intersection", "text_on_sign_exact", "notes"), ("y", "Go", "3")]
    assert [r.missing for r in skipped_sheets(spark, f"{tmp_path}/sheets/*.csv").collect()] == [["intersection"]]


def test_headers(spark, tmp_path):
    (tmp_path / "f.csv").write_text('﻿\n \t\n"a\nb",c\n' + "1,2\n" * 50, encoding="utf-8")
    assert first_header(spark, str(tmp_path / "f.csv")) == ["a\nb", "c"]
    assert read(spark, tmp_path / "f.csv", ["a\nb"]) == [("1",)] * 50
    (tmp_path / "e.csv").write_text("")
    assert first_header(spark, str(tmp_path / "e.csv")) == []


def test_one_read_and_no_collect(spark, tmp_path):
    (tmp_path / "a.csv").write_text("intersection,text_on_sign_exact\nx,Stop\n")
    plan = scan_sheets(spark, f"{tmp_path}/*.csv")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_lines_that_need_no_parser(spark, tmp_path):
    """Plain lines are told from the arrays of a batch: outside quotes, without
    a quote or CR, with the header's number of fields."""
    import pyarrow as pa
    rng = random.Random(11)
    for width in (1, 2, 3):
        for inside in (False, True):
            lines = [rng.choice(["a,b", "a", "", "é,", "a,b,c", 'x,"y', 'y",z', '"q",r', "a,\r", ",,", 'p" q,r']) for _ in range(400)]
            plain_lines, end = csvblocks._plain_lines(pa.array(lines), width, inside)
            state, want = inside, []
            for line in lines:
                want.append(width > 1 and not state and '"' not in line and "\r" not in line and line.count(",") == width - 1)
                state = ends_inside(line, state)
            assert plain_lines.tolist() == want and end == state
    # Few quoted rows among many plain ones, in several batches a block.
    text = "n,text\n" + "".join(f'{k},"two\nlines, ""{k}"""\n' if k % 997 == 5 else f"{k},é {k}\n" for k in range(30000))
    (tmp_path / "f.csv").write_text(text, encoding="utf-8")
    for size in (100_000, 10 ** 7):
        with blocks_of(spark, size):
            assert read(spark, tmp_path / "f.csv", ["text", "n"]) == dicts(text, ["text", "n"])


def test_plain_lines_of_uncut_files_skip_the_parser(monkeypatch):
    """Lines without quotes go by columns, also in files that are never cut;
    the rows are those of the csv module."""
    import csv
    import io
    import random
    import pyarrow as pa
    from waymark.sources import csvblocks as C
    draw, parsed = random.Random(9), []

    class Lines:
        def mapInArrow(self, run, _schema):
            return run

    def text(k):
        rows = [["n", "", "a,b" if k == 0 else "t", 'x"y']] if k < 2 else []
        rows += [[str(i), "plain", "", "u"] if draw.random() < 0.8 else [str(i), 'q"\n,', "two\nlines", "\r"] for i in range(40)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([["", " "]] * (k == 1) + [["a", "b", "c", "d"], *rows])
        return ("\ufeff" if k == 0 else "") + out.getvalue()

    files = {f"f{k}": text(k) for k in range(4)}
    rows = [(p, 0, i, line) for p, t in files.items() for i, line in enumerate(t.removesuffix("\n").split("\n"))]
    parse = C._parse
    monkeypatch.setattr(C, "_parse", lambda lines: parse(parsed.extend(lines) or list(lines)))
    run = C._whole_files(Lines(), ["d", "a"], ["a"])
    for step in (1, 7, 1000):
        parsed.clear()
        batches = [pa.record_batch([pa.array(c) for c in zip(*rows[i:i + step])], ["path", "block", "pos", "value"])
                   for i in range(0, len(rows), step)]
        got = sorted((r["path"], r["pos"], r["c0"], r["c1"]) for b in run(iter(batches)) for r in b.to_pylist())
        want = []
        for path, t in files.items():
            whole = [r for r in csv.reader(io.StringIO(t.removeprefix("\ufeff"), newline="")) if len(r) > 1 or (r and r[0].strip())]
            names = whole[0]
            want += [(path, r[3].replace("\r", "\n"), r[0]) for r in whole[1:]] if "a" in names else []
        assert [(p, d, a) for p, _, d, a in got] == want
        assert len(parsed) < len(rows) * 0.75
