"""HTML text and the Merkle audit."""

import random
import re
import time
from html.parser import HTMLParser

import duckdb
import pytest
from conftest import SF001
from oracle_check import digest, duck

from waymark.llm import catalog, html_text, warc_fixity

CASES = {
    "<ul><li>one<li>two<ol start=3><li>a<li>b</ol></ul>tail": "- one\n- two\n  3. a\n  4. b\n\ntail",
    "<h1>Head</h1><p>para <b>bold<br>next<p>second &amp; <i>x</i>y\n z": "Head\n\npara bold\nnext\n\nsecond & xy z",
    "<table><tr><th>Name<th>N<tr><td>alpha<td>1</tr><tr><td colspan=2>wide cell</table>": "Name   N\nalpha  1\nwide cell",
    "<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>": "a in ner  b",
    "a<div hidden>no</div><div style='display: none'>no</div><span style='visibility:hidden'>h"
    "<i style='visibility:visible'>v</i></span>": "av",
    "<title>t</title><script>x='</p>'</script><template>q</template>seen<!-- c -->": "seen",
    "x<pre>  a\n   b</pre>y": "x\n\n  a\n   b\n\ny",
    "<dl><dt>t<dd>d</dl>": "t\nd", "<p>tail <scri": "tail", "a &am": "a &am", "x < y <3 & z": "x < y <3 & z", "a<b": "a",
    "<div>a</p>b</div>": "a\n\nb", "<b><i>x</b>y</i>z": "xyz", "": "", "<a title='x>y'>t</a>": "t",
}


CASES |= {
    "<svg><title>no</title><text>drawn</text><desc>no</desc><path d='x'/></svg> a": "drawn a",
    "<math><semantics><mi>x</mi><mo>+</mo><mi>y</mi><annotation>no</annotation></semantics></math>": "x+y",
    "pick <select><option>one<option selected>two</select> now": "pick\none\ntwo\nnow",
    "<head><title>t</title>after the head<p>b": "after the head\n\nb", "a<noscript>ns</noscript>b": "a\nns\nb",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A  B\n   C",
    "<table><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>": "A  B\n   C\nD  E",
    "<table><tr><td>a<td rowspan=2 colspan=2>bb<td>c<tr><td>d<td>e</table>": "a  bb  c\nd      e",
    "<ol reversed><li>a<li>b<li value=9>c<li>d</ol>": "4. a\n3. b\n9. c\n8. d",
    "<ol start=-1><li>a<li value=x>b</ol>": "-1. a\n0. b",
    "<details><summary>S</summary>hid</details><details open><summary>T</summary>shown</details>": "S\nT\nshown",
    "<ul><li><p>a</p><p>b</p></li><li></li><li><ul><li>in</ul></ul>end": "- a\n\n  b\n- - in\n\nend",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert html_text.html_to_text(html) == CASES[html]


def test_depth_and_length():
    n = 200_000
    for html, text in (("<div>" * n + "x", "x"), ("<b>" * n + "</i>" * n + "x", "x"), ("<svg>" * n + "x", "x"),
                       ("<ul><li>" * n + "x", "- " * n + "x"), ("<table><tr><td>" * n + "x", "x")):
        begin = time.process_time()
        assert html_text.html_to_text(html) == text
        assert time.process_time() - begin < 20  # seconds where quadratic work would take hours
    deep = html_text.html_to_text("<ul><li>y" * 1000 + "x").split("\n")
    assert len(deep) == 1000 and all(line.lstrip() == "- y" for line in deep[:-1])
    assert [len(line) - 3 for line in deep[:40]] == [2 * min(k, 32) for k in range(40)]
    assert len(html_text.html_to_text("<p>wörd" * 100_000).split()) == 100_000


def plan(rng, depth, inside=""):
    """A random tree: strings and (tag, attributes, children)."""
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["text", "text", "b", "div", "p", "h2", "ul", "ol", "table", "section"]) if depth else "text"
        if kind == "text":
            out.append(rng.choice(["one", " two ", "three  four", "\n", "\u00e9t\u00e9 "]))
        elif kind == "b":
            out.append(("b", {}, [x for x in plan(rng, 0)]))
        elif kind in ("p", "h2"):
            out.append((kind, {}, [x for x in plan(rng, 0)]))
        elif kind in ("ul", "ol"):
            items = [("li", {"value": str(rng.randint(1, 99))} if rng.random() < 0.2 else {}, plan(rng, depth - 1))
                     for _ in range(rng.randint(0, 3))]
            out.append((kind, {"start": "5"} if kind == "ol" and rng.random() < 0.3 else {}, items))
        elif kind == "table":
            rows = [("tr", {}, [("td", {a: str(rng.randint(1, 3)) for a in ("rowspan", "colspan") if rng.random() < 0.3},
                                 plan(rng, depth - 1)) for _ in range(rng.randint(0, 3))]) for _ in range(rng.randint(0, 4))]
            out.append(("table", {}, [("tbody", {}, rows)]))
        else:
            out.append((kind, {}, plan(rng, depth - 1)))
    return out


def spell(nodes):
    return "".join(n if isinstance(n, str) else
                   f"<{n[0]}{''.join(f' {k}={v}' for k, v in n[1].items())}>{spell(n[2])}</{n[0]}>" for n in nodes)


def all_text(nodes):
    """Words of a cell: blocks part them, inline elements do not."""
    return "".join(n if isinstance(n, str) else all_text(n[2]) if n[0] == "b" else f" {marked(n)} " for n in nodes)


def marked(node):
    if node[0] not in ("ul", "ol"):
        return all_text(node[2])
    return " ".join(f"{m}{t}" for m, t in numbered(node, lambda kids: " ".join(all_text(kids).split())) if t)


def numbered(node, body):
    """(marker, body) of the items of a list."""
    at = int(node[1].get("start", 1))
    for _, attributes, kids in node[2]:
        at = int(attributes.get("value", at))
        yield (f"{at}. " if node[0] == "ol" else "- "), body(kids)
        at += 1


def grid(rows):
    """Lines of a table: cells written into a grid of taken places."""
    taken, cells = set(), []
    for y, (_, _, row) in enumerate(rows):
        x = 0
        for _, a, kids in row:
            while (y, x) in taken:
                x += 1
            wide, high = int(a.get("colspan", 1)), int(a.get("rowspan", 1))
            taken |= {(y + i, x + k) for i in range(high) for k in range(wide)}
            cells.append((y, x, wide, " ".join(all_text(kids).split())))
            x += wide
    ends = max([x + w for _, x, w, _ in cells], default=0)
    starts = [0] * (ends + 1)
    for _ in range(ends):  # until every cell has room before the column after it
        for _, x, w, t in cells:
            if t and starts[x + w] < starts[x] + len(t) + 2:
                more = starts[x] + len(t) + 2 - starts[x + w]
                starts[x + w:] = [max(s, starts[x + w] + more) for s in starts[x + w:]]
    for y in range(len(rows)):
        line = ""
        for _, x, _, t in [c for c in cells if c[0] == y and c[3]]:
            line += " " * (starts[x] - len(line)) + t
        if line:
            yield line


def layout(nodes, depth=0):
    """Lines and gaps (numbers) of a container, by recursion."""
    out, inline = [], ""

    def flush():
        if inline.split():
            out.append(" ".join(inline.split()))

    for n in nodes:
        if isinstance(n, str) or n[0] == "b":
            inline += n if isinstance(n, str) else all_text(n[2])
            continue
        flush()
        inline, tag = "", n[0]
        margin = 2 if tag in ("p", "h2", "table") or (tag in ("ul", "ol") and not depth) else 1
        out.append(margin)
        if tag == "table":
            for line in grid(n[2][0][2]):
                out += [line, 1]
        elif tag in ("ul", "ol"):
            for marker, lines in numbered(n, lambda kids: layout(kids, depth + 1)):
                body = flat(lines)
                out += [1, *[(marker if not k else " " * len(marker)) + x if x else "" for k, x in enumerate(body)], 1]
        else:
            out += layout(n[2], depth)
        out.append(margin)
    flush()
    return out


def flat(items):
    """Lines with blank ones for the widest of the gaps between them."""
    lines, gap = [], 0
    for item in items:
        if isinstance(item, int):
            gap = max(gap, item)
        else:
            lines += [""] * (gap - 1 if lines and gap else 0) + [item]
            gap = 0
    return lines


@pytest.mark.parametrize("seed", range(400))
def test_layout_equals_a_recursive_one(seed):
    nodes = plan(random.Random(seed), 3)
    assert html_text.html_to_text(spell(nodes)) == "\n".join(flat(layout(nodes)))


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_words_of_all_pages_equal_a_plain_parser(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF001}/pages.parquet'").fetchall())
    got = {r.page_id: r.text for r in catalog.QUERIES["op4_layout_text"](spark, SF001).collect()}
    assert set(got) == set(pages)
    for page, html in pages.items():
        plain = Visible()
        plain.feed(re.sub(r"<[^>]*\Z", "", html))
        plain.close()
        squeeze = lambda s: re.sub(r"\s+|- ", "", s)
        assert squeeze(got[page]) == squeeze("".join(plain.words)), page


def test_extract_text_rows(spark):
    df = spark.createDataFrame([(1, None, "z"), (None, "<p>a", "z"), (2, "", "z"), (2, "", "z")], "page_id long, html string, text string")
    rows = html_text.extract_text(df).collect()
    assert sorted((r.page_id or 0, r.text) for r in rows) == [(0, "a"), (1, ""), (2, ""), (2, "")]
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_audit_query_matches_sql(spark):
    for sf in (SF001, "/root/testdata/sf0.01"):
        df = catalog.QUERIES["op5_merkle_audit"](spark, sf)
        rel = duck(sf).sql(catalog.ORACLE["op5_merkle_audit"])
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_audit_statuses_and_nulls(spark):
    pages = [(k, f"u{k}", "x" * (k * 700)) for k in range(300)] + [(None, None, None), (5, "u5", "x" * 3500), (9, None, "")]
    archive = warc_fixity.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), num_partitions=3)
    assert archive.count() == 303
    assert warc_fixity.audit(archive, archive).count() == 0
    less = archive.where("page_id is null or page_id not in (17, 250)")
    assert sorted((r.page_id, r.status) for r in warc_fixity.audit(archive, less).collect()) == [(17, "missing"), (250, "missing")]
    assert {(r.page_id, r.status) for r in warc_fixity.audit(less, archive).collect()} == {(17, "added"), (250, "added")}
    none = archive.where("false")
    assert warc_fixity.audit(none, none).count() == 0
    assert warc_fixity.audit(archive, none).count() == 303


def test_records_are_laid_out_without_gaps(spark):
    rows = warc_fixity.write_archive(spark.read.parquet(f"{SF001}/pages.parquet"), num_partitions=2).collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.shard, r.start)):
        assert r.start == ends.get(r.shard, 0) and r.length == len(r.record)
        ends[r.shard] = r.start + r.length
        head, _, payload = bytes(r.record).partition(b"\r\n\r\n")
        assert int(re.search(rb"Content-Length: (\d+)", head)[1]) == len(payload) - 4
