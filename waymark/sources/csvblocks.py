"""Header CSV files read in blocks, also where quoted fields hold line breaks.

A line break ends a row only outside quotes, and whether a place is inside
quotes depends on all of the file before it. Files are nevertheless read by
many tasks:

1. the text source cuts files into blocks of whole lines. One pass over the
   files that may be cut finds, per block, whether it ends inside quotes if it
   begins outside, and if it begins inside: a function on two states;
2. the running composition of these functions over the blocks of a file (one
   row each) tells where every block begins;
3. with that, each task parses its own rows. A row that crosses blocks leaves
   at most two fragments a block; these alone are shuffled and joined.

Files below the least size of a cut need no first pass: one read gives their
rows. The header of a file is its first row that is not blank, told by its
place; a later row that looks like it is a row. Every file has its own header,
and columns are found by name.

A field that begins with ``"`` is quoted, with ``"`` doubled inside; elsewhere
the character is text. Rows end at LF, CRLF or CR; line breaks inside quotes
become LF. Blank rows (nothing, or white space without a delimiter) are left
out. A short row lacks its last columns; a row with text beyond the header's
columns fails the job. A quote that is never closed extends to the end of the
file.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.session import ship_package
from waymark.sources.staging import stage_table

#: Blocks whose begin is broadcast (some 100 bytes each); more are joined by a shuffle.
BROADCAST_BLOCKS = 200_000
#: Rows parsed between two output batches.
ROWS_AT_ONCE = 4096


def column_names(fields: list[str]) -> list[str]:
    """Names of a header row: blank ones become ``Unnamed: <i>``, repeated
    ones get ``.1``, ``.2`` and so on."""
    names, seen = [], {}
    for i, name in enumerate(fields):
        name = name if name != "" else f"Unnamed: {i}"
        again = seen.get(name, 0)
        seen[name] = again + 1
        while again and f"{name}.{again}" in seen:
            again += 1
        if again:
            name = f"{name}.{again}"
            seen[name] = 1
        names.append(name)
    return names


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside or outside quotes ends inside them."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line[at:at + 1] != '"':
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        close = line.find('"', at)
        while close >= 0 and line[close + 1:close + 2] == '"':
            close = line.find('"', close + 2)
        if close < 0:
            return True
        inside, at = False, line.find(",", close + 1) + 1
        if not at:
            return False


def _parse(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    """``(line number, fields)`` of every row that is not blank."""
    csv.field_size_limit(sys.maxsize)
    parts, origin = [], []
    for k, line in enumerate(lines):
        for part in line.removesuffix("\r").split("\r"):
            parts.append(part + "\n")
            origin.append(k)
    if parts:
        parts[-1] = parts[-1][:-1]  # the end of a file inside quotes
    reader, at = csv.reader(parts), 0
    for fields in reader:
        if len(fields) > 1 or (fields and fields[0].strip()):
            yield origin[at], fields
        at = reader.line_num


class _Columns:
    """Picks the wanted columns of a file's rows by its header."""

    def __init__(self, path: str, header: list[str], wanted: list[str], required: list[str]):
        self.path, names = path, column_names(header)
        self.width = len(names)
        self.places = [names.index(c) if c in names else None for c in wanted]
        self.usable = all(c in names for c in required)

    def pick(self, fields: list[str]) -> list[str | None]:
        if len(fields) > self.width and any(f.strip() for f in fields[self.width:]):
            raise ValueError(f"{self.path}: a row has {len(fields)} fields, the header {self.width}")
        return [fields[p] if p is not None and p < len(fields) else None for p in self.places]


def _lines(spark: SparkSession, paths, files: Column | None = None) -> DataFrame:
    """``path, block, pos, value`` of every line; ``pos`` rises within a block.
    ``files`` is a condition on the file, which prunes the listing."""
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    return (lines if files is None else lines.where(files)).select(
        meta["file_path"].alias("path"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, str, int, pa.Array, pa.Array]]:
    """``(row in the batch, path, block, positions, lines)`` in pieces, in
    order, as Arrow arrays."""
    paths, blocks, places, values = (batch.column(c) for c in ("path", "block", "pos", "value"))
    if not batch.num_rows:
        return
    other = np.diff(blocks.to_numpy(zero_copy_only=False)) != 0
    other |= pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False).astype(bool)
    cuts = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield begin, paths[begin].as_py(), blocks[begin].as_py(), places[begin:end], values[begin:end]


def _where(mask: pa.Array) -> np.ndarray:
    return np.flatnonzero(mask.to_numpy(zero_copy_only=False))


def _plain_lines(values: pa.Array, width: int, inside: bool) -> tuple[np.ndarray, bool]:
    """Which lines are rows by themselves that need no parser (outside quotes,
    no quote or CR in them, the header's number of fields), and whether the
    last line ends inside quotes if the first begins ``inside``."""
    quoted = _where(pc.match_substring(values, '"'))
    plain = pc.equal(pc.count_substring(values, ","), width - 1).to_numpy(zero_copy_only=False).astype(bool)
    plain[quoted] = False
    plain[_where(pc.match_substring(values, "\r"))] = False
    if width < 2:
        plain[:] = False  # a blank line has as many delimiters as a row
    # Only a line with a quote changes the state.
    begin = 0
    for k, line in zip(quoted.tolist(), values.take(pa.array(quoted)).to_pylist(), strict=True):
        if inside:
            plain[begin:k] = False
        begin, inside = k + 1, ends_inside(line, inside)
    if inside:
        plain[begin:] = False
    return plain, inside


def _unmarked(line: str) -> str:
    return line.removeprefix("\ufeff")


def least_cut(spark: SparkSession) -> int:
    """Files of at most this many bytes are never cut by the file sources."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return min(size(spark.conf.get(f"spark.sql.files.{key}")) for key in ("openCostInBytes", "maxPartitionBytes"))


def _has_large(spark: SparkSession, paths, limit: int) -> bool:
    """Some file is larger than ``limit`` (a listing; nothing is read)."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return bool(files.where(F.col("length") > limit).select("length").take(1))


def _scan_blocks(lines: DataFrame) -> DataFrame:
    """``path, block, from_outside, from_inside, header``: the state at the end
    of every block for both states at its begin, and the header row if the
    block is a file's first (null if that row does not end in it)."""
    def run(batches):
        at, outside, inside, header, first = None, False, True, None, []

        def done():
            return pa.record_batch(
                [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([outside]), pa.array([inside]),
                 pa.array([header], pa.list_(pa.string()))], ["path", "block", "from_outside", "from_inside", "header"])

        for path, block, values in ((p, b, v) for batch in batches for _, p, b, _, v in _pieces(batch)):
            begins = at != (path, block)
            if begins:
                if at is not None:
                    yield done()
                at, outside, inside, header = (path, block), False, True, None
                first = [] if block == 0 else None
            # After the header only lines with a quote matter.
            looked = 0
            while first is not None and looked < len(values):
                line = values[looked].as_py()
                if begins and not looked:
                    line = _unmarked(line)
                looked += 1
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
                first.append(line)
                if not outside:
                    found = next(_parse(first), None)
                    first, header = (None, found[1]) if found else ([], None)
            rest = values[looked:]
            for line in rest.filter(pc.match_substring(rest, '"')).to_pylist():
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
        if at is not None:
            yield done()

    return lines.mapInArrow(run, "path string, block bigint, from_outside boolean, from_inside boolean, "
                                 "header array<string>")


def block_starts(lines: DataFrame) -> DataFrame:
    """``path, block, inside, header``: whether a block begins inside quotes,
    and its file's header row."""
    scanned = stage_table(_scan_blocks(lines), "csv-blocks")
    # A block either fixes the state at its end, keeps it, or turns it round.
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    in_file = Window.partitionBy("path").orderBy("block")  # one row per block
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    marked = scanned.withColumns({"fixed": fixed, "turned": F.sum(turns).over(
        in_file.rowsBetween(Window.unboundedPreceding, 0))})
    last = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned")), ignorenulls=True).over(before)
    turned = F.coalesce(F.last("turned").over(before), F.lit(0))
    since = turned - F.coalesce(last["turned"], F.lit(0))
    inside = F.coalesce(last["fixed"], F.lit(False)) != (since % 2 == 1)
    header = F.first("header", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return stage_table(marked.select("path", "block", inside.alias("inside"), header.alias("header")), "csv-starts")


def csv_headers(spark: SparkSession, paths) -> DataFrame:
    """``path, names``: the column names of every file (no names if it has no
    row)."""
    first = _scan_blocks(_lines(spark, paths)).where("block = 0").select("path", "header")

    def name(batches):
        for batch in batches:
            names = [column_names(h or []) for h in batch.column("header").to_pylist()]
            yield pa.record_batch([batch.column("path"), pa.array(names, pa.list_(pa.string()))], ["path", "names"])

    return first.mapInArrow(name, "path string, names array<string>")


def _emit(rows: list[tuple], wanted: int, fragments: bool) -> pa.RecordBatch:
    names = ["path", "block", "pos", *[f"c{k}" for k in range(wanted)], *(["fragment", "opens"] if fragments else [])]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * wanted, pa.string(), pa.bool_()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)], names)


def _emit_plain(at: tuple[str, int], places: pa.Array, values: pa.Array, columns: _Columns,
                fragments: bool) -> pa.RecordBatch:
    """The rows of plain lines (see ``_plain_lines``), all columns at once."""
    n, width = len(values), columns.width
    fields = pc.split_pattern(values, ",").flatten()
    picked = [pa.nulls(n, pa.string()) if p is None else
              fields.take(pa.array(np.arange(p, n * width, width))).cast(pa.string()) for p in columns.places]
    arrays = [pa.repeat(pa.scalar(at[0], pa.string()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n), places, *picked]
    names = ["path", "block", "pos", *[f"c{k}" for k in range(len(picked))]]
    if fragments:
        arrays += [pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_())]
        names += ["fragment", "opens"]
    return pa.record_batch(arrays, names)


def _kinds(wanted: list[str], more: str = "") -> str:
    return ", ".join(["path string, block bigint, pos bigint", *[f"c{k} string" for k in range(len(wanted))]]) + more


def _whole_files(lines: DataFrame, wanted: list[str], required: list[str]) -> DataFrame:
    """Rows of files that are one block each: a single read."""
    def run(batches):
        path, columns, held, places, inside = None, None, [], [], False

        def rows():
            nonlocal columns
            out = []
            for at, fields in _parse(held):
                if columns is None:
                    columns = _Columns(path, fields, wanted, required)
                elif columns.usable:
                    out.append((path, 0, places[at], *columns.pick(fields)))
            held.clear()
            places.clear()
            if out:
                yield _emit(out, len(wanted), False)

        for _, name, _, numbers, values in (piece for batch in batches for piece in _pieces(batch)):
            begins = name != path
            if begins:
                yield from rows()
                path, columns, inside = name, None, False
            looked = 0
            while columns is None and looked < len(values):
                line = values[looked].as_py()
                line = _unmarked(line) if begins and not looked else line
                held.append(line)
                places.append(numbers[looked].as_py())
                inside = ends_inside(line, inside)
                looked += 1
                if not inside:
                    yield from rows()
            numbers, values = numbers[looked:], values[looked:]
            if not len(values):
                continue
            # Whole rows stand between the lines that are left (see _cut_files).
            plain, _ = _plain_lines(values, columns.width, inside)
            if plain.any():
                mask = pa.array(plain)
                if columns.usable:
                    yield _emit_plain((path, 0), numbers.filter(mask), values.filter(mask), columns, False)
                numbers, values = numbers.filter(pa.array(~plain)), values.filter(pa.array(~plain))
            for number, line in zip(numbers.to_pylist(), values.to_pylist(), strict=True):
                held.append(line)
                places.append(number)
                inside = ends_inside(line, inside)
                if len(held) >= ROWS_AT_ONCE and not inside:
                    yield from rows()
        yield from rows()

    return lines.mapInArrow(run, _kinds(wanted))


def _cut_files(lines: DataFrame, wanted: list[str], required: list[str]) -> DataFrame:
    """Rows of files that may be several blocks; rows that cross blocks are put
    together from their fragments."""
    starts = block_starts(lines)
    if starts.count() <= BROADCAST_BLOCKS:
        placed = lines.join(F.broadcast(starts), ["path", "block"], "left")
    else:
        placed = (lines.join(starts, ["path", "block"], "left").repartition("path", "block")
                       .sortWithinPartitions("path", "block", "pos"))

    def run(batches):
        at, columns, held, places = None, None, [], []
        tail = header_due = inside = False

        def rows(end: bool):
            # ``tail``: the block began inside a row whose end has not been met.
            nonlocal tail, header_due
            out, begin, cut, state = [], 0, 0, tail
            for k, line in enumerate(held):
                state = ends_inside(line, state)
                if not state:
                    begin, cut, tail = (begin if not tail else k + 1), k + 1, False
            if begin or (tail and end and held):
                last = begin or len(held)
                out.append((*at, places[0], *[None] * len(wanted), "\n".join(held[:last]), False))
                begin, cut = last, max(cut, last)
            for k, fields in _parse(held[begin:cut]):
                if header_due:
                    header_due = False
                elif columns.usable:
                    out.append((*at, places[begin + k], *columns.pick(fields), None, None))
            if cut < len(held):
                # The begin of a row that ends in a later block, or nowhere.
                out.append((*at, places[cut], *[None] * len(wanted), "\n".join(held[cut:]), True))
            held.clear()
            places.clear()
            if out:
                yield _emit(out, len(wanted), True)

        for batch in batches:
            begins, headers = batch.column("inside"), batch.column("header")
            for offset, path, block, numbers, values in _pieces(batch):
                first = at != (path, block)
                if first:
                    if held:
                        yield from rows(True)
                    if not begins[offset].is_valid:
                        raise ValueError(f"{path}: the blocks of the file changed while it was read")
                    if not headers[offset].is_valid:
                        raise ValueError(f"{path}: the header row does not end in the file's first block")
                    at, inside = (path, block), begins[offset].as_py()
                    tail, header_due = inside, block == 0
                    columns = _Columns(path, headers[offset].as_py(), wanted, required)
                if not header_due:
                    # What is left has quotes, lies inside them, or has another
                    # number of fields; between such lines stand whole rows only.
                    plain, _ = _plain_lines(values, columns.width, inside)
                    if plain.any():
                        mask = pa.array(plain)
                        if columns.usable:
                            yield _emit_plain(at, numbers.filter(mask), values.filter(mask), columns, True)
                        numbers, values = numbers.filter(pa.array(~plain)), values.filter(pa.array(~plain))
                numbers, values = numbers.to_pylist(), values.to_pylist()
                if first and block == 0:
                    values[0] = _unmarked(values[0])
                for number, line in zip(numbers, values, strict=True):
                    held.append(line)
                    places.append(number)
                    inside = ends_inside(line, inside)
                    if len(held) >= ROWS_AT_ONCE and not inside:
                        yield from rows(False)
        if held:
            yield from rows(True)

    parsed = stage_table(placed.mapInArrow(run, _kinds(wanted, ", fragment string, opens boolean")), "csv-rows")
    # At most two fragments a block: a row is an opening one and those up to the next.
    in_file = Window.partitionBy("path").orderBy("block", "pos").rowsBetween(Window.unboundedPreceding, 0)
    fragments = parsed.where("fragment is not null").withColumn("row", F.sum(F.col("opens").cast("int")).over(in_file))
    pieces = F.sort_array(F.collect_list(F.struct("block", "pos", "fragment")))
    joined = (fragments.groupBy("path", "row").agg(pieces.alias("pieces"))
                       .select("path", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["pos"].alias("pos"),
                               F.array_join(F.col("pieces")["fragment"], "\n").alias("value")))
    headers = starts.where("block = 0").select("path", "header")

    def whole(batches):
        for batch in batches:
            out = []
            for path, block, pos, value, header in zip(*(batch.column(c).to_pylist() for c in (
                    "path", "block", "pos", "value", "header")), strict=True):
                columns = _Columns(path, header, wanted, required)
                if columns.usable:
                    out += [(path, block, pos, *columns.pick(fields)) for _, fields in _parse(value.split("\n"))]
            if out:
                yield _emit(out, len(wanted), False)

    crossing = joined.join(headers, "path").select("path", "block", "pos", "value", "header").mapInArrow(
        whole, _kinds(wanted))
    return parsed.where("fragment is null").drop("fragment", "opens").unionByName(crossing)


def csv_rows(spark: SparkSession, paths, wanted: list[str], required=(), order_col: str | None = "ord") -> DataFrame:
    """The ``wanted`` columns (text) of all rows of the header CSV files at
    ``paths``, and ``order_col`` (path, block, pos), if named: the order of the
    files' names, and of the rows in a file. A column that a file lacks is null
    there; files that lack a ``required`` column give no rows."""
    wanted, required = list(wanted), list(required)
    ship_package(spark)
    limit = least_cut(spark)
    size = F.col("_metadata.file_size")
    rows = _whole_files(_lines(spark, paths, size <= limit), wanted, required)
    if _has_large(spark, paths, limit):
        rows = rows.unionByName(_cut_files(_lines(spark, paths, size > limit), wanted, required))
    place = [F.struct("path", "block", "pos").alias(order_col)] if order_col else []
    return rows.select(*place, *[F.col(f"c{k}").alias(c) for k, c in enumerate(wanted)])


def first_header(spark: SparkSession, paths) -> list[str]:
    """Column names of the first file that has a row; its first lines are read."""
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    n = 16
    while True:
        head = [_unmarked(r[0]) for r in lines.where(F.trim(F.translate("value", "\t\r\ufeff", "   ")) != "").take(n)]
        inside = False
        for k, line in enumerate(head):
            inside = ends_inside(line, inside)
            if not inside or (k + 1 == len(head) and len(head) < n):
                return column_names(next(_parse(head[:k + 1]), (0, []))[1])
        if not head:
            return []
        n *= 4
