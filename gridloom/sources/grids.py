"""Landing files, grids of cells, headers.

A grid has a row for each row of a sheet: file_name, sheet_tab_name, row_idx (from 0) and cells, an array of texts. All
files and tabs of a run are one DataFrame.
"""

from __future__ import annotations

import functools
import io
import itertools
import marshal
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import cell_text, header_names

GRID = "file_name string, sheet_tab_name string, row_idx bigint, cells array<string>"
RAW = "file_name string, sheet_tab_name string, row_idx bigint, cells array<struct<kind:string,value:string>>, error string"
_RAW = pa.schema([("file_name", pa.string()), ("sheet_tab_name", pa.string()), ("row_idx", pa.int64()), ("cells", pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))), ("error", pa.string())])
HEADER_ROW, DATA_ROW = 1, 2
NO_RESULTS = "report status"
#: How many levels of dated folders count, by frequency.
DEPTH = {"monthly": 1, "daily": 2, "hourly": 3, "minutely": 4, "minutes": 4}
#: Rows of a sheet that one workbook takes at most; a longer sheet goes into more of them.
BOOK_ROWS = 100_000
#: Rows that a decoder hands on at a time, and blocks of a thousand shared texts that it holds unpacked.
BATCH_ROWS, SHARED_BLOCKS = 2000, 64
#: Tasks for each core, at least, into which workbooks are dealt.
TASKS_PER_CORE = 8


def any_case(suffix: str) -> str:
    """A glob for names with a suffix, whatever its case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def landing(spark: SparkSession, folder: str, suffix: str = ".xlsx", recursive: bool = False) -> DataFrame:
    """The files of one folder whose name ends in the suffix, whatever its case: file_name, path, length, content.

    folder may also be one file, whatever its name. Names are matched on listing, so other files are never opened, and
    folders below aren't listed unless recursive. A folder without such files gives no rows; one that isn't there raises.
    """
    files = spark.read.format("binaryFile")
    plain = re.sub(r"([{}\[\]*?\\])", r"\\\1", folder.rstrip("/"))
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(at).isFile():
        files = files.load(plain)
    elif recursive:
        files = files.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{any_case(suffix)}").load(plain)
    else:
        wanted = f"{plain}/*{any_case(suffix)}"
        there = any(s.isFile() for s in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(wanted)))
        files = files.load(wanted) if there else spark.createDataFrame([], "path string, length long, content binary")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length", "content")


def newest_folder(spark: SparkSession, base: str, frequency: str = "hourly", seen: list[str] | None = None) -> str:
    """The newest dated folder below base: of its levels, as many as the frequency has, always the greatest name.

    Goes down the greatest names through the file system, one listing for each level; other years and months are neither
    listed nor scanned. An empty folder is passed over for the one before it. Nothing below base: base itself. seen: takes
    the folders that were listed.
    """
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def down(at: str, level: int) -> str | None:
        if seen is not None:
            seen.append(at)
        found = list(system.listStatus(jvm.org.apache.hadoop.fs.Path(at)))
        if level:
            for name in sorted((s.getPath().getName() for s in found if s.isDirectory()), key=lambda n: n + "/", reverse=True):
                if below := down(f"{at}/{name}", level - 1):
                    return below
        return at if found else None

    return down(base.rstrip("/"), DEPTH.get(frequency.lower(), 2)) or base.rstrip("/")


def latest_partition(df: DataFrame, columns: list[str], frequency: str | None = None) -> DataFrame:
    """The rows of the greatest partition, in the order of the columns. A scalar, so that only that partition is read.

    frequency: only as many of the columns count as its folders are deep (an unknown one: two); else all do.
    """
    columns = columns if frequency is None else columns[: DEPTH.get(frequency.lower(), 2)]
    newest = df.agg(F.max(F.struct(*columns)).alias("m")).first()["m"]
    if newest is None:
        return df.limit(0)
    for c in columns:
        df = df.where(F.col(c) == F.lit(newest[c]))
    return df


def decode_grids(files: DataFrame) -> DataFrame:
    """The grids of files (file_name, content), one file in a task at a time, and what can't be read as a row with error.

    Cells keep their kind; leading empty rows and columns are skipped, the order of tabs is the workbook's. first_row, if
    the files have that column, is the place of a workbook's first row in its sheet. Sheets are parsed as streams, once;
    their rows are kept packed until it is known where they begin and that they can be read to their end, then handed on
    a few thousand at a time: a task's memory grows with the packed file, not with the rows in it.
    """
    placed = files if "first_row" in files.columns else files.withColumn("first_row", F.lit(0))

    def batch(name: str, tab: str, places: list[int], rows: list[list]) -> pa.RecordBatch:
        cells = [c for row in rows for c in row]
        ends = pa.array(itertools.accumulate(map(len, rows), initial=0), pa.int32())
        kinds, values = (pa.array((c and c[i] for c in cells), pa.string()) for i in (0, 1))
        listed = _RAW.field("cells").type
        told = pa.StructArray.from_arrays([kinds, values], fields=list(listed.value_type), mask=pa.array([c is None for c in cells], pa.bool_()))
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([tab] * n, pa.string()), pa.array(places, pa.int64()), pa.ListArray.from_arrays(ends, told, type=listed), pa.nulls(n, pa.string())], schema=_RAW)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for i in range(files.num_rows):
                name, content, first = (files.column(c)[i].as_py() for c in range(3))
                try:
                    for tab, rows in workbook(content):
                        while some := list(itertools.islice(rows, BATCH_ROWS)):
                            yield batch(name, tab, [first + at for at, _ in some], [cells for _, cells in some])
                except UNREADABLE as e:
                    yield pa.RecordBatch.from_pylist([{"file_name": name, "error": f"Workbook could not be read - {e}"}], schema=_RAW)

    return placed.select("file_name", "content", F.col("first_row").cast("long").alias("first_row")).mapInArrow(decode, RAW)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ROW, _CELL, _VALUE, _TEXT = (f"{_MAIN}{tag}" for tag in ("row", "c", "v", "t"))
UNREADABLE = (zipfile.BadZipFile, KeyError, IndexError, ElementTree.ParseError, ValueError, zlib.error, EOFError, NotImplementedError, RuntimeError)
# The numbers of built-in formats that are dates or times, and of the one that is a span of time.
DATE_FORMATS, ELAPSED_FORMAT = (*range(14, 23), 45, 47), 46


def format_kind(code: str) -> str:
    """What a number format makes of a number, by its first section: `d` date or time, `e` elapsed time, `n` number."""
    shown = re.sub(r'"[^"]*"?|\\.|_.|\*.', "", code).split(";")[0]
    if re.search(r"\[(h+|m+|s+)\]", shown, re.IGNORECASE):
        return "e"
    return "d" if re.search(r"[dmyhs]", re.sub(r"\[[^\]]*\]|general", "", shown, flags=re.IGNORECASE), re.IGNORECASE) else "n"


def _styles(z: zipfile.ZipFile) -> list[str]:
    """The kind of a number for each cell style of a workbook."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId", -1)): format_kind(f.get("formatCode", "")) for f in root.iterfind(f"{_MAIN}numFmts/{_MAIN}numFmt")}
    built_in = dict.fromkeys(DATE_FORMATS, "d") | {ELAPSED_FORMAT: "e"}
    return [(built_in | own).get(int(x.get("numFmtId", 0)), "n") for x in root.iterfind(f"{_MAIN}cellXfs/{_MAIN}xf")]


class _SharedStrings:
    """A workbook's shared texts, packed a thousand at a time; no text has a NUL."""

    def __init__(self, z: zipfile.ZipFile):
        self.packed: list[bytes] = []
        self.unpacked = functools.lru_cache(SHARED_BLOCKS)(lambda k: zlib.decompress(self.packed[k]).decode("utf-8", "surrogatepass").split("\0"))
        block: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for item in _elements(z, "xl/sharedStrings.xml", f"{_MAIN}si"):
                block.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
                if len(block) == 1000:
                    self._pack(block)
                    block = []
        self._pack(block)

    def _pack(self, block: list[str]) -> None:
        self.packed.append(zlib.compress("\0".join(block).encode("utf-8", "surrogatepass"), 1))

    def __getitem__(self, i: int) -> str:
        if not 0 <= i < 1000 * len(self.packed):
            raise IndexError(f"no shared text {i}")
        return self.unpacked(i // 1000)[i % 1000]


def _elements(z: zipfile.ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """The elements of a tag below the root or below one of its children, each dropped when the next is asked for."""
    path: list[ElementTree.Element] = []
    with z.open(name) as stream:
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                path.append(element)
                continue
            path.pop()
            if element.tag == tag:
                yield element
                path[-1].clear()


def workbook(content: bytes) -> Iterator[tuple[str, Iterator[tuple[int, list[tuple[str, str] | None]]]]]:
    """(tab, rows) of a workbook's tabs in order; rows are (place, cells), from the first row and column that hold something.

    Cells are (kind, text), or None. All sheets are parsed before the first row is given, so a workbook that breaks off
    gives none.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        parse = lambda name: ElementTree.fromstring(z.read(name))
        shared, styles, book = _SharedStrings(z), _styles(z), parse("xl/workbook.xml")
        later = book.find(f"{_MAIN}workbookPr")
        if later is not None and later.get("date1904", "0").lower() in ("1", "true"):
            styles = ["d4" if kind == "d" else kind for kind in styles]
        targets = {r.get("Id"): r.get("Target", "").lstrip("/").removeprefix("xl/") for r in parse("xl/_rels/workbook.xml.rels")}
        sheets = [(s.get("name", ""), "xl/" + targets[s.get(_REL)]) for s in book.iterfind(f"{_MAIN}sheets/{_MAIN}sheet")]
        parsed = []
        for tab, part in sheets:
            packed, top, left, rows = [], None, 0, _sheet_rows(z, part, shared, styles)
            while some := list(itertools.islice(rows, BATCH_ROWS)):
                top = min(some[0][0] if top is None else top, *(at for at, _ in some))
                left = min(left if packed else min(some[0][1]), *(c for _, row in some for c in row))
                packed.append(zlib.compress(marshal.dumps(some), 1))
            if packed:
                parsed.append((tab, packed, top, left))
    for tab, packed, top, left in parsed:
        yield tab, _placed((row for block in packed for row in marshal.loads(zlib.decompress(block))), top, left)


def _placed(rows: Iterator[tuple[int, dict[int, tuple]]], top: int, left: int) -> Iterator[tuple[int, list[tuple | None]]]:
    """Rows with their cells in a list; rows that are missing in between are empty."""
    expected = top
    for at, row in rows:
        yield from ((i - top, []) for i in range(expected, at))
        yield at - top, [row.get(c) for c in range(left, max(row) + 1)]
        expected = max(expected, at + 1)


@functools.lru_cache(20_000)
def _column(letters: str) -> int:
    return functools.reduce(lambda n, x: 26 * n + ord(x) - ord("A") + 1, letters.upper(), 0) - 1


class _Rows:
    """Takes a sheet's elements as they are parsed; found: (place, cells by column) of rows that hold something.

    Elements are told apart by tag and depth: cells are children of a row, values are children of a cell, and a value is
    the text before an element within it.
    """

    def __init__(self, shared: _SharedStrings, styles: list[str]):
        self.shared, self.styles, self.found = shared, styles, []
        self.depth, self.row_depth, self.after, self.at, self.column = 0, -9, 0, 0, -1
        self.row: dict[int, tuple] = {}
        self.kind, self.style, self.in_cell = "n", "0", False
        self.value: list[str] | None = None
        self.texts: list[str] = []
        self.into: list[str] | None = None

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        self.depth += 1
        self.into = None
        if self.in_cell:
            if tag == _VALUE and self.value is None and self.depth == self.row_depth + 2:
                self.into = self.value = []
            elif tag == _TEXT:
                self.into = self.texts
        elif tag == _ROW:
            self.at = int(attributes.get("r", self.after + 1)) - 1
            self.after, self.row, self.column, self.row_depth = self.at + 1, {}, -1, self.depth
        elif tag == _CELL and self.depth == self.row_depth + 1:
            letters, self.column = attributes.get("r", "").rstrip("0123456789"), self.column + 1
            if letters:
                self.column = _column(letters)
            self.kind, self.style, self.in_cell = attributes.get("t", "n"), attributes.get("s", "0"), True
            self.value, self.texts = None, []

    def data(self, text: str) -> None:
        if self.into is not None:
            self.into.append(text)

    def end(self, tag: str) -> None:
        self.into = None
        if self.depth == self.row_depth + 1 and self.in_cell:
            self.in_cell = False
            self._cell("".join(self.value or ()))
        elif self.depth == self.row_depth:
            self.row_depth = -9
            if self.row:
                self.found.append((self.at, self.row))
        self.depth -= 1

    def _cell(self, value: str) -> None:
        if self.kind == "inlineStr":
            self.row[self.column] = ("s", "".join(self.texts))
        elif value:
            if self.kind == "n":
                style = int(self.style)
                self.row[self.column] = (self.styles[style] if style < len(self.styles) else "n", value)
            elif self.kind == "s":
                self.row[self.column] = ("s", self.shared[int(value)])
            else:
                self.row[self.column] = ({"b": "b", "d": "i"}.get(self.kind, "s"), value)


def _sheet_rows(z: zipfile.ZipFile, part: str, shared: _SharedStrings, styles: list[str]) -> Iterator[tuple[int, dict[int, tuple]]]:
    """(place, cells by column) of a sheet's rows that hold something, in the order of the file; cells are (kind, text)."""
    rows = _Rows(shared, styles)
    parser = ElementTree.XMLParser(target=rows)
    with z.open(part) as stream:
        while chunk := stream.read(1 << 16):
            parser.feed(chunk)
            yield from rows.found
            rows.found.clear()
    parser.close()
    yield from rows.found


#: The number formats that a workbook of ours has, by the kind of cell that they make.
OWN_FORMATS = {"d": 22, "e": ELAPSED_FORMAT}


def encode_grids(grid: DataFrame, book_rows: int = BOOK_ROWS) -> DataFrame:
    """Workbooks (file_name, first_row, content) of grids: the inverse of decode_grids.

    Cells are texts, or structs of kind and value as decode_grids gives them. Each workbook has one tab, and of that
    `book_rows` rows at most, so no task gets more of a long sheet. Dates of a workbook are all of one epoch: if any cell
    is of kind `d4`, that of 1904.
    """

    def encode(rows: pa.Table) -> pa.Table:
        esc = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
        main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        styles, epochs = ["n", *OWN_FORMATS], set()
        begin = {k: f'<c s="{styles.index(k.rstrip("4"))}"><v>' for k in ("n", "d", "d4", "e")}

        def cell(kind: str, value: str | None) -> str:
            if value is None:
                return "<c/>"
            if kind in begin:
                return f"{begin[kind]}{value}</v></c>"
            if kind in ("b", "i"):
                return f'<c t="{"b" if kind == "b" else "d"}"><v>{esc(value)}</v></c>'
            return f'<c t="inlineStr"><is><t xml:space="preserve">{esc(value)}</t></is></c>'

        def body(own: pa.Table) -> str:
            lists = own["cells"].combine_chunks()
            flat, n = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            kinds, values = map(pa.Array.to_pylist, flat.flatten()) if pa.types.is_struct(flat.type) else (itertools.repeat("s"), flat.to_pylist())
            kinds = list(itertools.islice(kinds, len(values)))
            epochs.update(kinds)
            cells = map(cell, kinds, values)
            return "".join(f'<row r="{at - first + 1}">{"".join(itertools.islice(cells, k))}</row>' for at, k in zip(own["row_idx"].to_pylist(), n, strict=True))

        tabs, first = sorted(rows["sheet_tab_name"].unique().to_pylist()), rows["_part"][0].as_py() * book_rows
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for i, tab in enumerate(tabs):
                own = rows.filter(pc.equal(rows["sheet_tab_name"], tab)).sort_by("row_idx")
                z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body(own)}</sheetData></worksheet>")
            sheets = "".join(f'<sheet name="{esc(t)}" sheetId="{i + 1}" r:id="r{i}"/>' for i, t in enumerate(tabs))
            epoch = '<workbookPr date1904="1"/>' if "d4" in epochs else ""
            z.writestr("xl/workbook.xml", f"<workbook {main}>{epoch}<sheets>{sheets}</sheets></workbook>")
            formats = "".join(f'<xf numFmtId="{OWN_FORMATS.get(k, 0)}"/>' for k in styles)
            z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs count="{len(styles)}">{formats}</cellXfs></styleSheet>')
            rels = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(tabs)))
            z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        return pa.table({"file_name": [rows["file_name"][0].as_py()], "first_row": pa.array([first], pa.int64()), "content": pa.array([out.getvalue()], pa.binary())})

    spark, by = grid.sparkSession, ["file_name", "sheet_tab_name", "_part"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    parted = grid.withColumn("_part", F.floor(F.col("row_idx") / book_rows)).repartition(tasks, *by)
    return parted.groupBy(*by).applyInArrow(encode, "file_name string, first_row long, content binary")


def text_grid(raw: DataFrame) -> DataFrame:
    """A decoded grid with its cells as texts."""
    return raw.where("error is null").select("file_name", "sheet_tab_name", "row_idx", F.transform("cells", lambda c: cell_text(c["value"], c["kind"])).alias("cells"))


def unreadable(raw: DataFrame) -> DataFrame:
    return raw.where("error is not null").select("file_name", "error")


def headers(grid: DataFrame, header_row: int = HEADER_ROW) -> DataFrame:
    """(file_name, sheet_tab_name, header): the column names of every tab that has a header row."""
    return grid.where(F.col("row_idx") == header_row).select("file_name", "sheet_tab_name", header_names(F.col("cells")).alias("header"), F.col("cells").alias("_cells"))


def no_results(cells: Column) -> Column:
    """Whether a header is the sole cell that says there is no report."""
    told = F.filter(cells, lambda c: F.coalesce(F.trim(c), F.lit("")) != "")
    return (F.size(told) == 1) & (F.lower(F.trim(told[0])) == NO_RESULTS)


def tab_counts(grid: DataFrame, header_row: int = HEADER_ROW, data_row: int = DATA_ROW) -> DataFrame:
    """(file_name, sheet_tab_name, n_rows, no_data): data rows of every tab; none under a header that says so."""
    is_header = F.col("row_idx") == header_row
    counts = grid.groupBy("file_name", "sheet_tab_name").agg(F.count_if(F.col("row_idx") >= data_row).alias("n"), F.max("row_idx").alias("last"), F.coalesce(F.bool_or(F.when(is_header, no_results(F.col("cells")))), F.lit(False)).alias("empty"))
    void = F.col("empty") | (F.col("last") < header_row) | (F.col("n") == 0)
    return counts.select("file_name", "sheet_tab_name", F.when(void, 0).otherwise(F.col("n")).alias("n_rows"), void.alias("no_data"))


def promoted(grid: DataFrame, header_row: int = HEADER_ROW, data_row: int = DATA_ROW) -> DataFrame:
    """(file_name, sheet_tab_name, row_idx, header, values): data rows padded or cut to their tab's header.

    Rows meet their header in a join whose small side has a row for each tab.
    """
    head = headers(grid, header_row).where(~no_results(F.col("_cells"))).drop("_cells")
    rows = grid.where(F.col("row_idx") >= data_row).join(head, ["file_name", "sheet_tab_name"])
    values = F.transform("header", lambda _, i: F.get("cells", i))
    return rows.select("file_name", "sheet_tab_name", "row_idx", "header", values.alias("values"))


def wide(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Promoted rows of tabs with the same columns as a wide table of texts."""
    record = F.map_from_arrays("header", "values")
    return rows.withColumn("_r", record).select("file_name", "sheet_tab_name", *[F.col("_r").getItem(c).alias(c) for c in columns])
