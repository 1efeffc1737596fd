"""What cells hold: numbers without loss, dates and times of both epochs, sheets that are parsed as streams."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.functions import cell_text
from gridloom.sources import grids


def texts(spark, kind, values):
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "i int, v string")
    return [r["t"] for r in df.select("i", cell_text(F.col("v"), F.lit(kind)).alias("t")).orderBy("i").collect()]


def shortest(v):
    return str(int(v)) if v.is_integer() else repr(v)


def test_numbers_are_told_as_python_tells_them(spark):
    values = [1e30, 1e-12, 0.30000000000000004, 12345678.5, 0.0005, 0.00005, 1.5e-300, -2.5e-7, 1e15, -1e22, 123456789012345680.0, 2.0**100, 1e36, -0.0, 1e16, 9007199254740993.0, 0.1, 100.25, 1234567890123.4567]
    assert texts(spark, "n", [repr(v) for v in values]) == [shortest(v) for v in values]


def test_a_number_of_any_size_is_no_failure(spark):
    assert all(t is not None for t in texts(spark, "n", ["1e300", "-1e308", "4.9e-324", "1e999", "NaN", "abc", "1e39"]))
    assert texts(spark, "n", ["abc", "NaN"]) == ["abc", "NaN"]


def test_dates_of_both_epochs(spark):
    assert texts(spark, "d", [1, 59, 61, 46183, 46183.5225578704, 0.5, 0, 2958465]) == ["1900-01-01", "1900-02-28", "1900-03-01", "2026-06-10", "2026-06-10 12:32:29", "12:00:00", "00:00:00", "9999-12-31"]
    assert texts(spark, "d4", [1, 44721, 44721.25, 0.75]) == ["1904-01-02", "2026-06-10", "2026-06-10 06:00:00", "18:00:00"]
    assert texts(spark, "d", [45292.00001, 1e30, -5]) == ["2024-01-01 00:00:00.864000", shortest(1e30), "-5"]


def test_spans_of_time(spark):
    values = [0.5, 1, 1.75, 2.0000116, -0.25, 400]
    told = [str(dt.timedelta(milliseconds=round(v * 86_400_000))) for v in values]
    assert texts(spark, "e", values) == told
    assert texts(spark, "i", ["2024-01-02T03:04:05", "2024-01-02", "x"]) == ["2024-01-02 03:04:05", "2024-01-02", "x"]


@pytest.mark.parametrize(("code", "kind"), [("General", "n"), ("0.00", "n"), ("yyyy\\-mm\\-dd", "d"), ('"day" 0', "n"), ("[Red]0.00", "n"), ("[$-409]d-mmm-yy;@", "d"), ("[h]:mm:ss", "e"), ("mm:ss.0", "d"), ("0.00E+00", "n"), ("#,##0_);[Red](#,##0)", "n"), ("h:mm AM/PM", "d"), ("_d0", "n"), ("\\d0", "n"), ("@", "n"), ("0;yyyy", "n")])
def test_kinds_of_number_formats(code, kind):
    assert grids.format_kind(code) == kind


def book(sheet, styles="", props="", shared=None):
    out = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
        z.writestr("xl/workbook.xml", f'<workbook {main}>{props}<sheets><sheet name="T" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
        if shared is not None:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{t}</t></si>' for t in shared)}</sst>")
    return out.getvalue()


def decoded(spark, *contents):
    files = spark.createDataFrame([(f"f{i}", bytearray(c)) for i, c in enumerate(contents)], "file_name string, content binary")
    return grids.decode_grids(files)


STYLES = '<numFmts><numFmt numFmtId="164" formatCode="dd/mm/yyyy hh:mm"/><numFmt numFmtId="165" formatCode="[hh]:mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="21"/><xf numFmtId="2"/></cellXfs>'
DATES = '<row r="3"><c r="B3" s="1"><v>45292</v></c><c r="C3" s="2"><v>45292.5</v></c><c r="D3" s="3"><v>1.5</v></c><c r="E3" s="4"><v>0.25</v></c><c r="F3" s="5"><v>45292</v></c><c r="G3"><v>1e30</v></c><c r="H3" t="d"><v>2024-01-01T01:02:03</v></c></row>'


def test_styled_cells_of_a_workbook(spark):
    grid = grids.text_grid(decoded(spark, book(DATES, STYLES), book(DATES, STYLES, '<workbookPr date1904="true"/>')))
    told = {r["file_name"]: (r["row_idx"], r["cells"]) for r in grid.collect()}
    assert told["f0"] == (0, ["2024-01-01", "2024-01-01 12:00:00", "1 day, 12:00:00", "06:00:00", "45292", shortest(1e30), "2024-01-01 01:02:03"])
    assert told["f1"][1][:2] == ["2028-01-02", "2028-01-02 12:00:00"]


def test_gaps_corners_and_shared_texts(spark):
    shared = [f"t{i}" for i in range(2500)]
    sheet = '<row r="4"><c r="C4" t="s"><v>2400</v></c></row><row r="6"><c r="B6" t="s"><v>7</v></c><c r="D6" t="b"><v>1</v></c><c r="E6"/></row>'
    grid = grids.text_grid(decoded(spark, book(sheet, shared=shared)))
    assert [(r["row_idx"], r["cells"]) for r in grid.orderBy("row_idx").collect()] == [(0, [None, "t2400"]), (1, []), (2, ["t7", None, "true"])]


def test_a_workbook_that_breaks_off_gives_no_rows(spark):
    broken = book("".join(f'<row r="{i}"><c><v>{i}</v></c></row>' for i in range(1, 6000)) + "<row")
    lost = book('<row r="1"><c t="s"><v>9</v></c></row>', shared=["a"])
    raw = decoded(spark, broken, lost, b"no workbook", book(""))
    assert grids.text_grid(raw).count() == 0
    assert sorted(r["file_name"] for r in grids.unreadable(raw).collect()) == ["f0", "f1", "f2"]


def test_sheets_are_parsed_once(monkeypatch):
    opened, own = [], zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, **b: (opened.append(name), own(self, name, *a, **b))[1])
    content = book('<row r="2"><c r="B2"><v>1<x/>no</v><v>2</v></c><c><f>1+1</f></c><x><c><v>3</v></c></x></row><row/><row><c r="A4" t="inlineStr"><is><t>a<b>no</b></t><r><t>&amp;</t></r></is></c></row>')
    opened.clear()
    assert [(tab, list(rows)) for tab, rows in grids.workbook(content)] == [("T", [(0, [None, ("n", "1")]), (1, []), (2, [("s", "a&")])])]
    assert opened.count("xl/worksheets/s.xml") == 1


def test_workbooks_are_dealt_over_the_cores(spark):
    grid = spark.range(400).select(F.lit("f").alias("file_name"), F.lit("T").alias("sheet_tab_name"), F.col("id").alias("row_idx"), F.array(F.col("id").cast("string")).alias("cells"))
    books = grids.encode_grids(grid, 10).select(F.spark_partition_id().alias("task")).collect()
    assert len(books) == 40 and len({b["task"] for b in books}) > 8


def test_nulls_in_arrays_of_cells(spark):
    kinds = "file_name string, sheet_tab_name string, row_idx bigint, cells array<struct<kind:string,value:string>>"
    told = [("f", "T", 0, [("n", "1"), None, ("s", None), ("b", "1")]), ("f", "T", 1, None), ("f", "T", 2, [("e", "1.5"), ("s", "<&>")])]
    grid = grids.text_grid(grids.decode_grids(grids.encode_grids(spark.createDataFrame(told, kinds))))
    assert [(r["row_idx"], r["cells"]) for r in grid.orderBy("row_idx").collect()] == [(0, ["1", None, None, "true"]), (1, []), (2, ["1 day, 12:00:00", "<&>"])]


def test_memory_does_not_grow_with_rows():
    """Ten times the rows through the decoder, whose peak hardly moves: what is parsed is dropped."""
    import multiprocessing

    with multiprocessing.get_context("spawn").Pool(1, maxtasksperchild=1) as pool:
        small, large = pool.apply(_peak, (5_000,)), pool.apply(_peak, (50_000,))
    assert large < small + 2_000


def _peak(n):
    """KB that decoding n rows adds beyond the packed file and the making of it."""
    import tracemalloc

    content = book("".join(f'<row r="{i}"><c t="inlineStr"><is><t>value {i % 10}</t></is></c><c><v>{i % 7}</v></c></row>' for i in range(1, n + 1)))
    tracemalloc.start()
    assert sum(1 for _, rows in grids.workbook(content) for _ in rows) == n
    return tracemalloc.get_traced_memory()[1] // 1024


def test_one_folder_is_listed(spark, tmp_path):
    for name in ("a.xlsx", "B.XLSX", "c.txt", "sub/d.xlsx", "[odd]/e.xlsx"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    names = lambda df: sorted(r["file_name"] for r in df.select("file_name").collect())
    assert names(grids.landing(spark, str(tmp_path))) == ["B.XLSX", "a.xlsx"]
    assert names(grids.landing(spark, str(tmp_path), recursive=True)) == ["B.XLSX", "a.xlsx", "d.xlsx", "e.xlsx"]
    assert names(grids.landing(spark, str(tmp_path / "[odd]"))) == ["e.xlsx"]
    assert names(grids.landing(spark, str(tmp_path / "c.txt"))) == ["c.txt"]
    assert names(grids.landing(spark, str(tmp_path / "sub"), ".csv")) == []


def test_only_the_newest_folders_are_listed(spark, tmp_path):
    for name in ("2023/12/31/00/x", "2024/01/05/23/x", "2024/02/01/07/x", "2024/02/01/06/x", "2024/01/30/01/x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    (tmp_path / "2025").mkdir()
    seen = []
    assert grids.newest_folder(spark, str(tmp_path), "minutely", seen) == str(tmp_path / "2024/02/01/07")
    assert len(seen) == 6 and not any("2023" in s or "2024/01" in s for s in seen)
    assert grids.newest_folder(spark, str(tmp_path), "monthly") == str(tmp_path / "2024")
    assert grids.newest_folder(spark, str(tmp_path / "2025")) == str(tmp_path / "2025")
