import io
import zipfile
from datetime import date, datetime

import pytest

from crateflow.catalog.workbooks import encode_workbook
from crateflow.contracts import ROW_SEQ
from crateflow.sources.workbook import decode_workbooks, scan_workbooks


def test_all_cell_kinds_become_strings(spark, tmp_path):
    rows = [
        ("PRD1", 1000000, 2.5, date(2024, 1, 5), datetime(2024, 1, 5, 6, 30), True, None),
        (" Ăn & <b> ", -3, 1e-7, date(1999, 12, 31), datetime(2024, 1, 5), False, "x"),
    ]
    (tmp_path / "a.xlsx").write_bytes(encode_workbook(list("abcdefg"), rows))
    df = scan_workbooks(spark, str(tmp_path / "a.xlsx"), row_seq=True).orderBy(ROW_SEQ)
    assert [tuple(r)[:7] for r in df.collect()] == [
        ("PRD1", "1000000", "2.5", "2024-01-05", "2024-01-05 06:30:00", "true", None),
        (" Ăn & <b> ", "-3", "1e-07", "1999-12-31", "2024-01-05", "false", "x"),
    ]
    assert {t for _, t in df.drop(ROW_SEQ).dtypes} == {"string"}


def test_folder_of_workbooks_with_different_columns(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(encode_workbook(["id", "x"], [(1, "p")]))
    (tmp_path / "b.xlsx").write_bytes(encode_workbook(["y", "id"], [("q", 2), ("r", 3)]))
    df = scan_workbooks(spark, str(tmp_path))
    assert df.columns == ["id", "x", "y"]
    assert sorted(df.collect()) == [("1", "p", None), ("2", None, "q"), ("3", None, "r")]


def test_each_workbook_is_decoded_once(spark, tmp_path):
    heads = [["id", "x"], ["x", "id"], ["id", "x"], []]
    for k, head in enumerate(heads):
        (tmp_path / f"{k}.xlsx").write_bytes(encode_workbook(head, [(k, f"v{k}")] if head else []))
    (tmp_path / "4.xlsx").write_bytes(encode_workbook(["id", "x", "late"], [(4, None, "z"), (None, "only", None)]))
    df = scan_workbooks(spark, str(tmp_path), row_seq=True)
    assert "MapInPandas" not in df._jdf.queryExecution().toString()
    assert df.columns == ["id", "x", "late", ROW_SEQ]
    assert sorted((tuple(r)[:3] for r in df.collect()), key=str) == sorted(
        [("0", "v0", None), ("v1", "1", None), ("2", "v2", None), ("4", None, "z"), (None, "only", None)], key=str
    )
    assert df.select(ROW_SEQ).distinct().count() == 5


def test_a_required_column_missing_from_one_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(encode_workbook(["id", "x"], [(1, 2)]))
    (tmp_path / "b.xlsx").write_bytes(encode_workbook(["id"], [(1,)]))
    with pytest.raises(ValueError, match="not in every workbook: x"):
        scan_workbooks(spark, str(tmp_path), required=("id", "x"))


def test_shared_strings_sparse_cells_and_first_sheet(spark):
    ns = "http://schemas.openxmlformats.org"
    main = f'xmlns="{ns}/spreadsheetml/2006/main"'
    rel = f"{ns}/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="one" r:id="rId7"/>'
        '<sheet name="two" r:id="rId8"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{ns}/package/2006/relationships">'
        '<Relationship Id="rId8" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId7" Target="/xl/worksheets/sheet9.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}><si><t>id</t></si><si><r><t>no</t></r><r><t>te</t></r>"
        "</si><si><t>last</t></si></sst>",
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData/></worksheet>",
        "xl/worksheets/sheet9.xml": f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v>'
        '</c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row><row r="2"/><row r="3">'
        '<c r="A3"><v>7</v></c><c r="C3" t="str"><v>z</v></c></row>'
        '<row r="4"><c r="B4" t="e"><v>#N/A</v></c><c r="C4"><v>0.25</v></c></row>'
        "</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    files = spark.createDataFrame([("a", bytearray(out.getvalue()))], "path string, content binary")
    df = decode_workbooks(files)
    assert df.columns == ["id", "note", "last"]
    assert sorted(df.collect(), key=str) == [("7", None, "z"), (None, None, "0.25")]


def test_many_rows_cross_batches_in_order(spark, tmp_path):
    rows = [(i, f"name {i}") for i in range(12_345)]
    (tmp_path / "a.xlsx").write_bytes(encode_workbook(["id", "name"], rows))
    df = scan_workbooks(spark, str(tmp_path), row_seq=True)
    got = df.orderBy(ROW_SEQ).select("id").collect()
    assert [int(r["id"]) for r in got] == list(range(12_345))


def test_missing_workbook(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_workbooks(spark, str(tmp_path / "none.xlsx"))
