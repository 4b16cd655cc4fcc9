import io
import zipfile

import pytest
from pyspark.errors import PySparkException

from tessera.sources import archives

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(sheets, strings=(), active=0, date1904=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><workbookPr date1904="{int(date1904)}"/><bookViews><workbookView activeTab="{active}"/></bookViews><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i == 2 else ""}worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(strings)}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="164" formatCode="yyyy-mm-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;day&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        for i, (_, rows) in enumerate(sheets, 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


HEAD = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t> b </t></is></c><c r="C1" t="str"><v>c</v></c></row>'
STRINGS = ["<si><t>이름</t></si>", "<si><r><t>rich</t></r><r><t xml:space='preserve'> text</t></r><rPh><t>guide</t></rPh></si>"]


def test_workbooks_of_different_columns(spark, tmp_path):
    rows = HEAD + '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2" s="1"><v>45292</v></c></row><row r="4"><c r="A4"><v>12.0</v></c><c r="B4" t="b"><v>1</v></c><c r="C4" s="4"><v>45292.5</v></c></row><row r="5"><c r="A5" s="3"><v>1.5</v></c><c r="B5" t="e"><v>#N/A</v></c><c r="C5" s="2"><v>45293</v></c></row>'
    other = '<row><c t="inlineStr"><is><t>x</t></is></c></row><row><c><v>7</v></c></row>'
    (tmp_path / "one.xlsx").write_bytes(workbook([("first", rows), ("second", other)], STRINGS))
    (tmp_path / "two.xlsx").write_bytes(workbook([("first", rows), ("second", other)], STRINGS, active=1, date1904=True))
    got = {(r.path.rsplit("/")[-1], r.member, r.row): dict(r["values"]) for r in archives.read_workbooks(spark, str(tmp_path)).collect()}
    assert got == {
        ("one.xlsx", "first", 2): {"이름": "rich text", "b": None, "c": "2024-01-01"},
        ("one.xlsx", "first", 4): {"이름": "12", "b": "TRUE", "c": "2024-01-01 12:00:00"},
        ("one.xlsx", "first", 5): {"이름": "1.5", "b": None, "c": "2024-01-02"},
        ("two.xlsx", "second", 2): {"x": "7"},
    }
    assert archives.read_workbooks(spark, str(tmp_path), "second").count() == 2
    assert {r["values"]["c"] for r in archives.read_workbooks(spark, f"{tmp_path}/two.xlsx", "first").collect()} == {"2028-01-02", "2028-01-02 12:00:00", "2028-01-03"}


@pytest.mark.parametrize("content", [b"no archive", workbook([("s", "")]), workbook([("s", HEAD.replace("c</v>", " b</v>"))], STRINGS), workbook([("s", HEAD + '<row r="2"><c r="E2"><v>1</v></c></row>')], STRINGS)])
def test_faulty_workbooks_fail(spark, tmp_path, content):
    (tmp_path / "bad.xlsx").write_bytes(content)
    with pytest.raises(PySparkException, match=r"bad.xlsx|wider than the header"):
        archives.read_workbooks(spark, str(tmp_path)).collect()


def test_legal_districts_in_and_out_of_archives(spark, tmp_path):
    text = "법정동코드\t법정동명\t폐지여부\r\n2611010100\t부산 중구 영주동\t존재\r\n2611010200\t옛 동\t폐지\r\n1111010100\t서울\t존재\r\n\r\n2614010100\t서구 동대신동\t\r\n"
    with zipfile.ZipFile(tmp_path / "dong.zip", "w") as z:
        z.writestr("readme.md", "x")
        z.writestr("folder/dong.TXT", text.encode("cp949"))
        z.writestr("later.csv", "a,b\n1,2\n")
    (tmp_path / "more.csv").write_text('code,name,status\n2617010100,"동구, 초량동",\n26x,bad,\n', encoding="utf-8-sig")
    got = {tuple(r) for r in archives.legal_districts(spark, str(tmp_path)).collect()}
    assert got == {("2611010100", "부산 중구 영주동"), ("2614010100", "서구 동대신동"), ("2617010100", "동구, 초량동")}
    assert {r.member for r in archives.read_text_archives(spark, f"{tmp_path}/dong.zip").collect()} == {"folder/dong.TXT"}
