"""Spreadsheet files written by hand with zipfile."""

import zipfile
from datetime import date
from decimal import Decimal

import pytest
from dealscope.operators import staging
from dealscope.schemas import SHOWING, SUPPORT
from dealscope.sources.workbook import read_workbooks

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def write_book(path, sheets, shared=()):
    """``sheets`` maps a name to the XML of its rows."""
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f"<workbook {MAIN} {REL}><sheets>{names}</sheets></workbook>")
        links = "".join(
            f'<Relationship Id="rId{i}" Type="worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels",
                      '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                      f"{links}</Relationships>")
        if shared:
            strings = "".join(f"<si>{s}</si>" for s in shared)
            book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml",
                          f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")


def inline(reference, text):
    return f'<c r="{reference}" t="inlineStr"><is><t>{text}</t></is></c>'


COLUMNS = {"record_id": "№", "agent_id": "Агент", "shown_at": "Дата показа", "score": "Оценка"}


def test_two_files_shared_and_inline_strings(spark, tmp_path):
    write_book(tmp_path / "one.xlsx", {
        "Прочее": f'<row r="1">{inline("A1", "x")}</row>',
        "Показы": (
            '<row r="1"/>'
            '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c><c r="D2" t="s"><v>2</v></c>'
            '<c r="AA2" t="s"><v>3</v></c></row>'
            '<row r="3"><c r="A3"><v>1</v></c><c r="B3"><v>7</v></c><c r="D3"><v>45292</v></c>'
            f'{inline("AA3", "1 234,50")}</row>'
            f'<row r="4">{inline("A4", " ")}</row>'
            '<row r="6"><c r="A6"><v>2</v></c><c r="B6"><v>8</v></c><c r="AA6" t="s"><v>4</v></c></row>'
        )},
        ["<t>№</t>", "<r><t>Аге</t></r><r><t>нт</t></r><rPh><t>hint</t></rPh>", "<t>Дата показа</t>", "<t>Оценка</t>",
         "<t>плохо</t>"])
    write_book(tmp_path / "two.xlsx", {"Показы": (
        f'<row>{inline("A1", "Оценка")}{inline("B1", "№")}</row>'
        f'<row>{inline("A2", "5")}{inline("B2", "3")}</row>')})
    (tmp_path / "notes.txt").write_text("not a workbook")

    raw = read_workbooks(spark, str(tmp_path), "Показы", COLUMNS, lenient=True)
    got = {(r._path.rsplit("/", 1)[1], r._row): (r.record_id, r.agent_id, r.shown_at, r.score) for r in raw.collect()}
    assert got == {
        ("one.xlsx", 3): ("1", "7", "45292", "1 234,50"),
        ("one.xlsx", 6): ("2", "8", None, "плохо"),
        ("two.xlsx", 2): ("3", None, None, "5"),
    }

    typed = staging.type_raw(raw, SHOWING)
    assert {tuple(r) for r in staging.settle(typed, SHOWING).collect()} == {
        (1, 7, date(2024, 1, 1), Decimal("1234.50")), (2, 8, None, None), (3, None, None, Decimal("5.00"))}
    assert [tuple(r) for r in staging.rejects(typed, ["record_id"]).collect()] == [(2, "score", "плохо")]


def test_support_sheet_and_missing_sheet(spark, tmp_path):
    write_book(tmp_path / "s.xlsx", {"Сделки": (
        f'<row r="1">{inline("A1", "id")}{inline("B1", "deal")}{inline("C1", "state")}{inline("D1", "changed")}</row>'
        f'<row r="2">{inline("A2", "1")}{inline("B2", "10")}{inline("C2", "В работе")}{inline("D2", "01.02.2024")}</row>'
        f'<row r="3">{inline("A3", "1")}{inline("B3", "10")}{inline("C3", "Закрыта")}{inline("D3", "02.02.2024")}</row>')})
    columns = {"case_id": "id", "deal_id": "deal", "status": "state", "updated_at": "changed"}
    raw = read_workbooks(spark, str(tmp_path), "Сделки", columns)
    typed = staging.type_raw(raw, SUPPORT, codes={"status": {"в работе": "open", "закрыта": "closed"}})
    rows = staging.settle(typed, SUPPORT).collect()
    assert [(r.case_id, r.deal_id, r.status) for r in rows] == [(1, 10, "closed")]
    assert read_workbooks(spark, str(tmp_path), "absent", columns, lenient=True).count() == 0
    for sheet, wanted in (("absent", columns), ("Сделки", {**columns, "status": "status"})):
        with pytest.raises(Exception, match="no sheet 'absent'|no headings \\['status'\\]"):
            read_workbooks(spark, str(tmp_path), sheet, wanted).collect()


def test_long_sheet_comes_in_batches(spark, tmp_path):
    rows = "".join(f'<row r="{n}"><c r="A{n}"><v>{n}</v></c></row>' for n in range(2, 12_002))
    write_book(tmp_path / "long.xlsx", {"S": f'<row r="1">{inline("A1", "n")}</row>{rows}'})
    frame = read_workbooks(spark, str(tmp_path), "S", {"n": "n"})
    assert frame.selectExpr("count(*)", "sum(CAST(n AS BIGINT))").first()[:] == (12_000, sum(range(2, 12_002)))
