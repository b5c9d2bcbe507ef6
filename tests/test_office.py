import pytest
from makers import NS, docx, packed, para, pptx, row, shape, table, xlsx

from assayer.sources import office


def read(suffix, raw):
    return office.read_lines(suffix, raw)


def test_docx_body_and_table():
    raw = docx(para("one") + para("") + table(["a", "b"], ["", ""]) + "<w:sectPr/>")
    assert read("docx", raw) == (["one", "[表格] a | b", "[表格]  | "], None)


def test_docx_tab_and_break():
    assert read("docx", docx("<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t></w:r></w:p>"))[0] == ["a\tb\nc"]


@pytest.mark.parametrize("raw", [b"no archive", packed(other="x"), packed(**{"word/document.xml": "<broken"}), packed(**{"word/document.xml": "<!DOCTYPE a [<!ENTITY b 'c'>]><a>&b;</a>"})])
def test_unreadable_docx_tells_no_contents(raw):
    lines, error = read("docx", raw)
    assert lines == [] and error and "broken" not in error


def test_xlsx_sheets_kinds_and_dates():
    styles = f'<x:styleSheet xmlns:x="{NS["x"]}"><x:numFmts><x:numFmt numFmtId="170" formatCode="yyyy-mm-dd"/></x:numFmts><x:cellXfs><x:xf numFmtId="0"/><x:xf numFmtId="170"/></x:cellXfs></x:styleSheet>'
    first = row(1, '<x:c r="A1" t="s"><x:v>1</x:v></x:c>', '<x:c r="B1"/>', '<x:c r="C1"><x:v>2.50</x:v></x:c>') + row(2, '<x:c r="A2" t="b"><x:v>1</x:v></x:c>', '<x:c r="B2" s="1"><x:v>45292</x:v></x:c>')
    second = row(1, '<x:c r="A1" t="inlineStr"><x:is><x:t>in</x:t></x:is></x:c>', '<x:c r="B1" t="str"><x:v>sum</x:v></x:c>', '<x:c r="C1"><x:v>7</x:v></x:c>')
    lines, error = read("xlsx", xlsx({"S1": first, "S2": second}, ["x", "shared"], styles))
    assert error is None
    assert lines == ["[工作表] S1, S2", "S1!A1: shared", "S1!C1: 2.5", "S1!A2: True", "S1!B2: 2024-01-01 00:00:00", "S2!A1: in", "S2!B1: sum", "S2!C1: 7"]


def test_xlsx_cell_limit():
    raw = xlsx({"S": row(1, *['<x:c r="A1"><x:v>1</x:v></x:c>'] * 3)})
    with pytest.raises(office.Unreadable):
        list(office.xlsx_lines(raw, 2))
    assert len(list(office.xlsx_lines(raw, 3))) == 4


def test_a_sheet_is_parsed_no_further_than_its_limit(tmp_path):
    """Ten million cells in one sheet: parsing stops at the limit, and the sheet is never whole in memory."""
    import resource
    import time
    from zipfile import ZIP_DEFLATED, ZipFile

    small = xlsx({"S": row(1, '<x:c r="A1"><x:v>1</x:v></x:c>')})
    (tmp_path / "s.xlsx").write_bytes(small)
    one = row(1, *['<x:c r="A1" t="str"><x:v>a value of some length</x:v></x:c>'] * 1000).encode()
    with ZipFile(tmp_path / "s.xlsx") as src, ZipFile(tmp_path / "big.xlsx", "w", ZIP_DEFLATED, compresslevel=1) as out:
        for n in src.namelist():
            if "worksheets" not in n:
                out.writestr(n, src.read(n))
                continue
            with out.open(n, "w", force_zip64=True) as part:
                part.write(f'<x:worksheet xmlns:x="{NS["x"]}"><x:sheetData>'.encode())
                for _ in range(10_000):
                    part.write(one)
                part.write(b"</x:sheetData></x:worksheet>")
    raw = (tmp_path / "big.xlsx").read_bytes()
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    assert read("xlsx", raw) == ([], "xlsx: more than 200000 cells")
    assert time.process_time() - began < 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
    told = 0
    for line in office.xlsx_lines(raw, 2_000_000):  # a caller that has enough stops the parsing
        told += 1
        if told == 1000:
            break
    assert line == "S!A1: a value of some length"


def test_parts_with_entities_are_refused():
    raw = packed(**{"xl/workbook.xml": f'<x:workbook xmlns:x="{NS["x"]}"/>', "a.xml": "<!--" + " " * (office.STEP - 12) + "--><!DOCTYPE a [<!ENTITY b 'x'>]><a><c>&b;</c></a>", "b.xml": "<a>" + "<r><r2/>x</r><s/>" * 30_000 + "</a>"})
    from io import BytesIO
    from zipfile import ZipFile

    with ZipFile(BytesIO(raw)) as package:
        with pytest.raises(office.Unreadable, match="entities"):
            list(office._pulled(package, "a.xml", "c"))
        assert [(n.tag, len(n)) for n in office._pulled(package, "b.xml", "r")] == [("r", 1)] * 30_000


def test_pptx_order_groups_tables_charts():
    grid = '<p:graphicFrame><a:graphic><a:graphicData uri="x/table"><a:tbl>' + "".join(
        "<a:tr>" + "".join(f"<a:tc><a:txBody><a:p><a:r><a:t>{c}</a:t></a:r></a:p></a:txBody></a:tc>" for c in r) + "</a:tr>" for r in (["a", "b"],)
    ) + "</a:tbl></a:graphicData></a:graphic></p:graphicFrame>"
    chart = '<p:graphicFrame><a:graphic><a:graphicData uri="http://x/chart"/></a:graphic></p:graphicFrame>'
    lines, error = read("pptx", pptx(shape("first", "line"), f"<p:grpSp>{shape('inner')}</p:grpSp>{grid}{chart}"))
    assert error is None
    assert lines == ["第1页: first\nline", "第2页: inner", "第2页[表格] a | b", "第2页[含图表]"]


def test_other_formats():
    assert read("exe", b"")[1] == "unsupported format: 'exe'"
    assert read("txt", b"\xef\xbb\xbfhi") == (["hi"], None)
    assert read("txt", b"\xff")[1] == "txt: can't be parsed (UnicodeDecodeError)"
    assert read("pdf", b"x")[1].startswith("pdf: ")


def test_extract_joins_and_cuts(spark):
    rows = [(1, "a.docx", "docx", docx(para("x" * 30) + para("end"))), (1, "b.txt", "txt", b"t" * 30), (2, "c.docx", "docx", b"bad")]
    got = {r["path"]: r for r in office.extract(spark.createDataFrame(rows, "k int, path string, suffix string, content binary"), ["k"], max_chars=20).collect()}
    assert got["a.docx"]["text"] == "x" * 20 and got["b.txt"]["text"] == "t" * 30
    assert got["c.docx"]["error"].startswith("docx: can't be parsed")
