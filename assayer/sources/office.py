"""Office files to lines of text, one row a line, in tasks; caps and joining are Spark's.

Each reader yields lines; whatever fails becomes an error that names the format and the kind of failure, never
contents. XML is read without entities or document types.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from pathlib import Path
from xml.etree import ElementTree
from zipfile import ZipFile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut
from ..schemas import MAX_CELLS, MAX_CHARS, MAX_PDF_PAGES

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
X = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Fixed values of the extracted text's format.
SHEETS, TABLE, PAGE, CHART = "[工作表] ", "[表格] ", "第{}页", "[含图表]"


class Unreadable(Exception):
    """A file that can't be read as text; the message is fit for a report."""


def _xml(package: ZipFile, name: str) -> ElementTree.Element:
    raw = package.read(name)
    if b"<!DOCTYPE" in raw or b"<!ENTITY" in raw:
        raise Unreadable("a part declares entities")
    return ElementTree.fromstring(raw)


#: Bytes of a part that are parsed at once.
STEP = 1 << 16


def _pulled(package: ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """The elements of one tag in a part (not within one another), each as soon as it ends, while the part is unpacked and
    parsed step by step; what was told, and whatever lies beside it, is forgotten. The part is never whole in memory, and
    parsing stops when the caller does."""
    parser, before = ElementTree.XMLPullParser(("start", "end")), b""
    above: list[ElementTree.Element] = []
    inside = 0
    with package.open(name) as part:
        while step := part.read(STEP):
            seen = before + step
            if b"<!DOCTYPE" in seen or b"<!ENTITY" in seen:
                raise Unreadable("a part declares entities")
            before = seen[-10:]
            parser.feed(step)
            for event, node in parser.read_events():
                if event == "start":
                    above.append(node)
                    inside += node.tag == tag
                    continue
                above.pop()
                if node.tag == tag:
                    inside -= 1
                    yield node
                if above and not inside:
                    above[-1].clear()
    parser.close()


def _targets(package: ZipFile, part: str) -> dict[str, str]:
    folder, name = posixpath.split(part)
    rels = _xml(package, f"{folder}/_rels/{name}.rels")
    return {r.get("Id"): posixpath.normpath(posixpath.join("/", folder, r.get("Target"))).lstrip("/") for r in rels if r.get("TargetMode") != "External"}


def docx_lines(raw: bytes) -> Iterator[str]:
    with ZipFile(io.BytesIO(raw)) as package:
        body = _xml(package, "word/document.xml").find(f"{W}body")
    if body is None:
        raise Unreadable("docx: no body")
    marks = {f"{W}tab": "\t", f"{W}br": "\n", f"{W}cr": "\n"}
    flat = lambda p: "".join((n.text or "") if n.tag == f"{W}t" else marks.get(n.tag, "") for n in p.iter())
    for node in body:
        if node.tag == f"{W}p" and (line := flat(node)):
            yield line
        elif node.tag == f"{W}tbl":
            for row in node.findall(f"{W}tr"):
                yield TABLE + " | ".join("\n".join(map(flat, cell.iter(f"{W}p"))) for cell in row.findall(f"{W}tc"))


def _date_styles(package: ZipFile) -> list[bool]:
    """Of each cell style, whether it shows a date or time."""
    if "xl/styles.xml" not in package.namelist():
        return []
    styles = _xml(package, "xl/styles.xml")
    own = {int(f.get("numFmtId")): f.get("formatCode", "").lower() for f in styles.iter(f"{X}numFmt")}
    looks = lambda code: any(c in code.split(";")[0].replace("general", "").replace("red", "") for c in "ymdhs")
    ids = [int(x.get("numFmtId", 0)) for x in (styles.find(f"{X}cellXfs") if styles.find(f"{X}cellXfs") is not None else [])]
    return [14 <= i <= 22 or 45 <= i <= 47 or (i in own and looks(own[i])) for i in ids]


def _number(text: str, is_date: bool) -> str:
    value = float(text) if any(c in text for c in ".eE") else int(text)
    if not is_date:
        return str(value)
    moment = datetime(1899, 12, 30) + timedelta(seconds=round(float(value) * 86400))
    return str(moment.time() if 0 <= value < 1 else moment)


def xlsx_lines(raw: bytes, max_cells: int = MAX_CELLS) -> Iterator[str]:
    with ZipFile(io.BytesIO(raw)) as package:
        sheets = [(s.get("name"), s.get(f"{R}id")) for s in _xml(package, "xl/workbook.xml").iter(f"{X}sheet")]
        targets, dates = _targets(package, "xl/workbook.xml"), _date_styles(package)
        shared = []
        if "xl/sharedStrings.xml" in package.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{X}t")) for s in _pulled(package, "xl/sharedStrings.xml", f"{X}si")]
        yield SHEETS + ", ".join(name for name, _ in sheets)
        cells = 0
        for name, rid in sheets:
            rows = widest = 0
            for row in _pulled(package, targets[rid], f"{X}row"):
                own = row.findall(f"{X}c")
                rows, widest = rows + 1, max(widest, len(own))
                if cells + rows * widest > max_cells:  # empty cells of the used range count; more rows can only add to them
                    raise Unreadable(f"xlsx: more than {max_cells} cells")
                yield from _cell_lines(name, own, shared, dates)
            cells += rows * widest


def _cell_lines(sheet: str, cells: list[ElementTree.Element], shared: list[str], dates: list[bool]) -> Iterator[str]:
    for cell in cells:
        kind, v = cell.get("t", "n"), cell.find(f"{X}v")
        if kind == "inlineStr":
            value = "".join(t.text or "" for t in cell.iter(f"{X}t"))
        elif v is None or v.text is None:
            continue
        elif kind == "s":
            value = shared[int(v.text)]
        elif kind == "b":
            value = str(v.text == "1")
        else:
            style = int(cell.get("s", 0))
            value = _number(v.text, style < len(dates) and dates[style]) if kind == "n" else v.text
        yield f"{sheet}!{cell.get('r')}: {value}"


def _frame_text(body: ElementTree.Element | None) -> str:
    if body is None:
        return ""
    piece = lambda n: "\v" if n.tag == f"{A}br" else (n.findtext(f"{A}t") or "") if n.tag in (f"{A}r", f"{A}fld") else ""
    return "\n".join("".join(map(piece, p)) for p in body.findall(f"{A}p"))


def pptx_lines(raw: bytes) -> Iterator[str]:
    def walk(tree: ElementTree.Element, page: str) -> Iterator[str]:
        for shape in tree:
            if shape.tag == f"{P}grpSp":
                yield from walk(shape, page)
            elif shape.tag == f"{P}graphicFrame":
                for row in shape.iter(f"{A}tr"):
                    line = " | ".join(_frame_text(c.find(f"{A}txBody")) for c in row.findall(f"{A}tc"))
                    if line.strip():
                        yield f"{page}{TABLE}{line}"
                if any(d.get("uri", "").endswith("/chart") for d in shape.iter(f"{A}graphicData")):
                    yield page + CHART
            elif shape.tag == f"{P}sp" and (text := _frame_text(shape.find(f"{P}txBody"))):
                yield f"{page}: {text}"

    with ZipFile(io.BytesIO(raw)) as package:
        targets = _targets(package, "ppt/presentation.xml")
        slides = [s.get(f"{R}id") for s in _xml(package, "ppt/presentation.xml").iter(f"{P}sldId")]
        for n, rid in enumerate(slides, start=1):
            tree = _xml(package, targets[rid]).find(f"{P}cSld/{P}spTree")
            yield from walk(tree if tree is not None else [], PAGE.format(n))


def pdf_lines(raw: bytes, max_chars: int = MAX_CHARS) -> Iterator[str]:
    """Pages' texts, if a PDF reader is installed."""
    try:
        import pypdf
    except ImportError:
        raise Unreadable("pdf: no reader is installed") from None
    pages, total = pypdf.PdfReader(io.BytesIO(raw)).pages, 0
    if len(pages) > MAX_PDF_PAGES:
        raise Unreadable(f"pdf: more than {MAX_PDF_PAGES} pages")
    for page in pages:
        if text := page.extract_text() or "":
            yield text
            total += len(text)
        if total > max_chars:
            return


def txt_lines(raw: bytes) -> Iterator[str]:
    yield raw.decode("utf-8-sig")


READERS: dict[str, Callable[[bytes], Iterator[str]]] = {"xlsx": xlsx_lines, "docx": docx_lines, "pptx": pptx_lines, "pdf": pdf_lines, "txt": txt_lines}


def read_lines(suffix: str, raw: bytes, readers: dict = READERS) -> tuple[list[str], str | None]:
    if suffix not in readers:
        return [], f"unsupported format: {suffix!r}"
    try:
        return list(readers[suffix](raw)), None
    except Unreadable as e:
        return [], str(e)
    except Exception as e:  # noqa: BLE001  only its kind may be shown
        return [], f"{suffix}: can't be parsed ({type(e).__name__})"


def _contents(row: dict) -> bytes:
    """A row's file: its content, or what is at its full path and still has the digest found before."""
    if row.get("content") is not None:
        return row["content"]
    raw = Path(row["full"]).read_bytes()
    if hashlib.sha256(raw).hexdigest() != row["sha256"]:
        raise Unreadable("a file was changed while it was read")
    return raw


def extract(files: DataFrame, keys: list[str], max_chars: int = MAX_CHARS, readers: dict | None = None) -> DataFrame:
    """keys, path, text, error of files(keys, path, suffix, and full, sha256 or content). Texts but plain ones are cut at
    max_chars.

    With full paths only names cross to Python, and a task holds one file at a time; contents are for small files.
    Lines leave the reader as rows and meet again by file.
    """
    schema = ", ".join(f"`{k}` {files.schema[k].dataType.simpleString()}" for k in keys) + ", path string, suffix string, at int, line string, error string"
    own = files.select(*keys, "path", "suffix", *(["full", "sha256"] if "full" in files.columns else ["content"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                try:
                    lines, error = read_lines(row["suffix"], _contents(row), readers or READERS)
                except (Unreadable, OSError) as e:
                    lines, error = [], str(e) if type(e) is Unreadable else type(e).__name__
                head = {k: row[k] for k in (*keys, "path", "suffix")}
                yield pd.DataFrame([{**head, "at": i, "line": line, "error": error} for i, line in enumerate(lines or [""])])

    lines = own.mapInPandas(run, schema).groupBy(*keys, "path", "suffix").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("l"), F.max("error").alias("error"))
    text = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return lines.select(*keys, "path", F.when(F.col("suffix") == "txt", text).otherwise(cut(text, max_chars)).alias("text"), "error")
