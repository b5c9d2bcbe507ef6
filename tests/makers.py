"""Small office files."""

import io
from zipfile import ZipFile

NS = {
    "w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main", "x": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "a": "http://schemas.openxmlformats.org/drawingml/2006/main", "p": "http://schemas.openxmlformats.org/presentationml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}


def packed(**parts: str) -> bytes:
    out = io.BytesIO()
    with ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def docx(body: str) -> bytes:
    return packed(**{"word/document.xml": f'<w:document xmlns:w="{NS["w"]}"><w:body>{body}</w:body></w:document>'})


def para(text: str) -> str:
    return f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"


def table(*rows: list[str]) -> str:
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{para(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>"


def rels(**targets: str) -> str:
    return f'<r:Relationships xmlns:r="{NS["rel"]}">' + "".join(f'<r:Relationship Id="{k}" Target="{v}" Type="t"/>' for k, v in targets.items()) + "</r:Relationships>"


def xlsx(sheets: dict[str, str], shared: list[str] = (), styles: str = "") -> bytes:
    names = list(sheets)
    parts = {
        "xl/workbook.xml": f'<x:workbook xmlns:x="{NS["x"]}" xmlns:r="{NS["r"]}"><x:sheets>' + "".join(f'<x:sheet name="{n}" r:id="s{i}"/>' for i, n in enumerate(names)) + "</x:sheets></x:workbook>",
        "xl/_rels/workbook.xml.rels": rels(**{f"s{i}": f"worksheets/sheet{i}.xml" for i in range(len(names))}),
        "xl/sharedStrings.xml": f'<x:sst xmlns:x="{NS["x"]}">' + "".join(f"<x:si><x:t>{s}</x:t></x:si>" for s in shared) + "</x:sst>",
    } | ({"xl/styles.xml": styles} if styles else {})
    for i, n in enumerate(names):
        parts[f"xl/worksheets/sheet{i}.xml"] = f'<x:worksheet xmlns:x="{NS["x"]}"><x:sheetData>{sheets[n]}</x:sheetData></x:worksheet>'
    return packed(**parts)


def row(n: int, *cells: str) -> str:
    return f'<x:row r="{n}">' + "".join(cells) + "</x:row>"


def pptx(*trees: str) -> bytes:
    parts = {
        "ppt/presentation.xml": f'<p:presentation xmlns:p="{NS["p"]}" xmlns:r="{NS["r"]}"><p:sldIdLst>' + "".join(f'<p:sldId id="{i}" r:id="s{i}"/>' for i in range(len(trees))) + "</p:sldIdLst></p:presentation>",
        "ppt/_rels/presentation.xml.rels": rels(**{f"s{i}": f"slides/slide{9 - i}.xml" for i in range(len(trees))}),
    }
    for i, t in enumerate(trees):
        parts[f"ppt/slides/slide{9 - i}.xml"] = f'<p:sld xmlns:p="{NS["p"]}" xmlns:a="{NS["a"]}"><p:cSld><p:spTree>{t}</p:spTree></p:cSld></p:sld>'
    return packed(**parts)


def shape(*lines: str) -> str:
    return "<p:sp><p:txBody>" + "".join(f"<a:p><a:r><a:t>{x}</a:t></a:r></a:p>" for x in lines) + "</p:txBody></p:sp>"
