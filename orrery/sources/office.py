"""Word and Excel documents as units, with the standard library's zip and XML readers."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree

#: Bytes that a part may have once it is unpacked.
PART_BYTES = 256 << 20
# Namespaces of the formats.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
RELATION = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
Unit = tuple[str, list[str]]


def part(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    """A part's root, or None where there is no such part; too large parts and document type declarations are errors."""
    try:
        with archive.open(name) as f:
            content = f.read(PART_BYTES + 1)
    except KeyError:
        return None
    if len(content) > PART_BYTES:
        raise ValueError("a part of the document is too large")
    if re.search(rb"<!\s*(DOCTYPE|ENTITY)", content):
        raise ValueError("a part of the document declares a type or entities")
    return ElementTree.fromstring(content)


def opened(content: bytes) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        raise ValueError("the document isn't a zip archive") from None


def levels(styles: ElementTree.Element | None) -> dict[str, int]:
    """Levels of heading styles by their ids, from their names or outline levels; a style without either has its base's."""
    found, base = {}, {}
    for style in styles.iter(f"{W}style") if styles is not None else ():
        at = style.get(f"{W}styleId", "")
        name = style.find(f"{W}name")
        outline = style.find(f"{W}pPr/{W}outlineLvl")
        if name is not None and (m := re.fullmatch(r"(?i)heading ([1-9])", name.get(f"{W}val", ""))):
            found[at] = int(m[1])
        elif outline is not None and outline.get(f"{W}val", "").isdecimal() and int(outline.get(f"{W}val")) < 9:
            found[at] = int(outline.get(f"{W}val")) + 1
        elif (of := style.find(f"{W}basedOn")) is not None:
            base[at] = of.get(f"{W}val", "")
    for at in base:
        seen, up = set(), at
        while up in base and up not in seen:
            seen.add(up)
            up = base[up]
        if up in found:
            found[at] = found[up]
    return found


def text_of(element: ElementTree.Element) -> str:
    """The element's text; tabs and line breaks are those of the document, deleted and instruction text is left out."""
    out = []
    for x in element.iter():
        if x.tag == f"{W}t":
            out.append(x.text or "")
        elif x.tag == f"{W}tab" and x.get(f"{W}val") is None:
            out.append("\t")
        elif x.tag in (f"{W}br", f"{W}cr"):
            out.append("\n")
    return "".join(out)


def parse_docx(content: bytes) -> list[Unit]:
    """Paragraphs and table rows of a Word document under the headings above them; a heading by itself is no unit.

    Headings are paragraphs whose style is one, or that have an outline level. A table's row is a unit, cells between tabs.
    """
    with opened(content) as archive:
        document, of_style = part(archive, "word/document.xml"), levels(part(archive, "word/styles.xml"))
    body = document.find(f"{W}body") if document is not None else None
    if body is None:
        raise ValueError("the archive isn't a Word document")
    out: list[Unit] = []
    path: list[tuple[int, str]] = []

    def level(paragraph: ElementTree.Element) -> int | None:
        outline, style = paragraph.find(f"{W}pPr/{W}outlineLvl"), paragraph.find(f"{W}pPr/{W}pStyle")
        if outline is not None and outline.get(f"{W}val", "").isdecimal() and int(outline.get(f"{W}val")) < 9:
            return int(outline.get(f"{W}val")) + 1
        return None if style is None else of_style.get(style.get(f"{W}val", ""))

    def walk(parent: ElementTree.Element) -> None:
        for x in parent:
            if x.tag == f"{W}p":
                text, at = text_of(x), level(x)
                if at is not None and text.strip():
                    path[:] = [p for p in path if p[0] < at]
                    path.append((at, text.strip()))
                elif text.strip():
                    out.append((text, [t for _, t in path]))
            elif x.tag == f"{W}tbl":
                for row in x.iter(f"{W}tr"):
                    cells = ["\n".join(text_of(p) for p in cell.iter(f"{W}p")) for cell in row.findall(f"{W}tc")]
                    if any(c.strip() for c in cells):
                        out.append(("\t".join(cells), [t for _, t in path]))
            elif x.tag in (f"{W}sdt", f"{W}sdtContent", f"{W}ins", f"{W}customXml"):
                walk(x)

    walk(body)
    return out


def parse_xlsx(content: bytes) -> list[Unit]:
    """Rows of an Excel workbook under their sheet's name, in the workbook's order; cells between tabs, empty ones where a column is skipped."""
    with opened(content) as archive:
        book, relations = part(archive, "xl/workbook.xml"), part(archive, "xl/_rels/workbook.xml.rels")
        if book is None or relations is None:
            raise ValueError("the archive isn't an Excel workbook")
        targets = {r.get("Id"): r.get("Target", "") for r in relations.iter(RELATION)}
        strings = part(archive, "xl/sharedStrings.xml")
        shared = [] if strings is None else ["".join(t.text or "" for t in [*si.findall(f"{S}t"), *si.findall(f"{S}r/{S}t")]) for si in strings.findall(f"{S}si")]
        out: list[Unit] = []
        for sheet in book.iter(f"{S}sheet"):
            target = targets.get(sheet.get(REL), "")
            root = part(archive, target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}"))
            if root is not None:
                out += [(line, [sheet.get("name", "").strip()]) for row in root.iter(f"{S}row") if (line := line_of(row, shared)).strip()]
        return out


def line_of(row: ElementTree.Element, shared: list[str]) -> str:
    cells: list[str] = []
    for c in row.findall(f"{S}c"):
        if m := re.match(r"[A-Z]{1,3}", c.get("r", "")):
            at = 0
            for letter in m[0]:
                at = at * 26 + ord(letter) - 64
            cells += [""] * (at - 1 - len(cells))
        kind, v = c.get("t", "n"), c.find(f"{S}v")
        value = "" if v is None else v.text or ""
        if kind == "s":
            value = shared[int(value)] if value.isdecimal() and int(value) < len(shared) else ""
        elif kind == "inlineStr":
            value = "".join(t.text or "" for t in c.iter(f"{S}t"))
        elif kind == "b":
            value = "TRUE" if value == "1" else "FALSE"
        cells.append(value)
    return "\t".join(cells).rstrip("\t")
