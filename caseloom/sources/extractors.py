"""Text out of one file's bytes. Small helpers that run inside a Spark task."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from caseloom.storage import arrow_uri

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def read_bytes(path: str) -> bytes:
    """Contents of a file given by a Hadoop-style path."""
    if path.startswith("file:") or "://" not in path:
        with open(re.sub(r"^file:/+", "/", path), "rb") as handle:
            return handle.read()
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    with system.open_input_stream(inner) as stream:
        return stream.read()


def file_length(path: str) -> int | None:
    """Length of the file at a Hadoop-style path; None for a folder or nothing."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        system, inner = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    else:
        system, inner = fs.FileSystem.from_uri(arrow_uri(path))
    found = system.get_file_info(inner)
    return found.size if found.type == fs.FileType.File else None


def _paragraph(node: ElementTree.Element) -> str:
    marks = {f"{_W}tab": "\t", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}
    parts = []
    runs = [
        run
        for child in node
        for run in ([child] if child.tag == f"{_W}r" else child.findall(f"{_W}r"))
        if child.tag in (f"{_W}r", f"{_W}hyperlink")
    ]
    for run in runs:
        for item in run:
            if item.tag == f"{_W}t":
                parts.append(item.text or "")
            elif item.tag == f"{_W}br":
                parts.append("\n" if item.get(f"{_W}type", "textWrapping") == "textWrapping" else "")
            else:
                parts.append(marks.get(item.tag, ""))
    return "".join(parts)


def _rows(table: ElementTree.Element) -> list[list[str]]:
    """Cell texts per row; a merged cell counts once for every place it covers."""
    rows: list[list[str]] = []
    for row in table.findall(f"{_W}tr"):
        cells: list[str] = []
        for cell in row.findall(f"{_W}tc"):
            text = "\n".join(_paragraph(p) for p in cell.findall(f"{_W}p")).strip()
            span, merge = cell.find(f"{_W}tcPr/{_W}gridSpan"), cell.find(f"{_W}tcPr/{_W}vMerge")
            goes_on = merge is not None and merge.get(f"{_W}val", "continue") == "continue"
            if goes_on and rows and len(cells) < len(rows[-1]):
                text = rows[-1][len(cells)]
            cells += [text] * (int(span.get(f"{_W}val", "1")) if span is not None else 1)
        rows.append(cells)
    return rows


#: Bytes that a document inside an archive may unpack to; parsing takes about ten times as much.
MAX_UNPACKED = 64 << 20


def unpacked(package: zipfile.ZipFile, name: str, limit: int) -> bytes:
    """A member of an archive; whatever its header says, no more than ``limit`` bytes are unpacked."""
    with package.open(name) as member:
        content = member.read(limit + 1)
    if len(content) > limit:
        raise ValueError(f"{name} unpacks to more than {limit} bytes")
    return content


def docx_text(content: bytes, limit: int = MAX_UNPACKED) -> str:
    """Body paragraphs, then every non-empty table row as ``cell | cell``.

    An archive whose document unpacks to more than ``limit`` bytes is refused.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        root = ElementTree.fromstring(unpacked(package, "word/document.xml", limit))
    body = root.find(f"{_W}body")
    lines = [_paragraph(p) for p in body.findall(f"{_W}p")]
    for table in body.findall(f"{_W}tbl"):
        lines += [" | ".join(cells) for cells in _rows(table) if any(cells)]
    return "\n".join(lines)


BUILT_IN = {".docx": docx_text}
