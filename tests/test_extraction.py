"""Bounds of extraction: bytes in a batch, unpacked sizes, one file at a time."""

from __future__ import annotations

import io
import zipfile

import pytest

from caseloom.sources import documents, extractors
from caseloom.sources.manifest import list_folder
from checks.queries import _docx

CONTENTS = "name string, length long, content binary, load_error string"


def _bomb(n: int) -> bytes:
    """An archive whose document unpacks to far more than it takes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("word/document.xml", b"<a>" + b" " * n + b"</a>")
    return out.getvalue()


def test_an_archive_that_unpacks_to_too_much_is_an_error_row(spark):
    good, bomb = _docx(["All is well."], []), _bomb(extractors.MAX_UNPACKED)
    assert len(bomb) < 100_000
    rows = [("good.docx", len(good), good, None), ("bomb.docx", len(bomb), bomb, None), ("lost.docx", 3, None, "gone")]
    found = documents.scan_with_extractors(spark.createDataFrame(rows, CONTENTS), extractors.BUILT_IN).collect()
    found = {r.source_file: r for r in found}
    assert found["good.docx"].raw == "All is well." and found["good.docx"].load_error is None
    assert found["bomb.docx"].raw is None and "unpacks to more than" in found["bomb.docx"].load_error
    assert found["lost.docx"].load_error == "gone"


def test_unpacking_stops_at_the_limit():
    with zipfile.ZipFile(io.BytesIO(_bomb(10_000))) as package:
        assert len(extractors.unpacked(package, "word/document.xml", 20_000)) == 10_007
        with pytest.raises(ValueError, match="more than 5000 bytes"):
            extractors.unpacked(package, "word/document.xml", 5000)


def test_one_large_and_a_thousand_small_files_in_one_task(spark, tmp_path):
    """A worker holds a batch of bounded bytes, not its whole task."""

    def peak(content: bytes) -> str:
        """How much memory the worker has taken at most so far, in MB."""
        import resource

        return str(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)

    for k in range(1000):
        (tmp_path / f"small{k}.bin").write_bytes(b"x" * 100_000)
    (tmp_path / "large.bin").write_bytes(b"y" * 200_000_000)
    files = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr(
        "regexp_extract(path, '[^/]+$', 0) AS name", "length", "content", "CAST(NULL AS STRING) AS load_error"
    )
    found = documents.scan_with_extractors(files.coalesce(1), {".bin": peak}).select("source_file", "raw").collect()
    assert len(found) == 1001
    # All files are 300 MB. A batch of up to 64 MB and the large file, its copy on the way in, and once more.
    assert max(int(r.raw) for r in found) < 1000


def test_hidden_files_are_dealt_out_and_handed_on_one_by_one(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"_note{k}.txt").write_text(f"text {k}")
    (tmp_path / "empty.txt").write_text("")
    listed = list_folder(spark, str(tmp_path))
    read = documents._read_hidden(listed)
    assert sorted((r.name, bytes(r.content)) for r in read.collect()) == sorted(
        [(f"_note{k}.txt", f"text {k}".encode()) for k in range(40)] + [("empty.txt", b"")]
    )
    assert sum(n > 0 for n in read.rdd.glom().map(len).collect()) > 1
