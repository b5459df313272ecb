"""Reading the text of the files a manifest lists.

Contents are scanned where they lie and turned into text in the same stage; the
bytes are never shuffled or joined. Text files stay in the JVM. Word files, and
any type with an extractor of its own, go through an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import naming
from caseloom.plans.workflow import load_texts
from caseloom.sources.extractors import BUILT_IN, read_bytes

Extractor = Callable[[bytes], str]

TEXT_SUFFIXES = (".md", ".txt")
_LOADED = "source_file string, raw string, file_size_bytes long, load_error string"


def decode_text(content: Column) -> Column:
    """UTF-8 where the bytes are valid, else Latin-1."""
    as_text = content.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(content, "ISO-8859-1"))


def scan_text(contents: DataFrame) -> DataFrame:
    return contents.select(
        F.col("name").alias("source_file"),
        decode_text(F.col("content")).alias("raw"),
        F.col("length").alias("file_size_bytes"),
        F.col("load_error"),
    )


#: Text that a task gathers before it hands a batch on.
OUT_BYTES = 8 << 20


def scan_with_extractors(contents: DataFrame, extractors: Mapping[str, Extractor]) -> DataFrame:
    """Run the extractor registered for each file's suffix.

    A missing extractor or one that fails gives the row a ``load_error``. Spark fills an Arrow
    batch up to ``spark.sql.execution.arrow.maxBytesPerBatch``; within it files are looked at one
    by one where they lie, and texts are handed on every ``OUT_BYTES``. So a worker holds one
    batch, one file's extraction and that much text, however many files its task has.
    """
    registry = dict(extractors)

    def one(name: str, kind: str, content: bytes) -> tuple[str | None, str | None]:
        if kind not in registry:
            return None, f"No text extractor is registered for {kind} files ({name})"
        try:
            return registry[kind](content), None
        except Exception as exc:  # noqa: BLE001 - one bad file must not stop the job
            return None, f"Failed to read {name}: {exc}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for name, kind, length, content, said in zip(*batch.columns, strict=True):
                text, error = None, said.as_py()
                if error is None:
                    text, error = one(name.as_py(), kind.as_py(), content.as_buffer().to_pybytes())
                rows.append((name.as_py(), text, length.as_py(), error))
                size += len(text or "")
                if size > OUT_BYTES:
                    yield _loaded(rows)
                    rows, size = [], 0
            if rows:
                yield _loaded(rows)

    columns = contents.select(
        "name", naming.suffix(F.col("name")).alias("suffix"), "length", "content", "load_error"
    )
    return columns.mapInArrow(run, _LOADED)


def _loaded(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["source_file", "raw", "file_size_bytes", "load_error"])


def scan_folder(
    spark: SparkSession, input_dir: str, manifest: DataFrame, last_name: str | None = None
) -> DataFrame:
    """``name, length, content, load_error`` of the eligible files.

    ``last_name`` keeps only names up to that one. All conditions are on the file name,
    which Spark checks while planning: other files are never opened.
    """
    # The metadata name is URL-encoded, except for plus signs.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    wanted = naming.is_eligible(name)
    if last_name is not None:
        wanted = wanted & (name <= last_name)
    seen = (
        spark.read.format("binaryFile")
        .option("ignoreMissingFiles", "true")
        .option("ignoreCorruptFiles", "true")
        .load(input_dir)
        .where(wanted)
        .select(
            name.alias("name"), "length", "content", F.lit(None).cast("string").alias("load_error")
        )
    )
    hidden = manifest.where("eligible")
    if last_name is not None:
        hidden = hidden.where(F.col("name") <= last_name)
    hidden = hidden.where((F.col("length") == 0) | F.col("name").startswith("_"))
    return seen.unionByName(_read_hidden(hidden))


def _read_hidden(files: DataFrame) -> DataFrame:
    """Contents of the files Spark's scan leaves out."""

    schema = "name string, length long, content binary, load_error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, length in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                content, said = b"", None
                if length > 0:
                    try:
                        content = read_bytes(path)
                    except Exception as exc:  # noqa: BLE001
                        content, said = None, f"Failed to read {name}: {exc}"
                # One file at a time, so that a worker never holds two.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name], pa.string()), pa.array([length], pa.int64()), pa.array([content], pa.binary()),
                        pa.array([said], pa.string()),
                    ],
                    names=["name", "length", "content", "load_error"],
                )

    # Dealt out by path, since the listing may have come in few pieces; a stated number, since
    # so short rows would else be gathered into one task again.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "name", "length").repartition(tasks, "path").mapInArrow(run, schema)


def load_documents(
    spark: SparkSession,
    input_dir: str,
    manifest: DataFrame,
    *,
    extractors: Mapping[str, Extractor] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Text of every eligible file, normalised, errors in a column.

    Columns: ``source_file, text, file_type, file_size_bytes, load_error``.
    """
    last_name = None
    if limit is not None:
        # The limit is found on the manifest; one name crosses the driver.
        chosen = manifest.where("eligible").select("name").orderBy("name").limit(limit)
        last_name = chosen.agg(F.max("name")).first()[0] or ""
    contents = scan_folder(spark, input_dir, manifest, last_name)
    native = naming.suffix(F.col("name")).isin(*TEXT_SUFFIXES)
    registry = {**BUILT_IN, **(extractors or {})}
    loaded = scan_text(contents.where(native)).unionByName(
        scan_with_extractors(contents.where(~native), registry)
    )
    loaded = loaded.select(
        "source_file",
        F.col("raw").alias("text"),
        naming.file_type(F.col("source_file")).alias("file_type"),
        "file_size_bytes",
        "load_error",
    )
    return load_texts(loaded)
