"""What lies in an input folder: one row per file, contents unread.

Ordinary files come from Spark's own file listing, which gives their lengths without reading
them. That listing leaves out empty files and names starting with ``_``, and both have to show
up in the report. The paths in the folder, one level deep, are therefore also taken from the
Hadoop file system behind it, in bulk and not one by one; what Spark did not list is looked
at in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import naming
from caseloom.schemas import MANIFEST
from caseloom.sources.extractors import file_length
from caseloom.storage import new_table_path, settle

#: Paths that the driver takes over at once, and how many such pieces it holds.
LISTING_CHUNK, PIECES = 20_000, 10


class ReadError(Exception):
    """An input folder that cannot be listed."""


def supported_extensions() -> tuple[str, ...]:
    return tuple(sorted(fv.SUPPORTED_EXTENSIONS))


def check_input_path(spark: SparkSession, input_dir: str):
    """The Hadoop file system and path of ``input_dir``; raises before any job starts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(input_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise ReadError(f"Input directory does not exist: {input_dir}")
    if not fs.getFileStatus(path).isDirectory():
        raise ReadError(f"Input path is not a directory: {input_dir}")
    return fs, path


def _paths(spark: SparkSession, fs, path, chunk: int) -> DataFrame:
    """``path`` of all entries of a folder, directories too.

    The listing lies in the driver's JVM, as for every folder Spark reads. Its paths come over
    as long strings, parted by a character that no path holds, and longer listings go to a table
    in the shared folder piece by piece.
    """
    jvm, schema = spark._jvm, "piece string"
    listed = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(path))
    # As an array of the kind that ``join`` asks for.
    found = spark.sparkContext._gateway.new_array(jvm.Object, len(listed))
    jvm.java.lang.System.arraycopy(listed, 0, found, 0, len(listed))
    join = jvm.org.apache.commons.lang3.StringUtils.join
    table, held = None, []
    for at in range(0, len(found), chunk):
        held.append((join(found, "\0", at, min(at + chunk, len(found))),))
        if len(held) == PIECES:
            table = table or new_table_path(spark, "listing")
            spark.createDataFrame(held, schema).write.mode("append").parquet(table)
            held = []
    pieces = spark.createDataFrame(held, schema)
    if table is not None:
        pieces = pieces.unionByName(spark.read.schema(schema).parquet(table))
    return pieces.select(F.explode(F.split("piece", "\\x00")).alias("path"))


def _looked_at(paths: DataFrame) -> DataFrame:
    """``path, length`` of the files among ``paths``; entries that are gone or are folders are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(path, file_length(path)) for path in batch.column(0).to_pylist()]
            found = [(path, length) for path, length in found if length is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
                names=["path", "length"],
            )

    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(tasks, "path").mapInArrow(run, "path string, length long")


def list_folder(spark: SparkSession, input_dir: str, chunk: int = LISTING_CHUNK) -> DataFrame:
    """``path, name, length`` of every file directly inside ``input_dir``, as it was when this was called.

    The listing is written to the shared folder, since all that follows must see the same one.
    """
    fs, path = check_input_path(spark, input_dir)
    shown = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(input_dir)
    shown = shown.select("path", "length")
    name = F.substring_index("path", "/", -1)
    root = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().rstrip("/")
    # Of a folder that looks like a partition, Spark lists the files, too.
    top = F.col("path") == F.concat(F.lit(f"{root}/"), name)
    hidden = _looked_at(_paths(spark, fs, path, chunk).join(shown, "path", "left_anti"))
    files = shown.where(top).unionByName(hidden)
    files = files.select("path", name.alias("name"), "length")
    return settle(files.to(MANIFEST), "manifest")


def discover(files: DataFrame) -> DataFrame:
    """Add ``file_type``, ``ignored``, ``eligible`` and ``skipped`` to a file listing."""
    name = F.col("name")
    return files.select(
        "*",
        naming.file_type(name).alias("file_type"),
        naming.is_ignored(name).alias("ignored"),
        naming.is_eligible(name).alias("eligible"),
        naming.is_skipped(name).alias("skipped"),
    )


def eligible_files(manifest: DataFrame, limit: int | None = None) -> DataFrame:
    """Files to process; with ``limit`` the first ones in name order."""
    chosen = manifest.where("eligible")
    return chosen if limit is None else chosen.orderBy("name").limit(limit)


def skipped_files(manifest: DataFrame) -> DataFrame:
    """Files of a type nothing can read, in name order."""
    return manifest.where("skipped").select("name").orderBy("name")


def attach_content(manifest: DataFrame, contents: DataFrame, key: str) -> DataFrame:
    """Every manifest row with its content, null where none could be read."""
    return manifest.join(contents, key, "left")
