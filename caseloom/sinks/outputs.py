"""Writing cases, texts, the report and the run manifest.

Every sink overwrites, so running the same input again gives the same outputs. A single file
that cannot be written is a row of the sink's result and no failure of the run.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.drafting import render_email, summary_note
from caseloom.operators.report import case_id_collisions, report, stable_order
from caseloom.storage import arrow_uri, settle

STRUCTURED, EMAILS, SUMMARIES = "structured_data", "customer_emails", "case_summaries"
REPORT, MANIFEST, SKIPPED = "final_report", "run_manifest", "skipped_files"


def structured(cases: DataFrame) -> DataFrame:
    """The case records that get a structured output.

    Files that could not be read have a report row only.
    """
    first = F.coalesce(F.get("errors", F.lit(0)), F.lit(""))
    return cases.where(~first.startswith("ingestion: ")).select(
        F.col("meta.case_id").alias("case_id"),
        F.col("meta.source_file").alias("source_file"),
        F.col("status").alias("processing_status"),
        F.col("meta").alias("metadata"),
        "extraction",
        "task_durations_seconds",
        "errors",
    )


def emails(cases: DataFrame) -> DataFrame:
    """``case_id, source_file, text`` of the cases that have an email."""
    return cases.where(F.col("customer_email").isNotNull()).select(
        F.col("meta.case_id").alias("case_id"),
        F.col("meta.source_file").alias("source_file"),
        render_email(F.col("customer_email")).alias("text"),
    )


def summaries(cases: DataFrame) -> DataFrame:
    """``case_id, source_file, text`` of the cases that have a summary."""
    return cases.where(F.col("case_summary").isNotNull()).select(
        F.col("meta.case_id").alias("case_id"),
        F.col("meta.source_file").alias("source_file"),
        summary_note(
            F.col("meta.case_id"),
            F.col("meta.source_file"),
            F.col("extraction"),
            F.col("case_summary"),
        ).alias("text"),
    )


def write_structured(cases: DataFrame, output_dir: str) -> None:
    rows = structured(cases)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(
        f"{output_dir}/{STRUCTURED}"
    )


def write_emails(cases: DataFrame, output_dir: str) -> None:
    emails(cases).write.mode("overwrite").parquet(f"{output_dir}/{EMAILS}")


def write_summaries(cases: DataFrame, output_dir: str) -> None:
    summaries(cases).write.mode("overwrite").parquet(f"{output_dir}/{SUMMARIES}")


def write_report(cases: DataFrame, output_dir: str) -> None:
    """CSV parts in file-name order, each with a header."""
    stable_order(report(cases)).write.mode("overwrite").csv(
        f"{output_dir}/{REPORT}", header=True, emptyValue="", escape='"'
    )


def write_skipped(skipped: DataFrame, output_dir: str) -> None:
    skipped.write.mode("overwrite").json(f"{output_dir}/{SKIPPED}")


def write_run_manifest(
    spark: SparkSession, manifest: dict, output_dir: str, shown_dir: str | None = None
) -> dict:
    """One JSON row. ``skipped_files`` is the place of the table that lists them all.

    ``shown_dir`` is where outputs written to ``output_dir`` will be found.
    """
    manifest = {**manifest, "skipped_files": f"{shown_dir or output_dir}/{SKIPPED}"}
    schema = (
        "provider string, model string, started_at string, finished_at string, "
        "wall_clock_seconds double, task_mode string, batch_workers long, "
        "documents_processed long, succeeded long, partial long, failed long, "
        "skipped long, skipped_files string"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    spark.createDataFrame([tuple(manifest[n] for n in names)], schema).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(f"{output_dir}/{MANIFEST}")
    return manifest


def one_per_case_id(texts: DataFrame, losers: DataFrame) -> DataFrame:
    """Keep one text per case id where several files share it.

    ``losers`` (``case_id, kept_file``) has colliding ids only; the texts themselves are
    not shuffled unless that list is too long to broadcast.
    """
    joined = texts.join(losers, "case_id", "left")
    return joined.where(F.col("kept_file").isNull() | (F.col("kept_file") == F.col("source_file")))


WRITE_ERRORS = "case_id string, source_file string, file string, error string"


def write_files(texts: DataFrame, folder: str, suffix: str) -> DataFrame:
    """One file per case, written by the tasks; a repeated task writes the same files.

    Returns ``case_id, source_file, file, error``, a row for each file that could not be
    written; all others are. The rows are written to the shared folder, so that reading them
    does not write the files again.

    A folder without a scheme, or with ``file:``, is each machine's own, so it is only
    taken in a session whose tasks run in one process.
    """
    own = folder.startswith("file:") or "://" not in folder
    if own and texts.sparkSession.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"{folder} is not shared by the executors; name a folder with its store's scheme")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = None
        for batch in batches:
            failed = []
            for case_id, source_file, text in zip(*batch.columns, strict=True):
                name = f"{case_id.as_py()}{suffix}"
                try:
                    put = put or _writer(folder)
                    put(name, text.as_py().encode())
                except OSError as exc:
                    failed.append((case_id.as_py(), source_file.as_py(), name, str(exc)))
            columns = zip(*failed, strict=True) if failed else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], names=["case_id", "source_file", "file", "error"]
            )

    rows = texts.select("case_id", "source_file", "text").mapInArrow(write, WRITE_ERRORS)
    return settle(rows, "write-errors")


def with_write_errors(cases: DataFrame, failed: DataFrame) -> DataFrame:
    """``cases`` with ``persistence: <error>`` for each of their files that could not be written.

    The status stays as it is. Only failures move, unless there are too many to broadcast.
    """
    said = failed.groupBy("case_id", "source_file").agg(
        F.array_sort(F.collect_list(F.concat(F.lit("persistence: "), "error"))).alias("_said")
    ).select(F.struct("case_id", "source_file").alias("_case"), "_said")
    own = F.struct(F.col("meta.case_id"), F.col("meta.source_file"))
    joined = cases.join(said, own == F.col("_case"), "left")
    errors = F.concat("errors", F.coalesce("_said", F.array().cast("array<string>")))
    return joined.select(*(errors.alias(name) if name == "errors" else name for name in cases.columns))


def _writer(folder: str):
    if folder.startswith("file:") or "://" not in folder:
        local = re.sub(r"^file:/+", "/", folder)
        os.makedirs(local, exist_ok=True)

        def put(name: str, content: bytes) -> None:
            draft = os.path.join(local, f".{uuid.uuid4().hex}")
            with open(draft, "wb") as handle:
                handle.write(content)
            os.replace(draft, os.path.join(local, name))

        return put
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(arrow_uri(folder))
    system.create_dir(inner, recursive=True)

    def put_remote(name: str, content: bytes) -> None:
        with system.open_output_stream(f"{inner}/{name}") as stream:
            stream.write(content)

    return put_remote


def structured_text(cases: DataFrame) -> DataFrame:
    """``case_id, source_file, text`` with the structured record as JSON text."""
    rows = structured(cases)
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", "pretty": "true"})
    return rows.select("case_id", "source_file", F.concat(record, F.lit("\n")).alias("text"))


def write_case_files(cases: DataFrame, output_dir: str) -> DataFrame:
    """The per-case outputs as single files in three folders; returns what could not be written."""
    losers = settle(case_id_collisions(cases).select("case_id", "kept_file"), "collisions")
    failed = [
        write_files(one_per_case_id(texts, losers), f"{output_dir}/{folder}", suffix)
        for texts, folder, suffix in (
            (structured_text(cases), STRUCTURED, ".json"),
            (emails(cases), EMAILS, ".txt"),
            (summaries(cases), SUMMARIES, ".md"),
        )
    ]
    return reduce(DataFrame.unionByName, failed)
