"""A whole run: an input folder in, an output folder out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import naming
from caseloom.operators.inference import Model
from caseloom.operators.report import Watched
from caseloom.plans.workflow import RULES, RULES_MODEL, process_documents
from caseloom.sinks import outputs
from caseloom.sinks.commit import StagedRun
from caseloom.sources.documents import Extractor, load_documents
from caseloom.sources.manifest import discover, eligible_files, list_folder, skipped_files

CASES = "cases"
LAYOUTS = ("tables", "files")


@dataclass(frozen=True)
class BatchResult:
    """``cases`` reads the written case table; ``manifest`` and ``usage`` hold the run figures."""

    cases: DataFrame
    skipped: DataFrame
    manifest: dict
    usage: dict

    @property
    def wall_clock_seconds(self) -> float:
        return self.manifest["wall_clock_seconds"]

    @property
    def outcome(self) -> str:
        done = self.manifest["succeeded"] == self.manifest["documents_processed"]
        return "OK" if done else "PARTIAL"


def _unreported(chosen: DataFrame, written: DataFrame) -> DataFrame:
    """Listed files that left no case row, as documents with a read error.

    Compares names only; file contents are not part of the join.
    """
    names = written.select(F.col("meta.source_file").alias("name"))
    return chosen.join(names, "name", "left_anti").select(
        F.col("name").alias("source_file"),
        F.lit("").alias("text"),
        naming.file_type(F.col("name")).alias("file_type"),
        F.col("length").alias("file_size_bytes"),
        F.concat(F.lit("Failed to read "), F.col("name")).alias("load_error"),
    )


def run_batch(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    *,
    provider: str | Model = RULES,
    limit: int | None = None,
    task_mode: str = "parallel",
    workers: int | None = None,
    max_chars: int | None = None,
    extractors: Mapping[str, Extractor] | None = None,
    layout: str = "tables",
) -> BatchResult:
    """Process every eligible document of ``input_dir``.

    The case table is written first; every other output is derived from it, so
    documents are read and parsed once. All outputs are written aside and put in place
    together at the end (see ``sinks.commit``): a run that dies leaves those of the run before.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    files = discover(list_folder(spark, input_dir))
    started = datetime.now(timezone.utc)
    options = {"max_chars": max_chars, "task_mode": task_mode, "workers": workers}
    run, watched = StagedRun(spark, output_dir), Watched()

    texts = load_documents(spark, input_dir, files, extractors=extractors, limit=limit)
    table = f"{run.folder}/{CASES}"
    watched.cases(process_documents(texts, provider, **options)).write.parquet(table)
    cases = spark.read.parquet(table)
    missing = process_documents(_unreported(eligible_files(files, limit), cases))
    watched.cases(missing).write.mode("append").parquet(table)
    cases = spark.read.parquet(table)

    skipped = skipped_files(files)
    if layout == "files":
        failed = outputs.write_case_files(cases, run.folder)
        if not failed.isEmpty():
            outputs.with_write_errors(cases, failed).write.parquet(f"{table}_with_errors")
            run.replace(CASES, by=f"{CASES}_with_errors")
            cases = spark.read.parquet(table)
    else:
        outputs.write_structured(cases, run.folder)
        outputs.write_emails(cases, run.folder)
        outputs.write_summaries(cases, run.folder)
    outputs.write_report(cases, run.folder)
    outputs.write_skipped(watched.skipped(skipped), run.folder)

    finished = datetime.now(timezone.utc)
    by_model, told = isinstance(provider, Model), watched.figures
    figures = {
        "provider": provider.name if by_model else RULES,
        "model": provider.model if by_model else RULES_MODEL,
        "started_at": started.isoformat(),
        "finished_at": finished.isoformat(),
        "wall_clock_seconds": round((finished - started).total_seconds(), 3),
        "task_mode": task_mode,
        "batch_workers": workers,
        **{name: told[name] for name in ("documents_processed", "succeeded", "partial", "failed", "skipped")},
    }
    manifest = outputs.write_run_manifest(spark, figures, run.folder, output_dir)
    run.commit()
    usage = {name: told[name] for name in ("calls", "prompt_tokens", "completion_tokens", "total_tokens")}
    return BatchResult(spark.read.parquet(f"{output_dir}/{CASES}"), skipped, manifest, usage)
