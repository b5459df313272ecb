"""The report table and the figures of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caseloom import fixed_values as fv


def yes_no(flag: Column) -> Column:
    return F.when(flag.isNull(), "").when(flag, "Yes").otherwise("No")


def total_duration(durations: Column) -> Column:
    total = F.aggregate(F.map_values(durations), F.lit(0.0), lambda a, b: a + b)
    return F.round(total, 3)


def report(cases: DataFrame) -> DataFrame:
    """One row of 22 columns per case; what is missing is the empty string."""
    meta, x = F.col("meta"), F.col("extraction")

    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    columns = {
        "case_id": meta["case_id"],
        "source_file": meta["source_file"],
        "file_type": meta["file_type"],
        "processing_status": F.col("status"),
        "is_complaint": yes_no(x["is_complaint"]),
        "escalation_required": yes_no(x["escalation_required"]),
        "supporting_document_available": yes_no(x["supporting_document_available"]),
        "recommended_next_action": text(F.col("case_summary")["recommended_next_action"]),
        "email_generated": yes_no(F.col("customer_email").isNotNull()),
        "summary_generated": yes_no(F.col("case_summary").isNotNull()),
        "processing_seconds": total_duration(F.col("task_durations_seconds")),
        "errors": F.array_join("errors", " | "),
    }
    return cases.select(
        *((columns[n] if n in columns else text(x[n])).alias(n) for n in fv.REPORT_COLUMNS)
    )


def stable_order(rows: DataFrame) -> DataFrame:
    """Rows in file-name order: a range partitioning, sorted within each range."""
    return rows.orderBy("source_file")


def summary_view(cases: DataFrame) -> DataFrame:
    """The short view of a run; a dash stands for what is missing."""
    meta, x = F.col("meta"), F.col("extraction")
    dash = F.lit("—")
    return cases.select(
        meta["case_id"].alias("case_id"),
        meta["file_type"].alias("file_type"),
        F.col("status"),
        F.coalesce(x["complaint_category"], dash).alias("category"),
        F.coalesce(x["priority"], dash).alias("priority"),
        F.when(x.isNull(), dash).otherwise(yes_no(x["escalation_required"])).alias("escalation"),
        total_duration(F.col("task_durations_seconds")).alias("seconds"),
    )


def status_figures() -> list[Column]:
    status = F.col("status")
    return [
        F.count("*").alias("documents_processed"),
        F.count_if(status == "SUCCESS").alias("succeeded"),
        F.count_if(status == "PARTIAL").alias("partial"),
        F.count_if(status == "FAILED").alias("failed"),
    ]


def usage_figures() -> list[Column]:
    usage = F.col("usage")

    def total(part: str) -> Column:
        return F.coalesce(F.sum(usage[part]), F.lit(0))

    return [
        total("calls").alias("calls"),
        total("prompt_tokens").alias("prompt_tokens"),
        total("completion_tokens").alias("completion_tokens"),
        (total("prompt_tokens") + total("completion_tokens")).alias("total_tokens"),
    ]


def count_by_status(cases: DataFrame) -> DataFrame:
    """``documents_processed succeeded partial failed`` in one pass."""
    return cases.agg(*status_figures())


def token_usage(cases: DataFrame) -> DataFrame:
    return cases.agg(*usage_figures())


class Watched:
    """Run figures taken while tables are written, so that none is read again for them.

    ``watch`` a frame, write it, then read ``figures``: the sums over all frames watched.
    """

    def __init__(self):
        self._seen: list[Observation] = []

    def watch(self, df: DataFrame, *figures: Column) -> DataFrame:
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *figures)

    def cases(self, cases: DataFrame) -> DataFrame:
        return self.watch(cases, *status_figures(), *usage_figures())

    def skipped(self, skipped: DataFrame) -> DataFrame:
        return self.watch(skipped, F.count("*").alias("skipped"))

    @property
    def figures(self) -> dict[str, int]:
        sums: dict[str, int] = {}
        for one in self._seen:
            for name, value in one.get.items():
                sums[name] = sums.get(name, 0) + value
        return sums


def run_outcome(cases: DataFrame) -> DataFrame:
    """OK when every document succeeded (also when there was none), else PARTIAL."""
    clean = F.coalesce(F.bool_and(F.col("status") == "SUCCESS"), F.lit(True))
    return cases.agg(F.when(clean, "OK").otherwise("PARTIAL").alias("outcome"))


def error_list(cases: DataFrame) -> DataFrame:
    """One row per case and error."""
    return cases.select(
        F.col("meta.case_id").alias("case_id"),
        F.col("meta.source_file").alias("source_file"),
        F.posexplode("errors").alias("position", "error"),
    )


def run_counts(cases: DataFrame, skipped: DataFrame) -> DataFrame:
    """Status counts and the number of skipped files, as one row from one pass."""
    tagged = cases.select("status").unionByName(
        skipped.select(F.lit("SKIPPED").alias("status"))
    )
    status = F.col("status")
    return tagged.agg(
        F.count_if(status != "SKIPPED").alias("documents_processed"),
        F.count_if(status == "SUCCESS").alias("succeeded"),
        F.count_if(status == "PARTIAL").alias("partial"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "SKIPPED").alias("skipped"),
    )


def case_id_collisions(cases: DataFrame) -> DataFrame:
    """Case ids shared by several files, with the file whose outputs are kept."""
    return (
        cases.groupBy(F.col("meta.case_id").alias("case_id"))
        .agg(F.count("*").alias("files"), F.max("meta.source_file").alias("kept_file"))
        .where("files > 1")
    )
