"""Files in, outputs out; model runs and their failure policy; streams."""

from __future__ import annotations

import csv
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom import storage
from caseloom.operators import inference, report
from caseloom.operators.inference import CallError, Model, Reply
from caseloom.plans.batch import run_batch
from caseloom.plans.workflow import process_documents
from caseloom.sinks import outputs
from caseloom.sources import manifest
from caseloom.sources.documents import load_documents
from caseloom.streaming.arrivals import write_cases
from checks.fake_model import call
from checks.queries import _docx


def _put(folder, name, content):
    path = os.path.join(folder, name)
    with open(path, "wb") as handle:
        handle.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def folder(tmp_path, form):
    inside = tmp_path / "in put"
    (inside / "sub").mkdir(parents=True)
    for name in ("b case.txt", "a+1%20.md"):
        _put(inside, name, form)
    _put(inside, "empty.txt", "")
    _put(inside, "_latin.txt", "Customer: Renée Café\nthe app is broken".encode("latin-1"))
    _put(inside, "form.docx", _docx(["CASE FORM", "The device stopped working."], ["Customer Name", "Carol"]))
    _put(inside, "broken.docx", "not a zip")
    _put(inside, "paper.pdf", "%PDF")
    _put(inside, "notes.xlsx", "x")
    _put(inside, ".DS_Store", "x")
    _put(inside, "~$draft.docx", "x")
    _put(inside / "sub", "deeper.txt", form)
    return str(inside)


def _by_file(cases):
    return {r.meta.source_file: r for r in cases.collect()}


def test_discovery(spark, folder, tmp_path):
    files = manifest.discover(manifest.list_folder(spark, folder, chunk=3))  # three pieces
    names = [r.name for r in manifest.eligible_files(files).orderBy("name").collect()]
    assert names == ["_latin.txt", "a+1%20.md", "b case.txt", "broken.docx", "empty.txt", "form.docx", "paper.pdf"]
    assert [r.name for r in manifest.skipped_files(files).collect()] == ["notes.xlsx"]
    with pytest.raises(manifest.ReadError, match="does not exist"):
        manifest.list_folder(spark, str(tmp_path / "nowhere"))
    with pytest.raises(manifest.ReadError, match="not a directory"):
        manifest.list_folder(spark, os.path.join(folder, "notes.xlsx"))
    assert manifest.supported_extensions() == (".docx", ".md", ".pdf", ".txt")


def test_batch_tables(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    pdf = {".pdf": lambda content: "Description:\nThe parcel never arrived at my home."}
    for _ in range(2):  # a second run must overwrite, not add
        result = run_batch(spark, folder, out, extractors=pdf)
    cases = _by_file(result.cases)
    assert len(cases) == 7
    assert {n for n, r in cases.items() if r.status == "FAILED"} == {"empty.txt", "broken.docx"}
    assert cases["empty.txt"].errors == ["ingestion: empty.txt" + fv.EMPTY_DOCUMENT_SUFFIX]
    assert cases["broken.docx"].errors[0].startswith("ingestion: Failed to read broken.docx")
    assert cases["form.docx"].extraction.customer_name == "Carol"
    assert cases["_latin.txt"].extraction.customer_name == "Renée Café"
    assert cases["paper.pdf"].extraction.complaint_category == "Delivery"
    assert result.manifest["succeeded"] == 5 and result.manifest["failed"] == 2
    assert result.manifest["skipped_files"].endswith("/skipped_files") and result.outcome == "PARTIAL"

    parts = sorted(f for f in os.listdir(f"{out}/final_report") if f.endswith(".csv"))
    rows = [r for f in parts for r in csv.DictReader(open(f"{out}/final_report/{f}", encoding="utf-8"))]
    assert list(rows[0]) == list(fv.REPORT_COLUMNS)
    assert [r["source_file"] for r in rows] == sorted(cases)
    failed = next(r for r in rows if r["source_file"] == "empty.txt")
    assert failed["complaint_category"] == "" and failed["errors"] and failed["email_generated"] == "No"
    structured = spark.read.json(f"{out}/structured_data")
    assert structured.count() == 5 and "extraction" in structured.columns
    assert spark.read.parquet(f"{out}/customer_emails").count() == 5
    written = [f for f in os.listdir(f"{out}/run_manifest") if f.endswith(".json")]
    assert json.load(open(f"{out}/run_manifest/{written[0]}"))["documents_processed"] == 7


def test_batch_files_limit_and_collisions(spark, tmp_path, form):
    inside, out = tmp_path / "in", tmp_path / "out"
    inside.mkdir()
    for name in ("a.md", "a.txt", "b.txt", "c.txt"):
        _put(inside, name, form.replace("Lena Fischer", name))
    result = run_batch(spark, str(inside), str(out), limit=3, layout="files")
    assert sorted(_by_file(result.cases)) == ["a.md", "a.txt", "b.txt"]
    assert report.case_id_collisions(result.cases).first().asDict() == {
        "case_id": "a", "files": 2, "kept_file": "a.txt",
    }
    for kind, suffix in (("structured_data", "json"), ("customer_emails", "txt"), ("case_summaries", "md")):
        assert sorted(os.listdir(out / kind)) == [f"a.{suffix}", f"b.{suffix}"]
    record = json.load(open(out / "structured_data" / "a.json"))
    assert record["source_file"] == "a.txt" and record["errors"] == []
    assert "resolution_provided" in record["extraction"]
    assert "Dear a.txt," in open(out / "customer_emails" / "a.txt").read()


def test_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    result = run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert result.cases.count() == 0 and result.outcome == "OK"
    assert result.manifest["documents_processed"] == 0
    assert report.run_outcome(result.cases).first().outcome == "OK"


def test_missing_files_are_reported(spark, folder):
    files = manifest.discover(manifest.list_folder(spark, folder))
    os.remove(os.path.join(folder, "b case.txt"))
    loaded = {r.source_file for r in load_documents(spark, folder, files).collect()}
    names = [r.name for r in manifest.eligible_files(files).collect()]
    assert set(names) - loaded == {"b case.txt"}  # the batch adds these as FAILED rows


def test_truncation_keeps_the_full_length(spark):
    text = "Complaint Description:\n" + "the parcel never arrived. " * 200
    df = spark.createDataFrame([("long.txt", text)], "source_file string, text string")
    row = process_documents(df, max_chars=200).first()
    assert row.meta.truncated and row.meta.char_count == len(text)
    assert row.extraction.complaint_category == "Delivery"


def _failing(*tasks):
    def model(instructions, prompt, task):
        if task in tasks:
            raise CallError(f"outage for {task}")
        n = 3 * 4 * 5 * 7 * 11 * 13 * 37  # a prompt length no planned failure divides
        return call(instructions, "x" * n, task)

    return Model(model, name="Fake", max_attempts=1, sleep=lambda s: None)


@pytest.mark.parametrize(
    ("tasks", "status", "errors"),
    [
        ((), "SUCCESS", 0),
        (("extraction",), "FAILED", 1),
        (("customer_email",), "PARTIAL", 1),
        (("customer_email", "case_summary"), "PARTIAL", 2),
    ],
)
def test_failure_policy(spark, form, tasks, status, errors):
    df = spark.createDataFrame([("a.txt", form)], "source_file string, text string")
    row = process_documents(df, _failing(*tasks), workers=1).first()
    assert row.status == status and len(row.errors) == errors
    assert [e.split(":")[0] for e in row.errors] == list(tasks)
    assert (row.extraction is None) == (status == "FAILED")
    assert "extraction" in row.task_durations_seconds
    assert row.usage.calls == (0 if status == "FAILED" else 3 - len(tasks))


def test_retries_and_waits():
    waits, tries = [], []

    def flaky(instructions, prompt, task):
        tries.append(task)
        if len(tries) < 3:
            raise CallError("busy")
        return Reply("{}")

    model = Model(flaky, sleep=waits.append)
    request = inference.Request("extraction", "", "p")
    assert inference.ask(model, request, "x")["error"] is None
    assert len(tries) == 3 and waits == [2.0, 2.0]
    assert [inference.wait_before(n, 2, 20) for n in (1, 2, 3, 4, 5, 6)] == [2, 2, 4, 8, 16, 20]
    never = replace(model, call=lambda *a: (_ for _ in ()).throw(CallError("down")), max_attempts=2)
    assert inference.ask(never, request, "x")["error"] == (
        "Model call failed for task 'extraction' after 2 attempt(s): down"
    )
    odd = replace(model, call=lambda *a: 1 / 0)
    assert inference.ask(odd, request, "x")["error"].startswith("unexpected error: ")
    assert inference.ask(odd, request, None) is None


def test_wrong_options(spark, form):
    df = spark.createDataFrame([("a.txt", form)], "source_file string, text string")
    with pytest.raises(ValueError, match="unknown provider"):
        process_documents(df, "other")
    with pytest.raises(ValueError, match="task_mode"):
        process_documents(df, task_mode="both")
    with pytest.raises(ValueError, match="max_attempts"):
        Model(call, max_attempts=0)


def test_stream_equals_batch(spark, tmp_path, form):
    rows = [(f"c{i}.txt", form.replace("Lena", f"P{i}") if i % 3 else "  ") for i in range(12)]
    schema = "source_file string, text string"
    source = str(tmp_path / "arriving")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(source)
    out = str(tmp_path / "cases")
    stream = spark.readStream.schema(schema).parquet(source)
    write_cases(stream, out, str(tmp_path / "progress"), once=True).awaitTermination(120)
    got = spark.read.parquet(out).groupBy("status").agg(F.count("*").alias("n")).collect()
    assert {r.status: r.n for r in got} == {"SUCCESS": 8, "FAILED": 4}


def test_hadoop_paths_for_arrow():
    assert storage.arrow_uri("s3a://bucket/a b/ü") == "s3://bucket/a%20b/%C3%BC"
    assert storage.arrow_uri("hdfs://host:8020/x") == "hdfs://host:8020/x"
    assert storage.arrow_uri("abfss://c@a.dfs/x").startswith("abfs://")


def test_settled_tables_are_cleared(spark):
    kept = storage.settle(spark.range(3).toDF("k"), "numbers")
    assert sorted(r.k for r in kept.collect()) == [0, 1, 2]
    assert storage.clear_settled(spark) and not os.path.exists(kept.inputFiles()[0].removeprefix("file://"))


def test_manifest_names_the_table_of_skipped_files(spark, tmp_path):
    """However many files are skipped, they are rows, and the manifest says where."""
    skipped = spark.range(20_000).selectExpr("concat('f', id, '.xlsx') AS name")
    outputs.write_skipped(skipped, str(tmp_path))
    figures = dict.fromkeys(
        ("provider", "model", "started_at", "finished_at", "task_mode"), "x"
    ) | {"wall_clock_seconds": 1.0, "batch_workers": None, "documents_processed": 0, "succeeded": 0,
         "partial": 0, "failed": 0, "skipped": 20_000}
    manifest = outputs.write_run_manifest(spark, figures, str(tmp_path))
    assert spark.read.json(manifest["skipped_files"]).count() == 20_000
