"""Write errors as data, and runs that die before they are done."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from caseloom.plans import batch
from caseloom.plans.batch import run_batch
from caseloom.sinks import commit, outputs


def _folder(tmp_path, form, name="in", **texts):
    inside = tmp_path / name
    inside.mkdir()
    for file, text in texts.items():
        (inside / f"{file}.txt").write_text(text or form)
    return str(inside)


def _state(spark, out):
    """Every output as a reader finds it after ``finish``."""
    commit.finish(spark, out)
    if not os.path.isdir(f"{out}/cases"):
        return None
    names = sorted(r.f for r in spark.read.parquet(f"{out}/cases").select(F.col("meta.source_file").alias("f")).collect())
    emails = sorted(r.source_file for r in spark.read.parquet(f"{out}/customer_emails").collect())
    report = sorted(r.source_file for r in spark.read.csv(f"{out}/final_report", header=True).collect())
    told = spark.read.json(f"{out}/run_manifest").first().documents_processed
    return names, emails, report, told, spark.read.json(f"{out}/structured_data").count()


def test_a_refused_file_is_a_row_and_all_others_are_written(spark, tmp_path):
    folder = tmp_path / "texts"
    (folder / "b.txt").mkdir(parents=True)  # in the way of one file
    texts = spark.createDataFrame([(c, f"{c}.md", "text") for c in "abcd"], "case_id string, source_file string, text string")
    failed = outputs.write_files(texts.repartition(3), str(folder), ".txt").collect()
    assert [(r.case_id, r.source_file, r.file) for r in failed] == [("b", "b.md", "b.txt")] and failed[0].error
    assert sorted(f for f in os.listdir(folder) if (folder / f).is_file() and f[0] != ".") == ["a.txt", "c.txt", "d.txt"]


def test_a_write_error_is_told_and_keeps_the_status(spark, tmp_path, form):
    long_name = "n" * 251  # with .txt as long as a name may be, with .json too long
    inside, out = _folder(tmp_path, form, one=None, **{long_name: None}), str(tmp_path / "out")
    cases = {r.meta.source_file: r for r in run_batch(spark, inside, out, layout="files").cases.collect()}
    refused = cases[f"{long_name}.txt"]
    assert refused.status == "SUCCESS" and len(refused.errors) == 1
    assert refused.errors[0].startswith("persistence: ") and f"{long_name}.json" in refused.errors[0]
    assert os.path.isfile(f"{out}/customer_emails/{long_name}.txt")
    assert cases["one.txt"].errors == [] and os.path.isfile(f"{out}/structured_data/one.json")
    report = {r.source_file: r.errors for r in spark.read.csv(f"{out}/final_report", header=True).collect()}
    assert report[f"{long_name}.txt"].startswith("persistence: ") and not report["one.txt"]
    assert not os.path.exists(f"{out}/cases_with_errors")


STEPS = ("write_structured", "write_run_manifest")


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_dies_while_writing_leaves_the_old_result(spark, tmp_path, form, monkeypatch, step):
    out = str(tmp_path / "out")
    run_batch(spark, _folder(tmp_path, form, old1=None, old2=None), out)
    before = _state(spark, out)

    def die(*_):
        raise RuntimeError("killed")

    new = _folder(tmp_path, form, name="new", new=None)
    with monkeypatch.context() as patched:
        patched.setattr(outputs, step, die)
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, new, out)
    assert _state(spark, out) == before and not os.path.exists(f"{out}/{commit.RUNS}")
    run_batch(spark, new, out)
    assert _state(spark, out) == (["new.txt"], ["new.txt"], ["new.txt"], 1, 1)


@pytest.mark.parametrize("moves", [0, 3])
def test_a_run_that_dies_while_committing_leaves_the_new_result(spark, tmp_path, form, monkeypatch, moves):
    out = str(tmp_path / "out")
    run_batch(spark, _folder(tmp_path, form, old1=None, old2=None), out)
    new, whole, done = _folder(tmp_path, form, name="new", new=None), commit._move, []

    def some(fs, source, target):
        if len(done) == moves:
            fs.delete(target, True)  # the worst moment: the old output is gone, the new one not there
            raise RuntimeError("killed")
        done.append(target)
        whole(fs, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(commit, "_move", some)
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, new, out)
    assert _state(spark, out) == (["new.txt"], ["new.txt"], ["new.txt"], 1, 1)
    assert not commit.finish(spark, out)


def test_a_run_that_dies_before_any_result_leaves_none(spark, tmp_path, form, monkeypatch):
    out = str(tmp_path / "out")
    monkeypatch.setattr(batch, "skipped_files", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, _folder(tmp_path, form, a=None), out)
    assert _state(spark, out) is None
