"""Calls that are not repeated, calls in flight, and figures taken while writing."""

from __future__ import annotations

import os
import time

import pytest

from caseloom.operators import inference, report
from caseloom.operators.inference import CallError, Model, Reply, Request, generate_structured
from caseloom.operators.ledger import Ledger
from caseloom.plans.batch import run_batch
from caseloom.plans.workflow import load_texts, process_documents
from checks.fake_model import MODEL
from checks.fake_model import call as fake_call

REQUEST = Request("extraction", "instructions", "prompt")


def test_ledger_keeps_whole_answers(tmp_path):
    ledger = Ledger(f"file:{tmp_path}/answers")
    key = ledger.key("m", "task", "x", "y")
    assert key != ledger.key("m", "task", "xy", "") and ledger.get(key) is None
    assert ledger.put(key, ["ä", 1, 2, None, None]) and ledger.put(key, ["ä", 1, 2, None, None])
    assert Ledger(f"{tmp_path}/answers").get(key) == ["ä", 1, 2, None, None]
    place = ledger._place(key)
    assert os.listdir(os.path.dirname(place)) == [os.path.basename(place)]
    with open(place, "w") as handle:
        handle.write('["cut o')
    assert ledger.get(key) is None
    (tmp_path / "file").write_text("")
    assert not Ledger(f"{tmp_path}/file").put(key, [])


def test_a_repeated_task_makes_no_finished_call_again(spark, tmp_path):
    """The first attempt dies at the fifth row; the second asks for what is left alone."""
    log = str(tmp_path / "calls")

    def flaky(instructions, prompt, task):
        with open(log, "a") as handle:
            handle.write(prompt + "\n")
        if prompt == "p5" and not os.path.exists(log + ".died"):
            open(log + ".died", "w").close()
            os._exit(1)  # as if the worker were lost
        if prompt == "p7":
            raise CallError("down")
        return Reply(f"answer to {prompt}", 3, 4)

    model = Model(flaky, max_attempts=1)
    df = spark.createDataFrame([(k, f"p{k}") for k in range(10)], "k int, prompt string").coalesce(1)
    ledger = str(tmp_path / "ledger")
    ask = generate_structured(df, [REQUEST], model, ledger=ledger)
    with pytest.raises(Exception):
        ask.collect()  # a session in one process gives a task one attempt
    found = {r.k: r.extraction_reply for r in ask.collect()}
    assert {k: r.answer for k, r in found.items() if k != 7} == {k: f"answer to p{k}" for k in range(10) if k != 7}
    assert found[3].prompt_tokens == 3 and found[3].calls == 1 and "down" in found[7].error
    calls = open(log).read().split()
    assert sorted(calls) == sorted([f"p{k}" for k in range(10)] + ["p5"])
    ask.collect()
    assert open(log).read().split()[11:] == ["p7"]  # failed calls are tried again


@pytest.mark.parametrize("pieces", [1, 3, 12])
def test_no_more_rows_in_flight_than_workers_and_no_exchange(spark, tmp_path, pieces):
    folder = str(tmp_path)

    def slow(instructions, prompt, task):
        begin = time.time()
        time.sleep(0.15)
        with open(f"{folder}/{prompt}.{task}", "w") as handle:
            handle.write(f"{begin} {time.time()}")
        return Reply("{}")

    df = spark.createDataFrame([(f"p{k}",) for k in range(24)], "prompt string").repartition(pieces)
    table = str(tmp_path / "table")
    df.write.parquet(table)
    asked = generate_structured(spark.read.parquet(table), [REQUEST], Model(slow), workers=3)
    assert "Exchange" not in asked._jdf.queryExecution().executedPlan().toString()
    assert asked.count() == 24 and asked.where("extraction_reply.answer = '{}'").count() == 24
    spans = [tuple(map(float, open(f"{folder}/{f}").read().split())) for f in os.listdir(folder) if f.startswith("p")]
    in_flight = [sum(a <= at < b for a, b in spans) for at, _ in spans]
    assert max(in_flight) <= 3
    assert max(in_flight) > 1


def test_a_partial_run_is_completed_without_repeating_good_calls(spark, tmp_path, form):
    inside, log = tmp_path / "in", str(tmp_path / "calls")
    inside.mkdir()
    for k in range(4):
        (inside / f"c{k}.txt").write_text(form.replace("Lena", f"Person{k}"))

    def answering(down):
        def model(instructions, prompt, task):
            with open(log, "a") as handle:
                handle.write(task + "\n")
            if down and task == "customer_email":
                raise CallError("down")
            return fake_call(instructions, "x" * (3 * 4 * 5 * 7 * 11 * 13 * 37), task)

        return Model(model, max_attempts=1, ledger=str(tmp_path / "answers"))

    first = run_batch(spark, str(inside), str(tmp_path / "out"), provider=answering(down=True))
    assert first.manifest["partial"] == 4 and first.outcome == "PARTIAL"
    before = len(open(log).read().split())
    second = run_batch(spark, str(inside), str(tmp_path / "out"), provider=answering(down=False))
    assert second.manifest["succeeded"] == 4 and second.outcome == "OK"
    assert open(log).read().split()[before:] == ["customer_email"] * 4


def test_workers_do_not_change_the_result(spark, form):
    df = spark.createDataFrame([(f"c{k}.txt", form + "x" * k) for k in range(20)], "source_file string, text string")
    plain, bounded = (
        {r.meta.source_file: (r.status, r.errors, r.extraction) for r in process_documents(df, MODEL, workers=n).collect()}
        for n in (None, 3)
    )
    assert plain == bounded and len(plain) == 20


def test_figures_are_taken_while_tables_are_written(spark, tmp_path, form):
    df = spark.createDataFrame([("a.txt", form), ("b.txt", " "), ("c.txt", form)], "source_file string, text string")
    watched, cases = report.Watched(), process_documents(load_texts(df))
    watched.cases(cases).write.parquet(str(tmp_path / "one"))
    watched.cases(cases.where("status = 'FAILED'")).write.parquet(str(tmp_path / "two"))
    counted = report.count_by_status(cases).first().asDict() | report.token_usage(cases).first().asDict()
    extra = {"documents_processed": 1, "failed": 1}
    assert watched.figures == {name: n + extra.get(name, 0) for name, n in counted.items()}


def test_a_batch_tells_the_figures_of_its_cases(spark, tmp_path, form):
    inside = tmp_path / "in"
    inside.mkdir()
    for name, text in (("a.txt", form), ("_b.txt", form), ("empty.md", ""), ("x.xlsx", "x"), ("y.zip", "y")):
        (inside / name).write_text(text)
    result = run_batch(spark, str(inside), str(tmp_path / "out"))
    told = {name: result.manifest[name] for name in ("documents_processed", "succeeded", "partial", "failed", "skipped")}
    assert told == report.run_counts(result.cases, result.skipped).first().asDict()
    assert told == {"documents_processed": 3, "succeeded": 2, "partial": 0, "failed": 1, "skipped": 2}
    assert result.usage == report.token_usage(result.cases).first().asDict()


def test_asking_twice_without_a_ledger_calls_twice():
    calls = []
    model = Model(lambda *a: calls.append(a) or Reply("{}"))
    for _ in range(2):
        assert inference.ask(model, REQUEST, "x")["answer"] == "{}"
    assert len(calls) == 2
