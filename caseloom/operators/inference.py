"""Running a model over a column of prompts.

The model is any picklable callable ``(system_prompt, user_prompt, task) -> Reply``.
Spark decides where rows run; the callable decides how to reach the model. A
failing call or a bad answer becomes a value in the reply, never an exception.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.ledger import Ledger
from caseloom.operators.validation import read_responses

REPLY = T.StructType(
    [
        T.StructField("answer", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("calls", T.LongType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
_REPLY_ARROW = pa.struct(
    [
        ("answer", pa.string()),
        ("error", pa.string()),
        ("calls", pa.int64()),
        ("prompt_tokens", pa.int64()),
        ("completion_tokens", pa.int64()),
        ("seconds", pa.float64()),
    ]
)
PAIR_SECONDS = "pair_seconds"


class CallError(Exception):
    """Raised by a model callable when the transport, not the data, failed."""


class Reply(NamedTuple):
    """What a model callable returns."""

    answer: str | None
    prompt_tokens: int = 0
    completion_tokens: int = 0
    refusal: str | None = None
    finish_reason: str | None = None


@dataclass(frozen=True)
class Model:
    """A model callable and how to treat its failures.

    ``retry_on`` errors are tried again with exponential waits; ``call_errors``
    are reported as failed calls, anything else as an unexpected error. A provider
    that retries only its API errors lists them in ``retry_on``; one that retries
    everything passes ``retry_on=(Exception,)``.

    With ``ledger`` answered calls are kept in the shared folder for the time of a job, so
    that a task that Spark repeats does not make them again. A folder named there is kept: a
    later run with the same one asks only for what failed, was refused or is new, which completes
    a partial run. It must be a folder that Arrow can reach.
    """

    call: Callable[[str, str, str], Reply]
    name: str = "Model"
    model: str = "custom"
    max_attempts: int = 3
    wait_seconds: tuple[float, float] = (2.0, 20.0)
    retry_on: tuple[type[BaseException], ...] = (CallError, OSError)
    call_errors: tuple[type[BaseException], ...] = (CallError, OSError)
    sleep: Callable[[float], None] = field(default=time.sleep)
    ledger: bool | str = True

    def __post_init__(self) -> None:
        if not 1 <= self.max_attempts <= 10:
            raise ValueError("max_attempts must be between 1 and 10")


@dataclass(frozen=True)
class Request:
    """One model task: its instructions and the column holding its user prompt."""

    task: str
    instructions: str
    prompt: str


def wait_before(attempt: int, shortest: float, longest: float) -> float:
    """Seconds to wait after failed attempt number ``attempt`` (1, 2, ...)."""
    return max(shortest, min(2.0 ** (attempt - 1), longest))


def _call_with_retry(model: Model, request: Request, prompt: str) -> Reply:
    for attempt in range(1, model.max_attempts + 1):
        try:
            return model.call(request.instructions, prompt, request.task)
        except model.retry_on:
            if attempt == model.max_attempts:
                raise
            model.sleep(wait_before(attempt, *model.wait_seconds))
    raise AssertionError("unreachable")


def _answer(model: Model, request: Request, prompt: str, ledger: Ledger | None) -> Reply:
    """From the ledger, or from the model and then kept there."""
    if ledger is None:
        return _call_with_retry(model, request, prompt)
    key = ledger.key(model.name, model.model, request.task, request.instructions, prompt)
    kept = ledger.get(key)
    if kept is not None:
        return Reply(*kept)
    reply = _call_with_retry(model, request, prompt)
    if reply.answer is not None and not reply.refusal:
        ledger.put(key, list(reply))
    return reply


def ask(model: Model, request: Request, prompt: str | None, ledger: Ledger | None = None) -> dict | None:
    """One request as a reply value; no prompt, no call."""
    if prompt is None:
        return None
    started = time.perf_counter()
    reply, error = None, None
    try:
        reply = _answer(model, request, prompt, ledger)
    except model.call_errors as exc:
        error = (
            f"{model.name} call failed for task '{request.task}' after "
            f"{model.max_attempts} attempt(s): {exc}"
        )
    except Exception as exc:  # noqa: BLE001 - one document must not stop a run
        error = f"unexpected error: {exc}"
    if reply is not None and reply.refusal:
        error = f"Model refused task '{request.task}': {reply.refusal}"
    elif reply is not None and reply.answer is None:
        error = (
            f"{model.name} returned no parsable object for task '{request.task}' "
            f"(finish_reason={reply.finish_reason})"
        )
    return {
        "answer": None if error else reply.answer,
        "error": error,
        "calls": int(reply is not None),
        "prompt_tokens": reply.prompt_tokens if reply else 0,
        "completion_tokens": reply.completion_tokens if reply else 0,
        "seconds": round(time.perf_counter() - started, 3),
    }


def generate_structured(
    df: DataFrame, requests: list[Request], model: Model, *, parallel: bool = False,
    workers: int | None = None, ledger: str | None = None,
) -> DataFrame:
    """Add ``<task>_reply`` for every request, and ``pair_seconds``.

    All requests of a row run in the same task, one after the other or, with ``parallel``, at
    once. ``workers`` bounds how many rows are in flight at a time, without moving them: the
    partitions are drawn together to at most so many, and where there are fewer, each looks at
    several rows at once. For that the partitions are counted beforehand, which is cheap for a
    scan but would run the shuffles of another plan. Without ``workers`` the cluster's own slots
    are the bound. ``ledger`` is a folder of answers that are not asked for again.
    """
    if df.sparkSession.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation may repeat model calls; turn it off for this job")
    at_once = 1
    if workers is not None:
        if workers < 1:
            raise ValueError("workers must be at least 1")
        df = df.coalesce(workers)
        at_once = max(1, workers // max(1, df.rdd.getNumPartitions()))
    schema = T.StructType(
        [
            *df.schema.fields,
            *(T.StructField(f"{r.task}_reply", REPLY) for r in requests),
            T.StructField(PAIR_SECONDS, T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Ledger(ledger) if ledger else None

        def row(texts: tuple[str | None, ...]) -> tuple[list[dict | None], float]:
            started = time.perf_counter()
            if parallel:
                found = list(calls.map(ask, [model] * len(requests), requests, texts, [kept] * len(requests)))
            else:
                found = [ask(model, r, t, kept) for r, t in zip(requests, texts, strict=True)]
            return found, round(time.perf_counter() - started, 3)

        with ThreadPoolExecutor(at_once) as rows, ThreadPoolExecutor(at_once * len(requests)) as calls:
            for batch in batches:
                prompts = zip(*(batch.column(r.prompt).to_pylist() for r in requests), strict=True)
                done = list(rows.map(row, prompts))
                columns = list(batch.columns)
                columns += [pa.array([found[k] for found, _ in done], type=_REPLY_ARROW) for k in range(len(requests))]
                columns.append(pa.array([pair for _, pair in done], type=pa.float64()))
                names = [*batch.schema.names, *(f"{r.task}_reply" for r in requests), PAIR_SECONDS]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def check_replies(df: DataFrame, task: str, model_name: str) -> DataFrame:
    """Turn ``<task>_reply`` into the validated struct and ``<task>_error``."""
    reply = F.col(f"{task}_reply")
    keep = df.columns
    df = read_responses(df.select("*", reply["answer"].alias("_answer")), task, "_answer")
    found = F.col(f"{task}_violations")
    mismatch = F.when(
        F.size(found) > 0,
        F.concat(
            F.lit(f"{model_name} payload did not match schema for task '{task}': "),
            F.array_join(found, "; "),
        ),
    )
    return df.select(*keep, task, F.coalesce(reply["error"], mismatch).alias(f"{task}_error"))
