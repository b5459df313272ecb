"""A stand-in model whose answers follow from the length of the prompt.

It fails, refuses and answers wrongly by plan, so that DuckDB can work out what every
row of an inference run must look like.
"""

from __future__ import annotations

import json

from caseloom import fixed_values as fv
from caseloom.operators.inference import CallError, Model, Reply

OUTAGE, BROKEN, REFUSAL, NO_ANSWER, EMPTY = 17, 19, 23, 29, 31
PROMPT_TOKENS_PER_CHAR, COMPLETION_TOKENS = 4, 50


def _record(n: int) -> dict:
    return {
        "customer_name": "N/A" if n % 3 == 0 else f"  Client   {n} ",
        "email": f"<C{n}@Example.com>" if n % 2 else "nobody",
        "phone_number": "12" if n % 4 == 0 else f"+44 {1000000 + n}",
        "product_or_service": None if n % 5 == 0 else f"Product {n % 7}",
        "complaint_category": "Wibble" if n % 41 == 0 else fv.CATEGORIES[n % len(fv.CATEGORIES)],
        "issue_description": " " if n % 43 == 0 else f"Document of\n{n} characters",
        "resolution_provided": None,
        "is_complaint": n % 2 == 0,
        "escalation_required": n % 3 == 0,
        "supporting_document_available": False,
        "overall_case_status": fv.CASE_STATUSES[n % len(fv.CASE_STATUSES)],
        "priority": fv.PRIORITIES[n % len(fv.PRIORITIES)],
        "customer_sentiment": fv.SENTIMENTS[n % len(fv.SENTIMENTS)],
        "extraction_notes": "unknown",
    }


def _answer(task: str, n: int) -> dict:
    if task == "extraction":
        return _record(n)
    if task == "customer_email":
        return {
            "subject": f"Reply {n}",
            "greeting": "Hello,",
            "body_paragraphs": ["First  part", " "] if n % 47 else [" "],
            "closing": "Bye",
            "sender_name": "Desk",
        }
    return {
        "case_overview": f"Case {n}",
        "key_issue": "Key",
        "action_taken": "Done",
        "current_status": "Now",
        "recommended_next_action": f"Step {n % 10}",
    }


def call(instructions: str, prompt: str, task: str) -> Reply:
    n = len(prompt)
    if n % OUTAGE == 0:
        raise CallError("planned outage")
    if n % BROKEN == 0:
        raise RuntimeError("planned defect")
    tokens = (n // PROMPT_TOKENS_PER_CHAR, COMPLETION_TOKENS)
    if n % REFUSAL == 0:
        return Reply(None, *tokens, refusal="planned refusal")
    if n % NO_ANSWER == 0:
        return Reply(None, *tokens, finish_reason="length")
    return Reply("{}" if n % EMPTY == 0 else json.dumps(_answer(task, n)), *tokens)


def _no_wait(seconds: float) -> None:
    return None


MODEL = Model(call, name="Fake", model="length", max_attempts=2, sleep=_no_wait)
