from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FORM = """\
SERVICE DESK RECORD
-------------------

Reference: D-17
Customer Name: Lena Fischer
Email: lena.fischer@example.com
Phone: +49 30 1234567
Product / Service: Prime Fibre Line

Complaint Description:
My card was billed twice in May and I want one payment back. Copies of
both invoices are attached to this letter.

Issue Details:
Billing found a duplicate charge for the month.

Resolution Provided:
One payment was credited and the customer confirmed it.

Escalation:
Not required.

Supporting Information:
Two invoices and a card statement.
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def form() -> str:
    return FORM
