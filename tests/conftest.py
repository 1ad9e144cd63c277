from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from clickflow.schemas import USER_VISIT_ACTION  # noqa: E402
from clickflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def scratch() -> str:
    # A fresh folder per run; never cleared by the tests.
    return tempfile.mkdtemp(prefix="clickflow-test-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.sql.streaming.schemaInference": "false",
    }
    s = build_session("clickflow-tests", master="local[4]", conf=conf)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", f"{scratch}/checkpoints")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_(scratch) -> str:
    return tempfile.mkdtemp(prefix="t-", dir=scratch)


UVA_DEFAULTS = {
    "date": None,
    "user_id": 1,
    "session_id": "s1",
    "page_id": 1,
    "action_time": "2024-01-01 00:00:00",
    "search_keyword": None,
    "click_category_id": -1,
    "click_product_id": -1,
    "order_category_ids": None,
    "order_product_ids": None,
    "pay_category_ids": None,
    "pay_product_ids": None,
    "city_id": 1,
}


def make_actions(spark: SparkSession, rows: list[dict]):
    """Click-log rows from partial dicts; ``event_id`` is the row number."""
    full = []
    for i, r in enumerate(rows):
        d = {**UVA_DEFAULTS, **r}
        if d["date"] is None:
            d["date"] = d["action_time"][:10]
        full.append((i, *[d[f.name] for f in USER_VISIT_ACTION.fields]))
    schema = "event_id BIGINT, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in USER_VISIT_ACTION.fields)
    return spark.createDataFrame(full, schema)
