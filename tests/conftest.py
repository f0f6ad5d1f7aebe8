import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from paceline.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

STAGED = ("event_id string, user_id string, session_id string, event_type string, event_timestamp timestamp_ntz, "
          "variant string, acquisition_channel string, signup_date date, device string, ingested_at timestamp_ntz")

START = datetime(2024, 5, 1, 10, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("paceline-tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Events:
    """Hand-made staged events: ``add(session, step, second, **overrides)``."""

    defaults = dict(user_id="u1", variant="control", acquisition_channel="Email",
                    signup_date=START.date(), device="mobile", ingested_at=START)

    def __init__(self):
        self.rows = []

    def add(self, session_id, event_type, second, **over):
        row = {**self.defaults, "event_id": f"e{len(self.rows):04d}", "session_id": session_id,
               "event_type": event_type, "event_timestamp": START + timedelta(seconds=second), **over}
        self.rows.append(tuple(row[c.split()[0]] for c in STAGED.split(", ")))
        return self

    def df(self, spark):
        return spark.createDataFrame(self.rows, STAGED)


@pytest.fixture
def made():
    return Events()


def rows(df, *keys):
    """Rows as dicts, sorted by ``keys``."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else out


def plan(df) -> str:
    """The physical plan as text (the initial plan, before adaptive changes)."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
