"""Reading plans in tests."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_of(frame: DataFrame, mode: str = "simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()
