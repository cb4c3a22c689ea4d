"""Short forms of users and reviews."""

from __future__ import annotations

import pytest

from acquaint.schemas import REVIEW_SUMMARY, USER_SUMMARY
from tests.helpers import review, tables, user


@pytest.mark.parametrize(
    "text, shown",
    [
        (None, None),
        ("", ""),
        ("x" * 49, "x" * 49),
        ("x" * 50, "x" * 50),
        ("x" * 51, "x" * 50 + "..."),
        ("y" * 5000, "y" * 50 + "..."),
        ("😀" * 50, "😀" * 50),
        ("😀" * 51, "😀" * 50 + "..."),
        ("é" * 60, "é" * 50 + "..."),
    ],
)
def test_review_text_is_shortened(spark, text, shown):
    t = tables(spark, review=[review("r", "a", text)])
    assert t.review_summaries().first()["text"] == shown


def test_summary_columns(spark):
    t = tables(spark, user=[user("a", "Ann", fans=2)], review=[review("r", "a")])
    assert tuple(t.user_summaries().columns) == USER_SUMMARY
    assert tuple(t.review_summaries().columns) == REVIEW_SUMMARY
    assert tuple(t.user_summaries().first()) == ("a", "Ann", 0.0, 0, 2, None, 0, 0, 0)
    assert tuple(t.review_summaries().first()) == ("r", "a", None, 0.0, None, None, 0, 0, 0)
