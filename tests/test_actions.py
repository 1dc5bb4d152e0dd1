from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adtide.functions.actions import action_conversions
from adtide.operators.quality import action_text, run_checks


def conversions(spark, text, mode="strict"):
    df = spark.createDataFrame([(text,)], "actions string")
    return df.select(action_conversions(F.col("actions"), mode)).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, 0.0),
        ("", 0.0),
        ("[]", 0.0),
        ('[{"action_type":"lead","value":"2"},{"action_type":"purchase","value":"1.5"}]', 3.5),
        ('[{"action_type":"link_click","value":"9"},{"action_type":"lead","value":"2"}]', 2.0),
        ('[{"action_type":"landing_page_view","value":"9"}]', 0.0),
        ('[{"action_type":"page_engagement","value":"9"}]', 0.0),
        ('[{"action_type":"post_engagement","value":"9"}]', 0.0),
        ('[{"value":"8"}]', 0.0),
        ('[{"action_type":"lead"},{"action_type":"lead","value":"4"}]', 4.0),
        ('[{"action_type":"lead","value":3}]', 3.0),
    ],
)
def test_counted_values(spark, text, expected):
    assert conversions(spark, text) == expected
    assert conversions(spark, text, "lenient") == expected


@pytest.mark.parametrize("text", ["{broken", '{"action_type":"lead","value":"2"}', "null", "7"])
def test_text_that_is_no_list_fails_or_counts_nothing(spark, text):
    with pytest.raises(PySparkException):
        conversions(spark, text)
    assert conversions(spark, text, "lenient") == 0.0


def test_bad_text_is_counted_by_a_check(spark):
    df = spark.createDataFrame([("[]",), (None,), ("",), ("{x",)], "actions string")
    assert run_checks(df, "m", action_text("actions")).first()["failures"] == 1
