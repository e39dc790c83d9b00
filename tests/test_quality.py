"""Data-quality operators (DQ1-DQ4)."""

import pytest

from fleetlake.operators.quality import (duplicate_keys, enforce_row_count, residual_report,
                                         row_count_gate)


def test_residual_report_counts(spark):
    df = spark.createDataFrame([(1, "Ã©", "ok"), (2, "fine", "â€"), (3, "fine", "fine"), (4, None, None)],
                               "id int, a string, b string")
    r = residual_report(df).collect()[0].asDict()
    assert r == {"n_rows": 4, "n_bad_rows": 2, "n_bad_a": 1, "n_bad_b": 1}


def test_residual_report_without_string_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert residual_report(df).collect()[0].asDict() == {"n_rows": 2, "n_bad_rows": 0}


def test_gate_and_duplicates(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "reactor string")
    assert row_count_gate(df, "reactor").collect()[0].passed is False
    assert [(r.reactor, r.n) for r in duplicate_keys(df, ["reactor"]).collect()] == [("b", 2)]
    with pytest.raises(ValueError, match="duplicates"):
        enforce_row_count(df, "reactor")
    ok = df.distinct()
    assert enforce_row_count(ok, "reactor", expected=2) == 2
    with pytest.raises(ValueError):
        enforce_row_count(ok, "reactor", expected=58)
