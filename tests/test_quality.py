"""Expectations on a small table with nulls, duplicates and faults."""

import json

import pytest

from quayside.operators import quality
from quayside.operators.suites import Expectation, read_suite

ROWS = [
    (1, "a@b.co", 1.5, "2024-01-02 03:04:05", None, 10),
    (2, "x y", 2.5, "2024-13-01 00:00:00", None, 2**62),
    (3, "x y", None, "2024-1-5", None, 2**62),
    (4, None, 4.0, None, None, 2**62),
]
SCHEMA = "id int, name string, price double, at string, empty string, big bigint"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def one(df, name, column=None, *args):
    rows = quality.check(df, f"expect_{name}", column, *args).collect()
    assert len(rows) == 1
    return rows[0]


CASES = [
    (("column_to_exist", "id"), True, None, "id"),
    (("column_values_to_be_null", "empty"), True, 0, None),
    (("column_values_to_be_null", "name"), False, 3, None),
    (("column_values_to_be_not_null", "id"), True, 0, None),
    (("column_values_to_be_not_null", "price"), False, 1, None),
    (("column_proportion_of_unique_values_to_be_between", "id", 1, 10), True, None, "1.000000"),
    (("column_proportion_of_unique_values_to_be_between", "name", 1, 10), False, None, "0.666667"),
    (("column_proportion_of_unique_values_to_be_between", "empty", 0, 10), False, None, None),
    (("column_value_int_data_type_check", "id"), True, None, "int"),
    (("column_value_int_data_type_check", "big"), False, None, "bigint"),
    (("column_value_int_data_type_check", "name"), False, 3, None),
    (("column_value_long_data_type_check", "id"), True, None, "int"),
    (("column_value_string_data_type_check", "name"), True, None, "string"),
    (("column_values_to_be_in_type_list", "big", "Long", "Int"), True, None, "bigint"),
    (("column_values_to_be_in_type_list", "big", "StringType"), False, None, "bigint"),
    (("column_values_to_be_unique", "name"), False, 2, None),
    (("column_values_to_be_unique", "empty"), True, 0, None),
    (("column_unique_value_count_to_be_between", "name", 2, None), True, None, "2"),
    (("column_unique_value_count_to_be_between", "empty", 0, 0), True, None, "0"),
    (("column_values_to_contain_valid_email", "name"), False, 2, None),
    (("column_values_not_contain_special_character", "name"), False, 1, None),
    (("match_strftime_format", "at"), False, 2, None),
    (("column_values_to_be_dateutil_parseable", "at"), False, 1, None),
    (("column_value_lengths_to_be_between", "name", 3, 5), False, 1, None),
    (("column_value_lengths_to_be_between", "name", None, 6), True, 0, None),
    (("column_value_lengths_to_equal", "name", 3), False, 1, None),
    (("column_max_to_be_between", "price", 0, 4), True, None, "4.000000"),
    (("column_max_to_be_between", "at", "2024", "2025"), True, None, "2024-13-01 00:00:00"),
    (("column_min_to_be_between", "price", 2, 4), False, None, "1.500000"),
    (("column_mean_to_be_between", "price", 2, 3), True, None, "2.666667"),
    (("column_median_to_be_between", "price", 2.5, 2.5), True, None, "2.500000"),
    (("column_median_to_be_between", "id", 2.5, 2.5), True, None, "2.500000"),
    (("column_sum_to_be_between", "price", 8, 8), True, None, "8.000000"),
    (("column_sum_to_be_between", "big", 0, None), True, None, str(3 * 2**62 + 10)),
    (("column_max_to_be_between", "empty", None, None), False, None, None),
    (("table_column_count_to_be_between", None, 1, 5), False, None, "6"),
    (("table_column_count_to_equal", None, 6), True, None, "6"),
    (("table_row_count_to_be_between", None, 1, None), True, None, "4"),
    (("table_row_count_to_equal", None, 5), False, None, "4"),
]


@pytest.mark.parametrize("call, success, unexpected, observed", CASES, ids=lambda c: c[0] if isinstance(c, tuple) else "")
def test_expectation(df, call, success, unexpected, observed):
    row = one(df, *call)
    assert (row["success"], row["unexpected_count"], row["observed"], row["error"]) == (
        success,
        unexpected,
        observed,
        None,
    )


def test_every_expectation_is_covered():
    assert {f"expect_{call[0]}" for call, *_ in CASES} == set(quality.ALL_CHECKS)
    assert len(quality.ALL_CHECKS) == 25


@pytest.mark.parametrize(
    "item, error",
    [
        (Expectation("expect_column_to_exist", "nope"), "column not found"),
        (Expectation("expect_magic", "id"), "unknown expectation"),
        (Expectation("expect_column_max_to_be_between", "price", (1,)), "wrong number of arguments"),
        (Expectation("expect_column_sum_to_be_between", "name", (1, 2)), "column is not numeric"),
        (Expectation("expect_match_strftime_format", "at", ("%Q",)), "time format is not served"),
        (Expectation("expect_table_row_count_to_equal"), "wrong number of arguments"),
        ("expect_column_to_exist(__import__('os'))", "arguments are not literals"),
        ("rm -rf", "not an expectation call"),
        ("expect_column_to_exist()", "no column"),
    ],
)
def test_mistakes_give_a_row_not_an_exception(df, item, error):
    row = quality.run_suite(df, [item]).first()
    assert (row["success"], row["error"]) == (False, error)


def test_suite_forms_agree():
    calls = [
        "expect_column_max_to_be_between('age', 10, 70)",
        "expect_column_max_to_be_between('postal_code', [1, 7])",
        "expect_column_to_exist('a')",
        "expect_column_to_exist('b')",
        "expect_table_row_count_to_equal(10000)",
    ]
    nested = {
        "column_max_to_be_between": {"columns": ["age", [10, 70], "postal_code", [1, 7]]},
        "column_to_exist": {"columns": ["a", "b"]},
        "table_row_count_to_equal": {"values": [10000]},
    }
    want = read_suite(calls)
    assert read_suite(json.dumps(calls)) == want
    assert read_suite({"Title": calls}) == want
    assert read_suite(nested) == want
    assert read_suite(json.dumps({"Title": nested})) == want


def test_verdicts_do_not_depend_on_partitions(spark, df):
    suite = [Expectation(f"expect_{c[0]}", c[1], tuple(c[2:])) for c, *_ in CASES]
    results = [
        sorted(map(str, quality.run_suite(d, suite).collect())) for d in (df, df.coalesce(1), df.repartition(5, "id"))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == len(suite)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    suite = [Expectation(f"expect_{c[0]}", c[1], tuple(c[2:])) for c, *_ in CASES]
    assert quality.run_suite(empty, suite).count() == len(suite)
    assert one(empty, "column_mean_to_be_between", "price", None, None)["success"] is False
    assert one(empty, "column_values_to_be_not_null", "price")["success"] is True
    assert one(empty, "column_median_to_be_between", "price", None, None)["success"] is False


def test_empty_suite(df):
    assert quality.run_suite(df, []).count() == 0


def test_wide_suite_reads_each_column_once(spark):
    wide = spark.range(10).selectExpr(*[f"id as c{i}" for i in range(60)])
    suite = [f"expect_column_values_to_be_not_null('c{i}')" for i in range(60)]
    results = quality.run_suite(wide, suite)
    assert results.where("success").count() == 60


@pytest.mark.parametrize(
    "fmt, good, bad",
    [
        ("%Y-%m-%d", "2024-02-29", "2023-02-29"),
        ("%d/%m/%Y %H:%M", "31/12/2024 23:59", "12/31/2024 23:59"),
        ("%Y%m%dT%H%M%S", "20240102T030405", "20240102 030405"),
        ("%H:%M:%S.%f", "03:04:05.000006", "25:00:00.000000"),
        ("%d %b %Y", "02 Jan 2024", "02 Foo 2024"),
    ],
)
def test_time_formats(spark, fmt, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "t string")
    assert one(df, "match_strftime_format", "t", fmt)["unexpected_count"] == 1


def test_unexpected_rows_against_brute_force(df):
    suite = [
        "expect_column_values_to_be_not_null('name')",
        "expect_column_values_to_be_unique('name')",
        "expect_column_values_to_be_null('price')",
        "expect_column_to_exist('id')",
        "expect_column_value_lengths_to_equal('name', 3)",
    ]
    got = sorted((r["id"], r["expectation"], str(r["value"])) for r in quality.unexpected_rows(df, suite, ["id"]).collect())
    want = [
        (1, "expect_column_value_lengths_to_equal", "a@b.co"),
        (1, "expect_column_values_to_be_null", "1.5"),
        (2, "expect_column_values_to_be_null", "2.5"),
        (2, "expect_column_values_to_be_unique", "x y"),
        (3, "expect_column_values_to_be_unique", "x y"),
        (4, "expect_column_values_to_be_not_null", "None"),
        (4, "expect_column_values_to_be_null", "4.0"),
    ]
    assert got == want
    assert quality.unexpected_rows(df, ["expect_column_to_exist('id')"], ["id"]).count() == 0


def test_long_texts_are_compared_whole(spark):
    base = "x" * 5000
    df = spark.createDataFrame([(1, base + "a"), (2, base + "b"), (3, base + "a")], "id int, t string")
    assert one(df, "column_values_to_be_unique", "t")["unexpected_count"] == 2
    rows = quality.unexpected_rows(df, ["expect_column_values_to_be_unique('t')"], ["id"]).collect()
    assert sorted(r["id"] for r in rows) == [1, 3] and {len(r["value"]) for r in rows} == {5001}


def test_summary(df):
    row = quality.summarize(quality.run_suite(df, ["expect_column_to_exist('id')", "expect_column_to_exist('x')"])).first()
    assert tuple(row) == (2, 1, 1, 50.0)


def test_single_checks_need_no_nested_loop(df):
    for call, *_ in CASES:
        plan = quality.check(df, f"expect_{call[0]}", *call[1:])._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
