"""The expectations: one query each, and suites of them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from quayside.catalog.fixtures import COMPLEX_TYPES, CUSTOMER_DQ
from quayside.catalog.registry import query
from quayside.operators.quality import EMAIL, SPECIAL, run_suite, summarize, unexpected_rows
from quayside.session import durable

SOURCE = f"({CUSTOMER_DQ}) c"


def _row(name, column, args, success, observed="null", elements="null", unexpected="null", error="null") -> str:
    percent = "null" if unexpected == "null" else f"case when {elements} > 0 then 100::double * {unexpected} / {elements} end"
    return f"""select 'expect_{name}' as expectation, {f"'{column}'" if column else 'cast(null as varchar)'} as column_name,
      '{json.dumps(list(args))}' as args, {success} as success, cast({observed} as varchar) as observed,
      cast({elements} as bigint) as element_count, cast({unexpected} as bigint) as unexpected_count,
      cast({percent} as double) as unexpected_pct, cast({error} as varchar) as error"""


def row_check(name: str, column: str, args: Sequence, bad: str, nulls: bool = False, source: str = SOURCE) -> str:
    """A check of single rows: ``bad`` is true for a value that breaks it."""
    counted = "count(*)" if nulls else f'count("{column}")'
    inner = f'select {counted} as n, count(*) filter (where {bad}) as u from {source}'
    return f"{_row(name, column, args, 'u = 0', 'null', 'n', 'u')} from ({inner}) q"


def aggregate(name: str, column: str, args: Sequence, value: str, shown: str = "v", source: str = SOURCE) -> str:
    inner = f'select {value} as v, count("{column}") as n from {source}'
    return f"{_row(name, column, args, f'coalesce(v between {args[0]} and {args[1]}, false)', shown, 'n')} from ({inner}) q"


def _six(value: str) -> str:
    return f"cast(round({value}, 6) as decimal(38,6))"


DISTINCT_SHARE = "count(distinct \"{0}\")::double / nullif(count(\"{0}\"), 0)"
COLUMNS = 11

# (name without prefix, column, arguments, SQL). One case for each column a suite names.
CASES: list[tuple[str, str | None, list, str]] = []


def _case(name: str, column: str | None, args: list, sql: str) -> None:
    CASES.append((name, column, args, sql))


for _c in ("customer_id", "age", "timestamp", "insertion_timestamp"):
    _case("column_to_exist", _c, [], _row("column_to_exist", _c, [], "true", f"'{_c}'"))
_case(
    "column_to_exist",
    "no_such_column",
    [],
    _row("column_to_exist", "no_such_column", [], "false", error="'column not found'"),
)
for _c in ("customer_id", "customer_name", "segment"):
    _case("column_values_to_be_null", _c, [], row_check("column_values_to_be_null", _c, [], f"{_c} is not null", True))
    _case(
        "column_values_to_be_not_null",
        _c,
        [],
        row_check("column_values_to_be_not_null", _c, [], f"{_c} is null", True),
    )
for _c, _args in (("customer_id", [1, 10]), ("postal_code", [0.1, 0.5])):
    _name = "column_proportion_of_unique_values_to_be_between"
    _case(_name, _c, _args, aggregate(_name, _c, _args, DISTINCT_SHARE.format(_c), _six("v")))
_name = "column_value_int_data_type_check"
_case(_name, "age", [], _row(_name, "age", [], "true", "'int'"))
_case(_name, "city", [], row_check(_name, "city", [], "city is not null and try_cast(city as int) is null"))
_name = "column_value_string_data_type_check"
_case(_name, "region", [], _row(_name, "region", [], "true", "'string'"))
_case(_name, "age", [], _row(_name, "age", [], "false", "'int'"))
_name = "column_value_long_data_type_check"
_case(_name, "postal_code", [], _row(_name, "postal_code", [], "true", "'bigint'"))
_case(_name, "segment", [], row_check(_name, "segment", [], "segment is not null and try_cast(segment as bigint) is null"))
_name = "column_values_to_be_in_type_list"
_case(_name, "customer_id", ["String"], _row(_name, "customer_id", ["String"], "true", "'string'"))
_case(_name, "age", ["String", "Long"], _row(_name, "age", ["String", "Long"], "false", "'int'"))
_name = "column_values_to_be_unique"
for _c in ("customer_id", "customer_name"):
    _case(
        _name,
        _c,
        [],
        _row(_name, _c, [], "u = 0", "null", "n", "u")
        + f""" from (select coalesce(sum(k), 0) as n, coalesce(sum(k) filter (where k > 1), 0) as u
               from (select count(*) as k from {SOURCE} where {_c} is not null group by {_c}) g) q""",
    )
_name = "column_unique_value_count_to_be_between"
for _c, _args in (("customer_id", [1, 1000]), ("state", [1, 50])):
    _case(_name, _c, _args, aggregate(_name, _c, _args, f"count(distinct {_c})"))
_name = "column_values_to_contain_valid_email"
for _c in ("customer_id", "customer_name"):
    _case(_name, _c, [], row_check(_name, _c, [], f"not regexp_matches({_c}, '{EMAIL}')"))
_name = "column_values_not_contain_special_character"
for _c in ("customer_id", "customer_name"):
    _case(_name, _c, [], row_check(_name, _c, [], f"regexp_matches({_c}, '{SPECIAL}')"))
_name = "match_strftime_format"
for _c, _args in (("timestamp", []), ("timestamp", ["%Y-%m-%d"])):
    _fmt = _args[0] if _args else "%Y-%m-%d %H:%M:%S"
    _case(_name, _c, _args, row_check(_name, _c, _args, f"{_c} is not null and try_strptime({_c}, '{_fmt}') is null"))
_name = "column_values_to_be_dateutil_parseable"
_case(_name, "timestamp", [], row_check(_name, "timestamp", [], "try_cast(timestamp as timestamp) is null"))
_case(_name, "country", [], row_check(_name, "country", [], "country is not null"))
_name = "column_value_lengths_to_be_between"
for _c, _args in (("customer_id", [1, 4]), ("state", [1, 5])):
    _case(_name, _c, _args, row_check(_name, _c, _args, f"length({_c}) not between {_args[0]} and {_args[1]}"))
_name = "column_value_lengths_to_equal"
_case(_name, "city", [6], row_check(_name, "city", [6], "length(city) <> 6"))
for _name, _fn in (("max", "max"), ("min", "min")):
    _full = f"column_{_name}_to_be_between"
    for _c, _args in (("age", [10, 70]), ("postal_code", [10000, 12000])):
        _case(_full, _c, _args, aggregate(_full, _c, _args, f"{_fn}({_c})"))
_name = "column_mean_to_be_between"
for _c, _args in (("age", [1, 50]), ("postal_code", [1, 5])):
    _case(_name, _c, _args, aggregate(_name, _c, _args, f"avg({_c})", _six("v")))
_name = "column_median_to_be_between"
for _c, _args in (("age", [1, 50]), ("postal_code", [1, 5])):
    _case(_name, _c, _args, aggregate(_name, _c, _args, f"median({_c})", _six("v")))
_name = "column_sum_to_be_between"
for _c, _args in (("age", [1, 10]), ("postal_code", [1, 1000000000000])):
    _case(_name, _c, _args, aggregate(_name, _c, _args, f"sum({_c})"))
_case(
    "table_column_count_to_be_between",
    None,
    [1, 5],
    _row("table_column_count_to_be_between", None, [1, 5], "false", f"'{COLUMNS}'"),
)
_case(
    "table_column_count_to_equal",
    None,
    [COLUMNS],
    _row("table_column_count_to_equal", None, [COLUMNS], "true", f"'{COLUMNS}'"),
)
for _name, _args, _good in (
    ("table_row_count_to_be_between", [1, 1000000000], "n between 1 and 1000000000"),
    ("table_row_count_to_equal", [10000], "n = 10000"),
):
    _case(_name, None, _args, f"{_row(_name, None, _args, _good, 'n', 'n')} from (select count(*) as n from {SOURCE}) q")


def _items(cases) -> list[str]:
    """Cases as calls."""
    out = []
    for name, column, args, _ in cases:
        inside = ",".join(repr(a) for a in ([column] if column else []) + list(args))
        out.append(f"expect_{name}({inside})")
    return out


def _register_expectations() -> None:
    for name in dict.fromkeys(case[0] for case in CASES):
        cases = [case for case in CASES if case[0] == name]

        def run(spark, t, suite=tuple(_items(cases))):
            return run_suite(t.sql(CUSTOMER_DQ), list(suite))

        query(f"expect_{name}", " union all ".join(case[3] for case in cases))(run)


_register_expectations()


def _staged(t):
    """The view as a written table: a suite reads its input several times, and this one is a join."""
    return durable(t.sql(CUSTOMER_DQ), "customer-dq")


def nested_suite(cases) -> dict:
    """Cases in the nested form: each column followed by its arguments."""
    suite: dict[str, dict] = {}
    for name, column, args, _ in cases:
        if column is None:
            suite[name] = {"values": list(args)}
        else:
            listed = suite.setdefault(name, {"columns": []})["columns"]
            listed.append(column)
            if args:
                listed.append(list(args))
    return {"Suite": suite}


ALL_SQL = " union all ".join(case[3] for case in CASES)


@query("dq_suite", ALL_SQL)
def _dq_suite(spark, t):
    return run_suite(_staged(t), json.dumps(nested_suite(CASES)))


@query(
    "dq_summary",
    f"""select count(*) as evaluated, count(*) filter (where success) as passed,
        count(*) filter (where not success) as failed,
        100::double * count(*) filter (where success) / count(*) as success_pct from ({ALL_SQL}) r""",
)
def _dq_summary(spark, t):
    return summarize(run_suite(_staged(t), _items(CASES)))


def _live(column: str) -> tuple[list[str], str]:
    calls = [
        f"expect_column_values_to_be_null('{column}')",
        f"expect_column_to_exist('{column}')",
        f"expect_column_proportion_of_unique_values_to_be_between('{column}',1,10)",
    ]
    source, name = f"({COMPLEX_TYPES}) c", "column_proportion_of_unique_values_to_be_between"
    sql = [
        row_check("column_values_to_be_null", column, [], f'"{column}" is not null', True, source),
        _row("column_to_exist", column, [], "true", f"'{column}'"),
        aggregate(name, column, [1, 10], DISTINCT_SHARE.format(column), _six("v"), source),
    ]
    return calls, " union all ".join(sql)


_INT, _CARD = _live("int"), _live("masterCard")


@query("dq_suite_calls", f"{_INT[1]} union all {_CARD[1]}")
def _dq_suite_calls(spark, t):
    return run_suite(t.sql(COMPLEX_TYPES), _INT[0] + _CARD[0])


UNEXPECTED = [
    "expect_column_values_to_be_not_null('customer_name')",
    "expect_column_values_to_be_not_null('age')",
    "expect_match_strftime_format('timestamp')",
    "expect_column_values_not_contain_special_character('customer_name')",
    "expect_column_value_lengths_to_be_between('customer_id', 1, 4)",
    "expect_column_values_to_be_unique('customer_name')",
]


@query(
    "dq_unexpected_rows",
    f"""
    with c as ({CUSTOMER_DQ})
    select customer_id, 'expect_column_values_to_be_not_null' as expectation, 'customer_name' as column_name,
      cast(null as varchar) as value from c where customer_name is null
    union all select customer_id, 'expect_column_values_to_be_not_null', 'age', null from c where age is null
    union all select customer_id, 'expect_match_strftime_format', 'timestamp', timestamp from c
      where try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') is null
    union all select customer_id, 'expect_column_values_not_contain_special_character', 'customer_name', customer_name
      from c where regexp_matches(customer_name, '{SPECIAL}')
    union all select customer_id, 'expect_column_value_lengths_to_be_between', 'customer_id', customer_id from c
      where length(customer_id) not between 1 and 4
    union all select customer_id, 'expect_column_values_to_be_unique', 'customer_name', customer_name from c
      where customer_name in (select customer_name from c group by 1 having count(*) > 1)
    """,
)
def _dq_unexpected(spark, t):
    return unexpected_rows(_staged(t), UNEXPECTED, ["customer_id"])


# Checks that cannot run, each with the reason for its row, over a table with a column of each kind.
MISTAKES = [
    ("expect_column_max_to_be_between('d', 1, 10)", "d", "bound does not fit the column"),
    ("expect_column_max_to_be_between('d', 'x', 'y')", "d", "bound does not fit the column"),
    ("expect_column_min_to_be_between('i', 'a', 'b')", "i", "bound does not fit the column"),
    ("expect_column_value_lengths_to_be_between('s', 'a', 'b')", "s", "bound does not fit the column"),
    ("expect_column_mean_to_be_between('i', 'a', None)", "i", "bound does not fit the column"),
    ("expect_column_median_to_be_between('i', 'a', None)", "i", "bound does not fit the column"),
    ("expect_column_max_to_be_between('m', 1, 2)", "m", "column has no order"),
    ("expect_table_row_count_to_be_between('a', 'b')", None, "bound does not fit the column"),
    ("expect_table_column_count_to_be_between('a', 'b')", None, "bound does not fit the column"),
    ("expect_match_strftime_format('s', '%Q')", "s", "time format is not served"),
]
_MISTAKES_SQL = " union all ".join(
    f"""select '{call.split("(")[0]}' as expectation, {f"'{column}'" if column else "cast(null as varchar)"} as column_name,
    false as success, '{error}' as error, count(*) >= 0 as has_rows from {{orders}}"""
    for call, column, error in MISTAKES
)


@query("dq_suite_mistakes", _MISTAKES_SQL)
def _dq_suite_mistakes(spark, t):
    """A check that cannot run gives a row with its reason; the others run."""
    table = t.orders.selectExpr(
        "cast(o_orderkey as int) as i", "cast(o_orderdate as date) as d", "o_orderstatus as s", "map('k', o_orderkey) as m"
    )
    suite = [call for call, _, _ in MISTAKES] + ["expect_table_row_count_to_be_between(0, None)"]
    results = run_suite(table, suite)
    good = results.where("error is null").agg({"success": "min"}).first()[0]  # of the one check that runs
    return results.where("error is not null").selectExpr("expectation", "column_name", "success", "error", f"{str(good).lower()} as has_rows")
