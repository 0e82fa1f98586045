"""Data-quality expectations.

A suite costs one aggregation over the table, whatever its length, plus one pass over counted
values when a check looks at distinct values and one when it looks at the median. Checks of the
schema read no data. Every check gives one row of ``RESULT_SCHEMA``.

Rules: row checks look at values that are not null, except the two null checks; bounds are
inclusive and a null bound is open; an aggregate over no values fails; a check that cannot run
fails with the reason in ``error``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.suites import Expectation, read_suite
from quayside.operators.values import (
    attach_by_value,
    count_values,
    quantiles,
    value_key,
    value_stats,
    value_table,
)

RESULT_SCHEMA = (
    "expectation string, column_name string, args string, success boolean, observed string, "
    "element_count bigint, unexpected_count bigint, unexpected_pct double, error string"
)
CHECKS_PER_PASS = 40

# What counts as an e-mail address and as a special character.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"
SPECIAL = "[^A-Za-z0-9 ]"

# Time directives and their pattern letters; digits are zero-padded.
DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%j": "DDD",
    "%H": "HH",
    "%I": "hh",
    "%p": "a",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%%": "%",
}
DEFAULT_FORMAT = "%Y-%m-%d %H:%M:%S"

# Date layouts that count as parseable besides what a plain cast takes.
PARSEABLE = (
    "yyyy/MM/dd[ HH:mm:ss]",
    "yyyyMMdd",
    "MM/dd/yyyy[ HH:mm:ss]",
    "dd-MM-yyyy[ HH:mm:ss]",
    "dd MMM yyyy[ HH:mm:ss]",
    "dd MMMM yyyy[ HH:mm:ss]",
    "MMM dd, yyyy[ HH:mm:ss]",
    "MMMM dd, yyyy[ HH:mm:ss]",
)

# Type names a suite may use.
TYPE_NAMES = {
    "string": T.StringType,
    "str": T.StringType,
    "int": T.IntegerType,
    "integer": T.IntegerType,
    "long": T.LongType,
    "bigint": T.LongType,
    "short": T.ShortType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "decimal": T.DecimalType,
    "boolean": T.BooleanType,
    "bool": T.BooleanType,
    "date": T.DateType,
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}


def time_pattern(fmt: str) -> str | None:
    """A strftime format as a datetime pattern; None for a directive that is not served."""
    out: list[str] = []
    literal, at = "", 0
    while at < len(fmt):
        piece = fmt[at : at + (2 if fmt[at] == "%" else 1)]
        if piece[0] == "%" and piece not in DIRECTIVES:
            return None
        if piece[0] != "%" or piece == "%%":
            literal += piece[-1]
        else:
            out += [_quoted(literal), DIRECTIVES[piece]]
            literal = ""
        at += len(piece)
    return "".join([*out, _quoted(literal)])


def _quoted(literal: str) -> str:
    """Text between directives as it stands: brackets, braces and hashes mean something in patterns."""
    return "'" + literal.replace("'", "''") + "'" if literal else ""


# --- checks of single rows ----------------------------------------------------------------------


@dataclass(frozen=True)
class RowCheck:
    """``bad(value, args)`` is true for a row that breaks the rule."""

    bad: Callable[[Column, tuple], Column]
    args: tuple[int, ...] = (0,)
    sees_nulls: bool = False


def _strftime_bad(value: Column, args: tuple) -> Column:
    pattern = time_pattern(args[0] if args else DEFAULT_FORMAT)
    return F.try_to_timestamp(value.cast("string"), F.lit(pattern)).isNull()


def _unparseable(value: Column, _: tuple) -> Column:
    text = value.cast("string")
    forms = [F.try_to_timestamp(text, F.lit(p)) for p in PARSEABLE]
    return F.coalesce(text.try_cast("timestamp"), *forms).isNull()


def _outside(value: Column, low, high) -> Column:
    checks = [value < F.lit(low)] if low is not None else []
    checks += [value > F.lit(high)] if high is not None else []
    return reduce(lambda a, b: a | b, checks, F.lit(False))


ROW_CHECKS: dict[str, RowCheck] = {
    "expect_column_values_to_be_null": RowCheck(lambda v, a: v.isNotNull(), sees_nulls=True),
    "expect_column_values_to_be_not_null": RowCheck(lambda v, a: v.isNull(), sees_nulls=True),
    "expect_column_values_to_contain_valid_email": RowCheck(lambda v, a: ~F.rlike(v.cast("string"), F.lit(EMAIL))),
    "expect_column_values_not_contain_special_character": RowCheck(
        lambda v, a: F.rlike(v.cast("string"), F.lit(SPECIAL))
    ),
    "expect_match_strftime_format": RowCheck(_strftime_bad, args=(0, 1)),
    "expect_column_values_to_be_dateutil_parseable": RowCheck(_unparseable),
    "expect_column_value_lengths_to_be_between": RowCheck(
        lambda v, a: _outside(F.length(v.cast("string")), a[0], a[1]), args=(2,)
    ),
    "expect_column_value_lengths_to_equal": RowCheck(
        lambda v, a: F.length(v.cast("string")) != F.lit(a[0]), args=(1,)
    ),
    "expect_column_value_int_data_type_check": RowCheck(lambda v, a: v.try_cast("int").isNull()),
    "expect_column_value_long_data_type_check": RowCheck(lambda v, a: v.try_cast("bigint").isNull()),
}

# Types that answer a type check without reading data.
DECLARED = {
    "expect_column_value_int_data_type_check": (T.IntegerType,),
    "expect_column_value_long_data_type_check": (T.LongType, T.IntegerType),
    "expect_column_value_string_data_type_check": (T.StringType,),
}

# --- checks of one aggregate --------------------------------------------------------------------

COLUMN_AGGREGATES = ("max", "min", "mean", "sum")
VALUE_CHECKS = (
    "expect_column_values_to_be_unique",
    "expect_column_unique_value_count_to_be_between",
    "expect_column_proportion_of_unique_values_to_be_between",
)
MEDIAN_CHECK = "expect_column_median_to_be_between"
SCHEMA_CHECKS = (
    "expect_column_to_exist",
    "expect_column_values_to_be_in_type_list",
    "expect_column_value_string_data_type_check",
    "expect_table_column_count_to_be_between",
    "expect_table_column_count_to_equal",
)
TABLE_CHECKS = ("expect_table_row_count_to_be_between", "expect_table_row_count_to_equal")
AGGREGATE_CHECKS = tuple(f"expect_column_{name}_to_be_between" for name in COLUMN_AGGREGATES)
ALL_CHECKS = (*SCHEMA_CHECKS, *ROW_CHECKS, *AGGREGATE_CHECKS, MEDIAN_CHECK, *VALUE_CHECKS, *TABLE_CHECKS)


def _arg_counts(name: str) -> tuple[int, ...]:
    if name in ROW_CHECKS:
        return ROW_CHECKS[name].args
    if name.endswith("_between"):
        return (2,)
    if name.endswith("_to_equal"):
        return (1,)
    return (0,)


def _problem(df: DataFrame, item: Expectation) -> str | None:
    """Why a check cannot run on this table, or None."""
    if item.error:
        return item.error
    if item.name not in ALL_CHECKS:
        return "unknown expectation"
    if item.name.startswith("expect_table_"):
        if len(item.args) not in _arg_counts(item.name):
            return "wrong number of arguments"
        return None if all(_fits(b, T.LongType()) for b in item.args) else "bound does not fit the column"
    if item.column is None:
        return "no column"
    if item.column not in df.columns:
        return "column not found"
    if item.name == "expect_column_values_to_be_in_type_list":
        return None if item.args else "wrong number of arguments"
    if len(item.args) not in _arg_counts(item.name):
        return "wrong number of arguments"
    kind = df.schema[item.column].dataType
    if item.name in (*AGGREGATE_CHECKS[2:], MEDIAN_CHECK) and not isinstance(kind, T.NumericType):
        return "column is not numeric"
    if item.name in AGGREGATE_CHECKS[:2] and not has_order(kind):
        return "column has no order"
    if item.name.endswith(("_between", "_equal")) and not all(_fits(b, _bound_type(item, kind)) for b in item.args):
        return "bound does not fit the column"
    if item.name == "expect_match_strftime_format" and item.args and not isinstance(item.args[0], str):
        return "time format is not a text"
    if item.name == "expect_match_strftime_format" and item.args and time_pattern(item.args[0]) is None:
        return "time format is not served"
    return None


def has_order(kind: T.DataType) -> bool:
    """Whether values of a type have a least and a greatest one."""
    if isinstance(kind, T.ArrayType):
        return has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _bound_type(item: Expectation, kind: T.DataType) -> T.DataType:
    return kind if item.name in AGGREGATE_CHECKS[:2] else T.DoubleType()


def _fits(bound, kind: T.DataType) -> bool:
    """Whether a bound can be compared with values of the type; a missing one always can."""
    if bound is None:
        return True
    if isinstance(kind, T.NumericType):
        return isinstance(bound, (int, float, Decimal)) and not isinstance(bound, bool)
    if isinstance(kind, T.StringType):
        return isinstance(bound, (str, int, float, Decimal))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(bound, (dt.date, dt.datetime)):
            return True
        try:
            return isinstance(bound, str) and bool(dt.datetime.fromisoformat(bound.strip()))
        except ValueError:
            return False
    return isinstance(kind, T.BooleanType) and isinstance(bound, bool)


def _within(value, bounds: tuple) -> bool:
    low, high = bounds
    return (low is None or value >= low) and (high is None or value <= high)


def _from_schema(df: DataFrame, item: Expectation) -> tuple[bool, str] | None:
    """Verdict and observation from column names and types alone; None when data must be read."""
    if item.name == "expect_column_to_exist":
        return True, item.column
    if item.name.startswith("expect_table_column_count_"):
        width = len(df.columns)
        good = _within(width, item.args) if item.name.endswith("_between") else width == item.args[0]
        return good, str(width)
    if item.column is None:
        return None
    kind = df.schema[item.column].dataType
    if item.name == "expect_column_values_to_be_in_type_list":
        wanted = [TYPE_NAMES.get(str(name).lower().removesuffix("type")) for name in item.args]
        return any(w is not None and isinstance(kind, w) for w in wanted), kind.simpleString()
    if item.name in DECLARED:
        is_text = isinstance(kind, T.StringType)
        if item.name in ROW_CHECKS and is_text:
            return None
        return isinstance(kind, DECLARED[item.name]), kind.simpleString()
    return None


def observed_text(value: Column, kind: T.DataType) -> Column:
    """An observation as text: fractions with six digits, all else as it casts."""
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return F.coalesce(F.round(value, 6).try_cast("decimal(38,6)").cast("string"), value.cast("string"))
    return value.cast("string")


def _bounded(value: Column, bounds: tuple, kind: T.DataType) -> Column:
    def literal(bound) -> Column:
        return F.lit(bound) if isinstance(kind, T.NumericType) else F.lit(bound).cast(kind)

    low, high = bounds
    checks = [value.isNotNull()]
    checks += [value >= literal(low)] if low is not None else []
    checks += [value <= literal(high)] if high is not None else []
    return F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))


def _percent(bad: Column, seen: Column) -> Column:
    return F.when(seen > 0, F.lit(100.0) * bad / seen)


def _result(
    item: Expectation,
    success: Column,
    observed: Column | None = None,
    elements: Column | None = None,
    unexpected: Column | None = None,
    error: Column | None = None,
) -> Column:
    null = F.lit(None)
    percent = null if unexpected is None else _percent(unexpected, elements)
    return F.struct(
        F.lit(item.name).alias("expectation"),
        F.lit(item.column).cast("string").alias("column_name"),
        F.lit(item.args_text).alias("args"),
        success.alias("success"),
        (null if observed is None else observed).cast("string").alias("observed"),
        (null if elements is None else elements).cast("bigint").alias("element_count"),
        (null if unexpected is None else unexpected).cast("bigint").alias("unexpected_count"),
        percent.cast("double").alias("unexpected_pct"),
        (null if error is None else error).cast("string").alias("error"),
    )


# --- the passes -------------------------------------------------------------------------------


def _aggregate_pass(df: DataFrame, items: Sequence[Expectation]) -> DataFrame:
    """Row checks, column aggregates and row counts in one aggregation."""
    aggs: dict[str, Column] = {"rows": F.count(F.lit(1))}
    results: list[Column] = []
    rows = F.col("rows")
    for at, item in enumerate(items):
        if item.name in TABLE_CHECKS:
            bounds = item.args if len(item.args) == 2 else (item.args[0], item.args[0])
            results.append(_result(item, _bounded(rows, bounds, T.LongType()), rows, rows))
            continue
        value, kind = F.col(item.column), df.schema[item.column].dataType
        seen = f"seen_{df.columns.index(item.column)}"
        aggs[seen] = F.count(value)
        if item.name in ROW_CHECKS:
            check = ROW_CHECKS[item.name]
            bad = check.bad(value, item.args)
            aggs[f"bad_{at}"] = F.count_if(bad if check.sees_nulls else value.isNotNull() & bad)
            found, elements = F.col(f"bad_{at}"), rows if check.sees_nulls else F.col(seen)
            results.append(_result(item, found == 0, None, elements, found))
            continue
        how = item.name.removeprefix("expect_column_").removesuffix("_to_be_between")
        whole = isinstance(kind, T.IntegralType)
        # Whole numbers are summed as decimals: exact, in any order, past the range of a long.
        summed = value.cast("decimal(20,0)") if whole else value
        aggs[f"agg_{at}"] = {"max": F.max, "min": F.min, "mean": F.try_avg, "sum": F.try_sum}[how](
            summed if how == "sum" else value
        )
        got = F.col(f"agg_{at}")
        shown = observed_text(got, T.DoubleType()) if how == "mean" else observed_text(
            got, T.LongType() if whole else kind
        )
        results.append(_result(item, _bounded(got, item.args, kind), shown, F.col(seen)))
    one = df.agg(*[expr.alias(name) for name, expr in aggs.items()])
    return one.select(F.inline(F.array(*results)))


def _value_pass(df: DataFrame, items: Sequence[Expectation]) -> DataFrame:
    """Checks of distinct values: the values of a column are counted once for all its checks."""
    unique, count, _ = VALUE_CHECKS
    seen, distinct = F.col("value_count"), F.col("distinct_count")
    share = F.when(seen > 0, distinct / seen)
    parts = []
    for column in dict.fromkeys(i.column for i in items):
        results = []
        for item in (i for i in items if i.column == column):
            if item.name == unique:
                found = F.col("repeated_count")
                results.append(_result(item, found == 0, None, seen, found))
                continue
            got, kind = (distinct, T.LongType()) if item.name == count else (share, T.DoubleType())
            results.append(_result(item, _bounded(got, item.args, kind), observed_text(got, kind), seen))
        parts.append(value_stats(df, [column]).select(F.inline(F.array(*results))))
    return reduce(DataFrame.unionByName, parts)


def _median_pass(df: DataFrame, items: Sequence[Expectation]) -> DataFrame:
    columns = list(dict.fromkeys(i.column for i in items))
    counts = df.agg(*[F.count(c).alias(f"seen_{at}") for at, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"seen_{at}").alias("seen")) for at, c in enumerate(columns)]
    measured = counts.select(F.inline(F.array(*cells))).join(
        quantiles(df, columns, [0.5]), F.col("name") == F.col("column_name"), "left"
    )
    got, kind = F.col("quantile"), T.DoubleType()
    results = [_result(i, _bounded(got, i.args, kind), observed_text(got, kind), F.col("seen")) for i in items]
    own = F.filter(F.array(*results), lambda result: result["column_name"] == F.col("name"))
    return measured.select(F.inline(own))


def run_suite(df: DataFrame, suite) -> DataFrame:
    """Evaluate a suite on a table: one row of ``RESULT_SCHEMA`` for each expectation.

    The table is read by several passes, each of some columns. Hand in a columnar table; write a
    computed or a text one with ``durable`` first, so that it is made once.
    """
    items = read_suite(suite)
    known: list[tuple] = []
    by_pass: dict[str, list[Expectation]] = {"agg": [], "values": [], "median": []}
    for item in items:
        problem = _problem(df, item)
        if problem:
            known.append((item.name, item.column, item.args_text, False, None, None, None, None, problem))
            continue
        verdict = _from_schema(df, item)
        if verdict is not None:
            known.append((item.name, item.column, item.args_text, *verdict, None, None, None, None))
        elif item.name in VALUE_CHECKS:
            by_pass["values"].append(item)
        elif item.name == MEDIAN_CHECK:
            by_pass["median"].append(item)
        else:
            by_pass["agg"].append(item)
    parts = [df.sparkSession.createDataFrame(known, RESULT_SCHEMA)] if known or not items else []
    parts += [_aggregate_pass(df, chunk) for chunk in _chunks(df, by_pass["agg"])]
    parts += [_value_pass(df, by_pass["values"])] if by_pass["values"] else []
    parts += [_median_pass(df, by_pass["median"])] if by_pass["median"] else []
    return reduce(DataFrame.unionByName, parts)


def _chunks(df: DataFrame, items: Sequence[Expectation]) -> list[list[Expectation]]:
    """Checks by the pass that evaluates them.

    A pass is narrow enough for generated code and keeps a column's checks together, so each column
    is read once. The least and the greatest text go apart: one of them takes a whole aggregation
    off the fast path.
    """
    def is_text(item: Expectation) -> bool:
        ends = item.name in AGGREGATE_CHECKS[:2]
        return ends and not isinstance(df.schema[item.column].dataType, (T.NumericType, T.DatetimeType, T.BooleanType))

    passes: list[list[Expectation]] = []
    for kind in (False, True):
        wanted = [i for i in items if is_text(i) == kind]
        chunk: list[Expectation] = []
        for column in dict.fromkeys(i.column for i in wanted):
            group = [i for i in wanted if i.column == column]
            if chunk and len(chunk) + len(group) > CHECKS_PER_PASS:
                passes.append(chunk)
                chunk = []
            chunk = chunk + group
        passes += [chunk] if chunk else []
    return passes


def summarize(results: DataFrame) -> DataFrame:
    """Evaluated, passed and failed checks and the share that passed."""
    passed = F.count_if("success")
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        passed.alias("passed"),
        (F.count(F.lit(1)) - passed).alias("failed"),
        (F.lit(100.0) * passed / F.count(F.lit(1))).alias("success_pct"),
    )


def unexpected_rows(df: DataFrame, suite, keys: Sequence[str]) -> DataFrame:
    """Every row that breaks a row check or repeats a value that must be unique.

    ``keys`` of the row, the check, its column and the value. Row checks share one scan; repeated
    values are found from counted values and looked up in a way that stands hot ones.
    """
    items = [i for i in read_suite(suite) if not _problem(df, i) and _from_schema(df, i) is None]
    parts = []
    cells = []
    for item in items:
        if item.name in ROW_CHECKS:
            check, value = ROW_CHECKS[item.name], F.col(item.column)
            bad = check.bad(value, item.args)
            cell = F.struct(
                F.lit(item.name).alias("expectation"),
                F.lit(item.column).alias("column_name"),
                value.cast("string").alias("value"),
            )
            cells.append(F.when(bad if check.sees_nulls else value.isNotNull() & bad, cell))
    if cells:
        parts.append(df.select(*keys, F.inline(F.array_compact(F.array(*cells)))))
    for item in items:
        if item.name == VALUE_CHECKS[0]:
            again = count_values(df, value_key(df, item.column)).where(F.col("n") > 1)
            table = value_table(again.withColumn("times", F.col("n")))
            narrow = df.select(
                *keys,
                F.lit(item.name).alias("expectation"),
                F.lit(item.column).alias("column_name"),
                F.col(item.column).alias("value"),
            )
            found = attach_by_value(narrow, value_key(narrow, "value"), table, "times")
            found = found.withColumn("value", F.col("value").cast("string"))
            parts.append(found.where(F.col("times").isNotNull()).drop("times"))
    if not parts:
        empty = df.select(*keys).schema.add("expectation", "string").add("column_name", "string").add("value", "string")
        return df.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)


def check(df: DataFrame, name: str, column: str | None = None, *args) -> DataFrame:
    """Evaluate one expectation."""
    return run_suite(df, [Expectation(name, column, tuple(args))])


def suite_of(checks: Mapping[str, Sequence]) -> list[Expectation]:
    """A suite from ``{name: [(column, args...), ...]}``."""
    return [Expectation(n, c[0], tuple(c[1:])) for n, listed in checks.items() for c in listed]
