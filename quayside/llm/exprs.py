"""Column helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import durable

#: A word is a run of anything but these blanks.
BLANKS = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
MOST_FILES = 50_000  # file names that are broadcast, some 5 MB


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once for each row, whatever the optimizer folds together."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """The words of a text in their order; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {name.lower() for name in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number that no other row has, the same one wherever the rows are read.

    Rows of files are told by their file and place, so nothing is written; other rows are written once.
    """
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias(f"{name}_file"), F.col("_metadata.row_index").alias(f"{name}_place"))
    except AnalysisException:
        return durable(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    paths = sorted(r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect())  # names of files, no rows
    files = df.sparkSession.createDataFrame([(p, n) for n, p in enumerate(paths)], f"`{name}_file` string, `{name}_at` long")
    # A row for each file, broadcast while there are few, so that rows are numbered where they are read.
    both = placed.join(F.broadcast(files) if len(paths) <= MOST_FILES else files, f"{name}_file")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], (F.shiftleft(f"{name}_at", 40) + F.col(f"{name}_place")).alias(name))
