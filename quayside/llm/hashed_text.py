"""Hashed features of words, for models that are trained here."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLASSES = [(re.compile(r"[^\W\d_]*[^\W\d_A-ZÀ-Þ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_]+"), "A"), (re.compile(r"\d+"), "0")]


def bucket(text: str, size: int, salt: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), salt) % size


def shape(word: str) -> str:
    """Runs of letters (with small ones, capitals only) and digits by one mark each, other characters as they are."""
    for pattern, mark in _CLASSES:
        word = pattern.sub(mark, word)
    return word[:12]


def char_grams(word: str, sizes: Iterable[int] = (3, 4)) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for n in sizes for i in range(max(len(marked) - n + 1, 1))]


#: Grades that a rating may have; a rating with more is refused, never cut.
MOST_GRADES = 16


def held_out(doc_id: Column) -> Column:
    """A third of the ids, by checksum: their labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, grade: Column, per_grade: int, longest: int, doc_id: str = "doc_id", text: str = "text"
) -> list[tuple[int, str]]:
    """At most ``per_grade`` labelled texts of each grade, of at most ``longest`` characters.

    Rows are chosen by the hash of their id among those that may be learnt, so that the choice does
    not depend on partitioning. The bound holds for what reaches the driver: grades times
    ``per_grade`` times ``longest`` characters.
    """
    key = F.col(doc_id)
    rated = labels.where(~held_out(key)).select(key.alias("id"), grade.alias("grade")).where("grade is not null").distinct()
    grades = sorted(r["grade"] for r in rated.select("grade").distinct().limit(MOST_GRADES + 1).collect())
    if len(grades) > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} different grades")
    short = docs.where(F.length(text) <= longest).select(key.alias("id"), F.col(text).alias("text"))
    order = [F.xxhash64("id"), F.col("id"), F.col("grade")]
    out = []
    for g in grades:
        # Twice as many ids as wanted, since some texts are too long; a bounded table.
        ids = rated.where(F.col("grade") == g).orderBy(*order).limit(2 * per_grade)
        met = short.join(F.broadcast(ids), "id").orderBy(*order, "text").limit(per_grade)
        out += [(r["grade"], r["text"]) for r in met.collect()]
    return out


def doc_batches(batches: Iterable[pa.RecordBatch], chars: int):
    """``(batch, start, stop, texts)`` in pieces of about ``chars`` characters."""
    for batch in batches:
        column = batch.column("__text")
        start = 0
        while start < batch.num_rows:
            texts, held = [], 0
            while start + len(texts) < batch.num_rows and held < chars:
                text = column[start + len(texts)].as_py() or ""
                texts.append(text)
                held += len(text)
            yield batch, start, start + len(texts), texts
            start += len(texts)
