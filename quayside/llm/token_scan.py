"""Token counts of flat token files: a vectorised search for end-of-document ids, block by block.

A flat file is nothing but token ids in a row, a separator after each document, and no index. Its
blocks of equal length are searched independently; what a block knows of the document that it ends
first lies in blocks before it. Two prefix sums put that together: separators before the block give
the ordinals of its documents, and the place after the last separator before it gives where the
first one starts. Both go over stretches of blocks first and then over blocks inside a stretch, so
a file of any length is spread over tasks.

Defined results: tokens behind the last separator are an unterminated document; two separators in a
row are an empty document; a file without tokens has no documents. A null text becomes an empty
document, rows that repeat an id one document each. Only the named columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.session import run_folder

BLOCK = 1 << 16  # tokens
STRETCH = 1 << 10  # blocks
#: Fixed value: how the public byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODERS: dict[str, object] = {}


def load(ranks: str):
    """The encoder of a rank file, read once for each worker process."""
    if ranks not in _ENCODERS:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[ranks] = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[ranks]


FLAT_SCHEMA = "kind string, file bigint, seq bigint, data binary, id bigint"


def _flatten(ranks: str, separator: int, width: str, block: int):
    def rows(kind: str, file: int, first: int, data: list, ids: list) -> pa.RecordBatch:
        n = max(len(data), len(ids))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind] * n),
                pa.array([file] * n, pa.int64()),
                pa.array(range(first, first + n), pa.int64()),
                pa.array(data or [None] * n, pa.binary()),
                pa.array(ids or [None] * n, pa.int64()),
            ],
            ["kind", "file", "seq", "data", "id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = load(ranks), TaskContext.get().partitionId()
        held, size, blocks, documents = [], 0, 0, 0
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("id").to_pylist()
            for i in range(batch.num_rows):
                tokens = encoder.encode_ordinary(texts[i].as_py() or "")
                tokens.append(separator)
                held.append(np.array(tokens, width))
                size += len(tokens)
                if size >= 16 * block:
                    flat = np.concatenate(held)
                    whole = size // block
                    yield rows("block", file, blocks, [flat[k * block : (k + 1) * block].tobytes() for k in range(whole)], [])
                    blocks, held, size = blocks + whole, [flat[whole * block :]], size % block
            if ids:
                yield rows("document", file, documents, [], ids) if any(i is not None for i in ids) else rows("document", file, documents, [None] * len(ids), [])
                documents += len(ids)
        if size:
            flat = np.concatenate(held)
            yield rows("block", file, blocks, [flat[k : k + block].tobytes() for k in range(0, size, block)], [])

    return run


def write_flat(
    docs: DataFrame, ranks: str, separator: int, folder: str, doc_id: str = "doc_id", text: str = "text", width: str = "<u2", block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Encode documents into one flat file for each partition, written as ``file, seq, data`` blocks.

    Also returns ``file, seq, id``: which document came as which. A retried task writes the same
    file again, since a file is a partition of the input.
    """
    fed = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    fed.mapInArrow(_flatten(ranks, separator, width, block), FLAT_SCHEMA).write.partitionBy("kind").mode("overwrite").parquet(folder)
    back = docs.sparkSession.read.schema("file bigint, seq bigint, data binary, id bigint, kind string").parquet(folder)
    return (
        back.where("kind = 'block'").select("file", "seq", "data"),
        back.where("kind = 'document'").select("file", "seq", "id"),
    )


def read_flat(spark: SparkSession, path: str, width: str = "<u2", block: int = BLOCK) -> DataFrame:
    """``file, seq, data`` blocks of flat binary files, by path; a file of up to 2 GB is read by one task."""
    step = block * np.dtype(width).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                for k, at in enumerate(range(0, data.size, step)):
                    part = data.slice(at, min(step, data.size - at)).to_pybytes()
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([part], pa.binary())], ["file", "seq", "data"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "file string, seq bigint, data binary")


def _find(separator: int, width: str):
    """Per block: its tokens, and the places of its separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for x in batch.column("data"):
                tokens = np.frombuffer(x.as_buffer(), width)
                sizes.append(len(tokens))
                places.append(np.flatnonzero(tokens == separator).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("seq"), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int32()))],
                ["file", "seq", "n", "places"],
            )

    return run


def scan_separators(blocks: DataFrame, separator: int, width: str = "<u2", block: int = BLOCK) -> DataFrame:
    """``file, ordinal, start, n_tokens, terminated`` of every document of ``file, seq, data`` blocks.

    ``file`` is of the type that ``blocks`` has. All blocks of a file but the last hold ``block`` tokens.
    """
    kind = blocks.schema["file"].dataType.simpleString()
    found = blocks.select("file", "seq", "data").mapInArrow(_find(separator, width), f"file {kind}, seq bigint, n bigint, places array<int>")
    base = F.col("seq") * block
    known = found.select(
        "file", "seq", "places", F.size("places").alias("seps"), (base + F.col("n")).alias("end"),
        (base + F.element_at("places", -1) + 1).alias("after"), F.floor(F.col("seq") / STRETCH).alias("stretch"),
    )
    known = known.withColumn("after", F.when(F.col("seps") > 0, F.col("after")))
    sums = known.groupBy("file", "stretch").agg(F.sum("seps").alias("seps"), F.max("after").alias("after"))
    ahead = W.partitionBy("file").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select("file", "stretch", F.sum("seps").over(ahead).alias("seps_in"), F.max("after").over(ahead).alias("after_in"))
    inside = W.partitionBy("file", "stretch").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    stitched = (
        known.withColumn("seps_near", F.sum("seps").over(inside))
        .withColumn("after_near", F.max("after").over(inside))
        .join(carried, ["file", "stretch"])
    )
    zero = F.lit(0).cast("long")
    first = F.coalesce("seps_near", zero) + F.coalesce("seps_in", zero)
    start = F.coalesce("after_near", "after_in", zero)
    ended = (
        stitched.where(F.col("seps") > 0)
        .select("file", "seq", first.alias("first"), start.alias("start"), F.posexplode("places").alias("k", "place"), "places")
        .select(
            "file",
            (F.col("first") + F.col("k")).alias("ordinal"),
            F.when(F.col("k") == 0, F.col("start")).otherwise(base + F.get("places", F.col("k") - 1) + 1).alias("start"),
            (base + F.col("place")).alias("stop"),
        )
        .select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(True).alias("terminated"))
    )
    # What stands behind the last separator of a file.
    ends = known.groupBy("file").agg(F.sum("seps").alias("ordinal"), F.coalesce(F.max("after"), zero).alias("start"), F.max("end").alias("end"))
    rest = ends.where(F.col("end") > F.col("start")).select(
        "file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated")
    )
    return ended.unionByName(rest)


def count_tokens(docs: DataFrame, ranks: str, separator: int, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, file, start, n_tokens`` of every row, counted in flat files in the shared folder."""
    folder = f"{run_folder(docs.sparkSession, 'flat-tokens')}/table"
    blocks, order = write_flat(docs, ranks, separator, folder, doc_id, text, block=block)
    found = scan_separators(blocks, separator, block=block)
    return order.join(found.withColumnRenamed("ordinal", "seq"), ["file", "seq"]).select(
        F.col("id").alias(doc_id), "file", "start", "n_tokens"
    )
