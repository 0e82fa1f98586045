"""Gumbel top-k sampling of segmentations without replacement, and decoding of ids.

For every text an A* search over its piece lattice emits the ``k`` segmentations with the greatest
perturbed log-probabilities: the root's value is a Gumbel variable, every part of the lattice gets
the greatest value inside it, given its mass and the value of what it was split from, and the part
with the greatest value is opened next. What comes out are ``k`` distinct segmentations drawn
without replacement, in falling order, and the value of the next one is the threshold of their
inclusion scores.

Random numbers come from the seed and the row's key alone, so a retried task gives the same rows
and neither order nor partitioning matters. Rows are kept one to one and nothing is shuffled.

Defined results: a null text has no segmentation, an empty one the empty segmentation with log
probability 0; where fewer than ``k`` exist, all of them come back and their inclusion score is
log 1 = 0; null keys share one key; rows that repeat key and text repeat their result; ties cannot
occur but for texts with one segmentation. A text's own blank-mark characters decode as blanks.
Columns of the input named in ``keep`` come back unchanged; ``out`` must be a new name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from quayside.llm.exprs import fresh
from quayside.llm.lattice import Lattice, Pieces, search_texts

#: Characters of texts that are searched together; a longer text is searched alone.
BATCH_CHARS = 1_000_000
BATCH_ROWS = 4096
#: Units whose lattices a worker keeps from batch to batch.
KNOWN_UNITS = 120_000

SAMPLE = (
    "array<struct<rank: int, ids: array<int>, n_pieces: int, log_prob: double, perturbed: double, "
    "log_inclusion: double, ids_sha256: string, decodes: boolean>>"
)
_ARROW_SAMPLE = pa.list_(
    pa.struct(
        [
            ("rank", pa.int32()),
            ("ids", pa.list_(pa.int32())),
            ("n_pieces", pa.int32()),
            ("log_prob", pa.float64()),
            ("perturbed", pa.float64()),
            ("log_inclusion", pa.float64()),
            ("ids_sha256", pa.string()),
            ("decodes", pa.bool_()),
        ]
    )
)
_MODELS: dict[tuple, Pieces] = {}


def load(model: str, alpha: float = 1.0) -> Pieces:
    """The model, read once for each worker process."""
    if (model, alpha) not in _MODELS:
        _MODELS[model, alpha] = Pieces(model, alpha)
    return _MODELS[model, alpha]


def _row_keys(values: list) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(repr(v).encode()) for v in values], np.uint64)


def _samples(lattice: Lattice, texts: list[str | None], keys: np.ndarray, k: int, seed: int, with_ids: bool) -> pa.Array:
    """The segmentations of each text as one flat table with offsets; a null text has none."""
    known = [i for i, text in enumerate(texts) if text is not None]
    drawn = search_texts(lattice, [texts[i] for i in known], keys[known], k, seed) if known else []
    sizes = np.zeros(len(texts), np.int64)
    sizes[known] = [len(rows) for rows in drawn]
    flat = [row for rows in drawn for row in rows]
    lengths = np.fromiter((len(row[0]) for row in flat), np.int64, len(flat))
    if with_ids:
        all_ids = np.concatenate([row[0] for row in flat]) if flat else np.zeros(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(all_ids, pa.int32()))
    else:
        ids = pa.nulls(len(flat), pa.list_(pa.int32()))
    columns = [
        pa.array([rank for rows in drawn for rank in range(1, len(rows) + 1)], pa.int32()),
        ids,
        pa.array(lengths.astype(np.int32)),
        *(pa.array([row[at] for row in flat], pa.float64()) for at in (1, 2, 3)),
        pa.array([hashlib.sha256(row[0].astype("<i4").tobytes()).hexdigest() for row in flat], pa.string()),
        pa.array([row[4] for row in flat], pa.bool_()),
    ]
    rows = pa.StructArray.from_arrays(columns, fields=list(_ARROW_SAMPLE.value_type))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), rows)


def _sampler(model: str, k: int, alpha: float, seed: int, with_ids: bool, kept: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(load(model, alpha))
        for batch in batches:
            texts, keys = batch.column(kept), batch.column(kept + 1)
            start = 0
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            while start < batch.num_rows:
                upto = np.cumsum(sizes[start : start + BATCH_ROWS], dtype=np.int64)
                n = max(int(np.searchsorted(upto, BATCH_CHARS, side="right")), 1)
                rows = _samples(lattice, texts.slice(start, n).to_pylist(), _row_keys(keys.slice(start, n).to_pylist()), k, seed, with_ids)
                columns = [batch.column(at).slice(start, n) for at in range(kept)]
                yield pa.RecordBatch.from_arrays([*columns, rows], names)
                start += n
                if len(lattice.number) > KNOWN_UNITS:
                    lattice.shrink(KNOWN_UNITS // 2)

    return run


def sample_segmentations(
    df: DataFrame,
    model: str,
    k: int = 3,
    alpha: float = 1.0,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    out: str = "segmentations",
    keep: Sequence[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """``keep`` (all columns unless given) and ``out``: up to ``k`` segmentations of each text.

    ``model`` is a path that every executor can read. Each segmentation has its ids (unless
    ``with_ids`` is false), their number and digest, its log-probability, its perturbed value, the
    log of its inclusion probability, and whether its ids decode to the text: whether each of its
    pieces spells the stretch of the text that it stands for.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    keep = list(df.columns if keep is None else keep)
    if out.lower() in {name.lower() for name in keep}:
        raise ValueError(f"the input already has a column {out!r}")
    schema = StructType([df.schema[name] for name in keep] + [StructField(out, _parse_datatype_string(SAMPLE))])
    # Columns are taken by place, so names of the input cannot clash with these.
    columns = [F.col(f"`{name}`") for name in keep]
    fed = df.select(*columns, F.col(f"`{text}`").alias(fresh(df, "text")), F.col(f"`{key}`").cast("string").alias(fresh(df, "key")))
    return fed.mapInArrow(_sampler(model, k, alpha, seed, with_ids, len(keep), [*keep, out]), schema)


def _decoder(model: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if x is None else pieces.decode(np.array([i for i in x if i is not None], np.int64)) for x in ids]
            columns = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], batch.schema.names[:-1] + [out])

    return run


def decode_ids(df: DataFrame, model: str, ids: str, out: str = "decoded") -> DataFrame:
    """``df`` with the text of each id list; null lists give null, null ids nothing."""
    if out.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"the input already has a column {out!r}")
    schema = StructType([*df.schema.fields, StructField(out, _parse_datatype_string("string"))])
    return df.select("*", F.col(f"`{ids}`").alias(fresh(df, "ids"))).mapInArrow(_decoder(model, out), schema)
