"""Templates that say how each sensitive column is protected."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import tokens
from quayside.operators.surrogate_buckets import BucketedMap, attach_surrogates
from quayside.operators.surrogates import SurrogateMap

METHODS = ("hash", "reversible", "surrogate", "mask", "redact")


def _rule(entry) -> tuple[str, dict]:
    options = {"method": entry} if isinstance(entry, str) else dict(entry)
    return options.pop("method"), options


def check_template(columns: list[str], template: Mapping[str, object]) -> None:
    """Raise for a column the table lacks and for a method that is not served."""
    missing = [c for c in template if c not in columns]
    if missing:
        raise ValueError(f"template names columns the table lacks: {', '.join(missing)}")
    for column, entry in template.items():
        if _rule(entry)[0] not in METHODS:
            raise ValueError(f"column {column}: method {_rule(entry)[0]!r} is not one of {', '.join(METHODS)}")


def token_column(column: str, entry, key: bytes | None) -> Column:
    """The protected form of one column, for the methods that look at one row alone."""
    method, options = _rule(entry)
    value = F.col(column)
    if method in ("hash", "reversible") and key is None:
        raise ValueError(f"column {column}: method {method!r} needs a key")
    if method == "hash":
        return tokens.hmac_token(value, key)
    if method == "reversible":
        return tokens.seal_token(value, key)
    if method == "mask":
        return tokens.mask(value, **options)
    if method == "redact":
        return tokens.redact(value, **options)
    raise ValueError(f"column {column}: method {method!r} needs the whole table")


def apply_row_template(df: DataFrame, template: Mapping[str, object], key: bytes | None = None) -> DataFrame:
    """Protect columns row by row: one projection, for batch and stream alike."""
    check_template(df.columns, template)
    return df.select(*[token_column(c, template[c], key).alias(c) if c in template else c for c in df.columns])


def apply_template(
    df: DataFrame,
    template: Mapping[str, object],
    key: bytes | None = None,
    surrogates: Mapping[str, SurrogateMap | BucketedMap] | None = None,
) -> DataFrame:
    """Protect the columns a template names; the others, and the order of all, stay as they are.

    Columns with bucketed maps are numbered together; those with ordered maps one after the other.
    """
    check_template(df.columns, template)
    numbered = [c for c, entry in template.items() if _rule(entry)[0] == "surrogate"]
    for column in numbered:
        if column not in (surrogates or {}):
            raise ValueError(f"column {column}: method 'surrogate' needs a surrogate map")
    bucketed = {c: surrogates[c] for c in numbered if isinstance(surrogates[c], BucketedMap)}
    numbered = [c for c in numbered if c not in bucketed]
    out = attach_surrogates(df, bucketed) if bucketed else df
    for column in numbered:
        out = surrogates[column].attach(out, column, f"{column}__id")
    rest = {c: e for c, e in template.items() if c not in numbered and c not in bucketed}
    out = apply_row_template(out, rest, key)
    return out.select(*[F.col(f"{c}__id").alias(c) if c in numbered else c for c in df.columns])
