"""Which stages a run has, from its two switches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stage names, each followed by the source's name, and the closing stage.
TOKENIZE = "TOKENIZATION_JOB"
QUALITY = "DQ"
CLOSE = "DELETE_DATAPROC_CLUSTER"
ON, OFF = "True", "False"


def stage_plan(tokenization: Column, quality: Column, source: Column) -> Column:
    """The stages of a run as an array.

    The switches are texts and compared exactly; with any other text in either of them only the
    closing stage is left.
    """
    token, check, close = F.concat(F.lit(TOKENIZE), source), F.concat(F.lit(QUALITY), source), F.lit(CLOSE)
    return (
        F.when((tokenization == ON) & (quality == ON), F.array(token, check, close))
        .when((tokenization == OFF) & (quality == ON), F.array(check, close))
        .when((tokenization == ON) & (quality == OFF), F.array(token, close))
        .otherwise(F.array(close))
    )


def stages_for(tokenization: str, quality: str) -> tuple[bool, bool]:
    """Whether a run tokenizes and whether it checks, by the same rule."""
    known = tokenization in (ON, OFF) and quality in (ON, OFF)
    return known and tokenization == ON, known and quality == ON
