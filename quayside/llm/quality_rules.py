"""Quality rules: a table of thresholds compiled into one Spark projection.

A rule is a metric with a lowest and a highest value; either may be missing. The metrics of a text
are computed from its words and lines by built-in functions inside the row, so nothing is shuffled
and no task holds more than one text beside its word list.

Defined results: a null text has no words; a text that is null or has too few words fails the base
rule, not the ratio rules, which are NULL without words and pass. Rows are kept one to one, so
repeated rows and ties need no rule. Columns of the input come back unchanged; the metric columns
are put into one struct whose name the caller gives, so clashing names cannot occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.exprs import HAS_WORD, let, word_array

#: Frequent words of the four languages that the rules know.
STOP_WORDS = (
    "the be to of and that have with in for is a it as at by this was on are or "
    "der die das und ist von zu den mit auf für des ein eine im nicht sich dem auch es "
    "le la les de des et un une du que en par pour dans qui est sur au aux pas "
    "el los las y que en un una por con para del se su no lo al como más"
).split()

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A text passes if the metric is not below ``low`` and not above ``high``, or is NULL."""

    metric: str
    low: float | None = None
    high: float | None = None


#: The production table. A ratio is NULL for a text without words or lines.
RULES = (
    Rule("mean_word_chars", 2.0, 40.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("upper_ratio", None, 0.7),
)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Windows are told apart by a 64-bit hash. Only texts whose hashes repeat are sorted: equal
    hashes are then neighbours, which gives the places of repeated windows in n log n.
    """
    n = F.size(words)
    hashes = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        places = let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["p"],
                )
            ),
        )
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)),
    )


def _metrics(text: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(HAS_WORD))
    stops = F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS)))
    letters = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]"))
    uppers = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Z]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.coalesce(_repeat_words(words), F.lit(0)).cast("long"),
        "n_stop_words": stops.cast("long"),
        "n_letters": letters.cast("long"),
        "n_upper": uppers.cast("long"),
    }


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double"))


#: Metrics of the rule table, each over the counts of a text.
RATIOS = {
    "mean_word_chars": lambda m: _ratio(m["word_chars"], m["n_words"]),
    "symbol_ratio": lambda m: _ratio(m["n_symbols"], m["n_words"]),
    "stop_word_ratio": lambda m: _ratio(m["n_stop_words"], m["n_words"]),
    "dup_line_ratio": lambda m: _ratio(m["n_dup_lines"], m["n_lines"]),
    "upper_ratio": lambda m: _ratio(m["n_upper"], m["n_letters"]),
}


def compile_rules(rules: Sequence[Rule], counts: Column) -> Column:
    """True where every rule holds; a metric without a value passes."""
    verdict = F.lit(True)
    for rule in rules:
        if rule.metric not in RATIOS:
            raise ValueError(f"no metric {rule.metric!r}; there are {sorted(RATIOS)}")
        value = RATIOS[rule.metric](counts)
        if rule.low is not None:
            verdict = verdict & F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            verdict = verdict & F.coalesce(value <= rule.high, F.lit(True))
    return verdict


def apply_rules(
    df: DataFrame, text: str = "text", out: str = "quality", rules: Sequence[Rule] = RULES, min_words: int = 50
) -> DataFrame:
    """``df`` with a struct ``out``: the counts of the text, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than half of the words in repeated
    3-word windows. ``kept``: not that, and every rule of the table holds. ``out`` must be a new name.
    """
    if out.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"the input already has a column {out!r}")
    # One expression with nested values: a later filter on the verdict then copies it as a whole,
    # and not once more for every use of the words inside.
    def judge(c: Column) -> Column:
        base = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        kept = ~base & compile_rules(rules, c)
        return F.struct(c.alias("counts"), base.alias("base_failed"), kept.alias("kept"))

    def measure(words: Column) -> Column:
        counts = F.struct(*(value.alias(name) for name, value in _metrics(F.col(text), words).items()))
        return let(counts, judge)

    return df.withColumn(out, let(word_array(F.col(text)), measure))
