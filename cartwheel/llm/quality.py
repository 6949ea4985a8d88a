"""Quality rules: a threshold table compiled into one Spark projection.

``_counts`` are what a rule can name, ``compile_rules`` turns the table into one
boolean column.  Everything is a built-in expression over the row's own
text: no shuffle, no user function.

Defined cases: a null or blank text has no words and is rejected by the base
rule; every row gives one row (repeated rows give repeated results, a null
``doc_id`` stays null); an empty table gives an empty table.  A ratio whose
denominator is zero is taken as zero.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import SPACES, let

MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the corpus languages (en, de, fr, es).
STOP_WORDS = (
    "the be to of and that have with is in on for was are this it as at by an or from "
    "der die das und ist nicht mit ein eine den von zu sich auf für im des dem auch "
    "le la les et est un une que qui dans pour sur par pas au du avec ne "
    "el los las y en que es por con para una del se al lo como más su"
).split()


@dataclass(frozen=True)
class Threshold:
    """``low <= numerator / denominator <= high`` keeps a document."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: The table. Counts are those of ``_counts``.
THRESHOLDS = (
    Threshold("mean_word_length", "word_chars", "n_words", low=2.0, high=12.0),
    Threshold("symbols_per_word", "n_symbols", "n_words", high=0.1),
    Threshold("exclamations_per_word", "n_exclamations", "n_words", high=0.3),
    Threshold("words_with_a_letter", "n_letter_words", "n_words", low=0.8),
    Threshold("stop_words", "n_stop_words", "n_words", low=0.02),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", high=0.6),
)


def _covered(positions: Column) -> Column:
    """Words covered by the three-word windows that start at the ascending positions."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        positions, start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the array.

    The windows are compared as strings (words hold no space, so joining them by one
    is injective); only rows that have a repeated window sort their windows.
    """
    def windows(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.array().cast("array<string>")).otherwise(
            F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                        lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))))

    def repeated(g: Column) -> Column:
        ordered = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        marked = let(ordered, lambda s: F.array_sort(F.array_compact(F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]), x["i"])))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(marked))

    return let(windows(words), repeated)


def _counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts of a text that is not null and of its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stops = sorted(set(STOP_WORDS))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(words),
        "n_lines": F.size(lines),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_letter_words": F.size(F.filter(words, lambda x: x.rlike(r"\p{L}"))),
        "n_stop_words": F.size(F.filter(words, lambda x: F.lower(x).isin(stops))),
    }
    return {name: c.cast("long") for name, c in counts.items()}


def _measured(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the counts in one struct, _quality."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.withColumn("_text", text).withColumn("_words", F.array_remove(F.split(text, SPACES), ""))
    counts = _counts(F.col("_text"), F.col("_words"))
    return split.withColumn("_quality", F.struct(*[c.alias(n) for n, c in counts.items()])).drop("_text", "_words")


def base_failed(count: Callable[[str], Column] = F.col) -> Column:
    return (count("n_words") < MIN_WORDS) | (100 * count("n_repeat_words") > 50 * count("n_words"))


def compile_rules(table=THRESHOLDS, count: Callable[[str], Column] = F.col) -> Column:
    """One boolean: the row is inside every threshold of the table."""
    verdict = F.lit(True)
    for t in table:
        bottom = count(t.denominator)
        ratio = F.when(bottom == 0, F.lit(0.0)).otherwise(count(t.numerator).cast("double") / bottom)
        if t.low is not None:
            verdict = verdict & (ratio >= F.lit(t.low))
        if t.high is not None:
            verdict = verdict & (ratio <= F.lit(t.high))
    return verdict


def judge(docs: DataFrame, table=THRESHOLDS) -> DataFrame:
    """doc_id, the counts of every document, ``base_failed`` and ``kept``."""
    return _measured(docs.select("doc_id", "text")).select("doc_id", "_quality.*").withColumn(
        "base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & compile_rules(table))


def keep(docs: DataFrame, table=THRESHOLDS) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    The verdict is one nested expression: a filter on columns would be pushed below them
    and would compute every count once for each rule.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def verdict(words: Column) -> Column:
        counts = F.struct(*[c.alias(n) for n, c in _counts(text, words).items()])
        return let(counts, lambda q: ~base_failed(lambda n: q[n]) & compile_rules(table, lambda n: q[n]))

    return docs.where(let(F.array_remove(F.split(text, SPACES), ""), verdict))
