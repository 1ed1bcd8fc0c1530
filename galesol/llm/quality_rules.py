"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Base measures (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) are
counted over the whole text. A rule keeps a document while its ratio lies within
[least, most]; a document must pass every rule.

Null or empty text has no words: every count is 0, base_failed is true and it is
not kept. Repeated rows give repeated rows; an empty table gives an empty one.
Columns of the input that clash with result names are not carried, only `id_col`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm import textstats as S


class Rule(NamedTuple):
    """A ratio of two measures and the range in which it is accepted; applies from `min_words` words on."""

    name: str
    top: str
    bottom: str | None
    least: float
    most: float
    min_words: int = 0


#: Production thresholds.
RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("exclamations_per_word", "n_exclaims", "n_words", 0.0, 0.25),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.02, 1.0, 60),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0.0, 0.5),
)


def measures(text: Column) -> Column:
    """All measures of one text, as one struct."""
    text = F.coalesce(text, F.lit(""))
    by_word = S.let(S.words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), S.repeated_words(w).alias("n_repeat_words"), S.stop_words(w).alias("n_stop_words")))
    return S.let(by_word, lambda b: S.let(S.line_counts(text), lambda x: F.struct(
        b["n_words"].alias("n_words"),
        S.word_chars(text).alias("word_chars"),
        S.count_of(text, S.SYMBOLS).alias("n_symbols"),
        x["n_dup_lines"].alias("n_dup_lines"),
        b["n_repeat_words"].alias("n_repeat_words"),
        x["n_lines"].alias("n_lines"),
        b["n_stop_words"].alias("n_stop_words"),
        S.count_of(text, "!").alias("n_exclaims"),
    )))


def passed(m: Column, rule: Rule) -> Column:
    ratio = m[rule.top] if rule.bottom is None else m[rule.top] / F.greatest(m[rule.bottom], F.lit(1))
    return ratio.between(rule.least, rule.most) | (m["n_words"] < rule.min_words)


def apply_quality_rules(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, base measures, base_failed, kept, and failed_rules (names of failed rules, comma-joined)."""
    m = F.col("m")
    base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    verdict = reduce(lambda a, b: a & b, [passed(m, r) for r in rules], F.lit(True))
    failed = F.concat_ws(",", *[F.when(~passed(m, r), F.lit(r.name)) for r in rules])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = df.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    return out.select("doc_id", *[m[n].alias(n) for n in names], base.alias("base_failed"), (~base & verdict).alias("kept"), failed.alias("failed_rules"))
