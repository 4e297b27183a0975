"""Quality rules as a short-circuit cascade, in built-in expressions only.

Each rule is a condition that rejects a document. On a bounded sample the time and the share of rejections of every
rule are measured; the cascade then asks the rules in the order of rejections per second, and a document that one
rule rejects is not shown to the next. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2_000
SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Rule:
    """rejects: a condition in SQL. needs: the measures that it reads."""

    name: str
    needs: tuple[str, ...]
    rejects: str


def _pairs(array: Column, n: Column, other: Column, skip: int, make) -> Column:
    """make(array[i], other[i + skip]) for all i where both are there."""
    m = F.greatest(n - skip, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), m), F.slice(other, F.lit(1 + skip), m), make)


def _words(df: DataFrame) -> DataFrame:
    return df.withColumn("__words", F.array_remove(F.split(F.coalesce(F.col("__text"), F.lit("")), f"[{SPACE}]+"), ""))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Words in 3-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes. Only a text with a repeated window is sorted. Each step is a column of its
    own, so that no lambda works an array out anew for every element.
    """
    words, n = F.col("__words"), F.size("__words")
    df = df.withColumn("__two", _pairs(words, n, words, 1, lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("__three", F.zip_with(F.slice("__two", F.lit(1), F.greatest(n - 2, F.lit(0))), F.slice("__words", F.lit(3), F.greatest(n - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b)))
    three = F.col("__three")
    df = df.withColumn("__sorted", F.when(F.size(F.array_distinct(three)) < F.size(three), F.sort_array(F.transform(three, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__sorted")
    both = _pairs(s, F.size(s), s, 1, lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    df = df.withColumn("__at", F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull())))))
    at = F.col("__at")
    covered = F.aggregate(_pairs(at, F.size(at), at, 1, lambda a, b: F.least(b - a, F.lit(3))), F.lit(3), lambda acc, x: acc + x)
    return df.withColumn("n_repeat_words", F.when(at.isNull(), F.lit(0)).otherwise(covered).cast("long"))


def _lines(df: DataFrame) -> DataFrame:
    df = df.withColumn("__lines", F.filter(F.split(F.coalesce(F.col("__text"), F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    return df.withColumns({"n_lines": F.size("__lines").cast("long"), "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")})


def _count(pattern: str) -> Column:
    return F.coalesce(F.regexp_count(F.col("__text"), F.lit(pattern)), F.lit(0)).cast("long")


#: How each measure is made: the measures it needs first, and the step that adds it.
MEASURES = {
    "__words": ((), _words),
    "n_words": (("__words",), lambda df: df.withColumn("n_words", F.size("__words").cast("long"))),
    "word_chars": ((), lambda df: df.withColumn("word_chars", F.coalesce(F.char_length("__text"), F.lit(0)).cast("long") - _count(f"[{SPACE}]"))),
    "n_symbols": ((), lambda df: df.withColumn("n_symbols", _count("[#*$%&|<>]"))),
    "n_marks": ((), lambda df: df.withColumn("n_marks", _count("[!?]{2,}"))),
    "n_lines": ((), _lines),
    "n_dup_lines": (("n_lines",), lambda df: df),
    "n_repeat_words": (("__words",), _repeat_words),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The rules in production. The first two are the base; the others ask for much more than any clean text has.
RULES = (
    Rule("few_words", ("n_words",), "n_words < 50"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "100 * n_symbols > 40 * n_words"),
    Rule("shouting", ("n_words", "n_marks"), "100 * n_marks > 40 * n_words"),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)


def measured(df: DataFrame, names: tuple[str, ...], settled: bool = False) -> DataFrame:
    """df, with ``__text``, and those of its missing measures that are named, with what they need.

    settled: each measure comes out of a generator of one row. Without it a filter on a measure would be pushed
    below the columns that make it, which repeats their work in every lambda that reads them.
    """
    for name in names:
        if name not in df.columns:
            needs, step = MEASURES[name]
            df = step(measured(df, needs, settled))
            if settled:
                df = df.withColumn(name, F.explode(F.array(name)))
    return df


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules, most rejections per second of work first, as measured on at most ``sample_rows`` documents.

    Without documents the order stays as given.
    """
    sample = docs.select(F.col("text").cast("string").alias("__text")).sample(0.1, seed=7).limit(sample_rows).persist()
    try:
        rows = sample.count()
        if not rows:
            return list(rules)

        def work(df: DataFrame, condition: Column) -> tuple[float, int]:
            began = time.perf_counter()
            hits = df.agg(F.count_if(condition)).first()[0]
            return time.perf_counter() - began, hits

        idle = work(sample, F.length("__text") < 0)[0]
        rated = []
        for rule in rules:
            took, hits = work(measured(sample, rule.needs), F.expr(rule.rejects))
            rated.append(((hits + 0.5) / max(took - idle, 1e-3), rule))
        return [rule for _, rule in sorted(rated, key=lambda x: -x[0])]
    finally:
        sample.unpersist()


def keep_clean(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[Rule] | None = None) -> DataFrame:
    """The documents that no rule rejects, with the columns they came with.

    A null or empty text has no words. Extra columns are carried along; names starting with two underscores and those of
    the measures are set aside for the time and given back. Repeated rows are judged alike.
    """
    row = docs.select(F.struct("*").alias("__row"), F.col("text").cast("string").alias("__text"))
    for rule in order or plan_cascade(docs, rules):
        row = measured(row, rule.needs, settled=True).where(~F.expr(rule.rejects))
    return row.select("__row.*")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[Rule] | None = None) -> DataFrame:
    """doc_id, the base measures, base_failed and kept, one row per input row.

    The measures are asked for, so they are made for every row; the verdict then goes through the cascade. A null
    or empty text has no words: its measures are 0 and it fails. Repeated rows and repeated or null doc_ids come back
    as they are.
    """
    order = order or plan_cascade(docs, rules)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("__text"))
    rows = measured(rows, (*BASE, *(n for rule in order for n in rule.needs)))
    verdict = F.lit(True)
    for rule in reversed(order):
        verdict = F.when(F.expr(rule.rejects), F.lit(False)).otherwise(verdict)
    base = F.lit(False)
    for rule in rules[:2]:
        base = base | F.expr(rule.rejects)
    return rows.select("doc_id", *BASE, base.alias("base_failed"), verdict.alias("kept"))
