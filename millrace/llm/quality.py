"""Quality rules whose cut-offs are chosen under a guarantee on false rejection.

A rule rejects a document when one of its measures lies above a cut-off. A
labelled holdout picks the cut-offs: within a stratum, the share of good
documents that a rule rejects must be shown, by an exact binomial test, to be at
most its part of ``max_loss``. Cut-offs of a rule are tested from the mildest to
the strictest and testing stops at the first that fails, so that no correction
over cut-offs is needed; over rules and strata the level is divided evenly.
With probability ``1 - delta`` all chosen cut-offs keep their promise at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, let, stash, text_of

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"

#: Measures with a rule, as expressions over the measured columns.
RULES: dict[str, str] = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "capital_pairs": "n_capital_pairs / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
}
#: Tested cut-offs, from the mildest on. Part of the operator's definition.
GRID: dict[str, list[float]] = {
    "symbols_per_word": [8, 6, 5, 4, 3, 2.5, 2, 1.5, 1.2, 1, 0.8, 0.6, 0.5, 0.4, 0.3],
    "duplicate_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "capital_pairs": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05],
    "chars_per_word": [100, 60, 40, 30, 25, 20, 18, 16, 14, 12],
}
#: Strata by language; any other language, and none, is the last one.
LANGUAGES = ("en", "de", "fr", "es")
OTHER = "other"


def measured(text: Column) -> Column:
    """Struct of the base measures of a whole text; a null text counts as empty."""
    def repeats(words: Column) -> Column:
        """Words inside 8-word windows that occur twice or more."""
        marks = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                            lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))

        def covered(starts: Column) -> Column:
            reach = F.transform(starts, lambda p, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
            return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

        def twice(pairs: Column) -> Column:
            repeated = F.filter(pairs, lambda p, j: (p["mark"] == F.get(pairs, j - 1)["mark"])
                                | (p["mark"] == F.get(pairs, j + 1)["mark"]))
            return let(F.array_sort(F.transform(repeated, lambda p: p["at"])), covered)

        def counted(found: Column) -> Column:
            pairs = F.array_sort(F.transform(found, lambda m, i: F.struct(m.alias("mark"), i.alias("at"))))
            return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(pairs, twice))

        return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(marks, counted))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))

    lines = let(F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))), of_lines)
    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: let(lines, lambda ln: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (ln["n"] - ln["distinct"]).cast("long").alias("n_dup_lines"),
        repeats(words).cast("long").alias("n_repeat_words"),
        ln["n"].cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}\p{Lu}")).cast("long").alias("n_capital_pairs"),
    )))


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p) and k <= n p, exact: the test of "the rate is above p" after k of n.

    Terms only fall on the way down from k, so they are added until none counts.
    """
    log_top = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
               + k * math.log(p) + (n - k) * math.log1p(-p))
    term = total = 1.0
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < 1e-18 * total:
            break
    return min(1.0, math.exp(log_top) * total)


def chosen(counts: dict[tuple[str, str, float], tuple[int, int]], max_loss: float,
           delta: float) -> dict[tuple[str, str], float]:
    """The strictest passing cut-off by (stratum, rule).

    ``counts`` has, by (stratum, rule, cut-off), the good holdout documents
    rejected and all good ones. Where nothing passes the rule is not used.
    """
    strata = [*LANGUAGES, OTHER]
    level, loss = delta / (len(strata) * len(RULES)), max_loss / len(RULES)
    cuts = {}
    for stratum in strata:
        for rule, grid in GRID.items():
            for cut in grid:
                k, n = counts.get((stratum, rule, cut), (0, 0))
                if n == 0 or k > n * loss or tail(k, n, loss) > level:
                    break
                cuts[stratum, rule] = cut
    return cuts


def judge_quality(documents: DataFrame, labels: DataFrame, max_loss: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per document: its measures, ``base_failed``, ``kept`` and the first rule that rejects it.

    ``labels`` (doc_id, quality) marks good documents with 1. Only good
    documents that pass the base rule enter the tests. Null or empty text: no
    words, fails the base rule. Null ids: measured and judged, never matched
    with a label. Repeated label rows: a document is good only if all say so.
    Empty labels: nothing but the base rule rejects. Other columns are ignored.
    What reaches the driver is rules x strata x cut-offs counts, whatever the size of the data.
    """
    lang = F.when(F.col("lang").isin(*LANGUAGES), F.col("lang")).otherwise(OTHER)
    facts = stash(documents.select("doc_id", lang.alias("stratum"), measured(text_of()).alias("m")), "quality")
    facts = facts.select("doc_id", "stratum", "m.*")
    facts = facts.withColumn("base_failed", (F.col("n_words") < 20)
                             | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    facts = facts.withColumns({rule: F.expr(e) for rule, e in RULES.items()})

    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    held = facts.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    cells = [(rule, cut) for rule, grid in GRID.items() for cut in grid]
    sums = [F.count_if(F.col(rule) > cut).alias(f"c{i}") for i, (rule, cut) in enumerate(cells)]
    counts = {(r["stratum"], *cell): (r[f"c{i}"], r["n"])
              for r in held.groupBy("stratum").agg(F.count("*").alias("n"), *sums).collect()
              for i, cell in enumerate(cells)}
    cuts = chosen(counts, max_loss, delta)

    rule = F.lit(None).cast("string")
    for (stratum, name), cut in reversed(cuts.items()):
        rule = F.when((F.col("stratum") == stratum) & (F.col(name) > cut), F.lit(name)).otherwise(rule)
    return facts.withColumn("rule", rule).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
