"""URL filter: fixed rules first, then association rules mined from labelled pages.

A URL is a set of tokens, marked by the part they stand in. FP-growth finds token
sets that are frequent among labelled pages together with the label "bad"; rules
"tokens -> bad" are kept if confident enough, and more so than every kept rule with
fewer of the same tokens. A rule is filed in an index under its rarest token, so that
a URL meets only rules filed under its own tokens, and is then checked in full.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_or_not, stash

#: Fixed rules: host and path, written as one string, with their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BAD = "label:bad"
#: Share of labelled pages that must have a rule's tokens and be bad; share of pages with the tokens that are bad.
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.0005, 0.6
#: Rows that support a rule must number this many as well, however few pages there are.
LEAST_ROWS = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without it, and for null."""
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column) -> Column:
    """The longest fixed rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(RULES, key=len):
        of, start = rule[: rule.index("/")], rule[rule.index("/"):]
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: words of host, path and the rest, numbers left out."""
    def marked(part: Column, mark: str) -> Column:
        words = F.filter(F.split(F.lower(part), "[^a-z0-9]+"), lambda w: ~F.regexp_like(w, F.lit("^[0-9]*$")))
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    rest = F.regexp_extract(after_scheme(url), r"^[^?#]*([\s\S]*)$", 1)
    return F.array_distinct(F.concat(marked(host_of(url), "h:"), marked(path_of(url), "p:"), marked(rest, "q:")))


def mine(pages: DataFrame, labels: DataFrame, least_support: float = LEAST_SUPPORT,
         least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """(tokens, confidence, support) of the kept rules; ``tokens`` sorted.

    A page is bad if its label has quality 0 or toxic 1; of repeated label rows one is enough.
    """
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    rows = stash(pages.select("page_id", tokens_of(F.col("url")).alias("tokens")).filter(F.size("tokens") > 0).join(
        marks, "page_id").select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(
            F.col("tokens")).alias("items")), "baskets")
    n = rows.count()
    if not n:
        return rows.select(F.col("items").alias("tokens"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support"))
    model = FPGrowth(itemsCol="items", minSupport=max(least_support, LEAST_ROWS / n),
                     minConfidence=least_confidence).fit(rows)
    rules = stash(model.associationRules.filter(F.array_contains("consequent", BAD)).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "rules")
    return without_special_cases(rules)


def without_special_cases(rules: DataFrame) -> DataFrame:
    """Rules that have more confidence than each rule with some of their tokens only."""
    inner = small_or_not(rules.select(F.element_at("tokens", 1).alias("key"), F.col("tokens").alias("fewer"),
                                      F.col("confidence").alias("as_good")))
    beaten = rules.withColumn("key", F.explode("tokens")).join(inner, "key").filter(
        (F.size("fewer") < F.size("tokens")) & (F.size(F.array_except("fewer", "tokens")) == 0)
        & (F.col("as_good") >= F.col("confidence"))).select("tokens").distinct()
    return rules.join(beaten, "tokens", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined, confidence): for each url that a rule fits, the most confident, then supported, then first rule."""
    often = rules.select(F.explode("tokens").alias("token"), "support").groupBy("token").agg(
        F.max("support").alias("often"))
    filed = rules.withColumn("token", F.explode("tokens")).join(often, "token").groupBy(
        "tokens", "confidence", "support").agg(F.min_by("token", F.struct("often", "token")).alias("token"))
    index = small_or_not(stash(filed.withColumnRenamed("tokens", "needs"), "index"))
    met = urls.select("url", tokens_of(F.col("url")).alias("tokens")).withColumn("token", F.explode("tokens"))
    fit = met.join(index, "token").filter(F.size(F.array_except("needs", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("needs", " ").alias("mined"))).alias("b")
    return fit.groupBy("url").agg(best).select("url", F.col("b.mined"), F.col("b.confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, least_support: float = LEAST_SUPPORT,
               least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined, confidence.

    A fixed rule decides; without one the page is blocked if a mined rule fits,
    else allowed. Null urls, and those without ``://``, have an empty host and path,
    no tokens and are allowed. Null and repeated ids are judged like others and
    take part in mining only if labelled. No labels: no mined rules.
    """
    rules = mine(pages, labels, least_support, least_confidence)
    urls = pages.select("url").distinct()
    found = matched(urls, rules)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = pages.select("page_id", "url").join(found, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), "mined", "confidence")
    rule = fixed_rule(F.col("host"), F.col("path"))
    verdict = F.lit(None).cast("string")
    for name, says in RULES.items():
        verdict = F.when(F.col("rule") == name, says).otherwise(verdict)
    learned = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return out.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", F.coalesce(verdict, learned).alias("verdict"), "mined", "confidence")
