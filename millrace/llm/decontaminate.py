"""Benchmark items inside documents, by SimHash of item-sized windows.

A window has as many words as an item; where the text has fewer, it is the whole text. Both are bags of word shingles, weighted
by how often they occur; each gets a 64-bit SimHash. Fingerprints are split in
BLOCKS blocks, and an index holds, for each block of each item, all values
within RADIUS // BLOCKS bits: two fingerprints at most RADIUS bits apart must meet in
some block, so the index misses none of them. Pairs that meet are decided by
the exact weighted similarity, sum of minima over sum of maxima of the weights.

Two bags of n and m shingles are that similar only if they share s (n + m) / (1 + s) of
them, so only windows with that many shingles from items of their size are fingerprinted.
At similarity 0.8 fingerprints differ by 10 of 64 bits on average, with a
deviation of 3: RADIUS is more than four deviations away.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, let, literal, small_or_not, stash, text_of

WORDS = 5
PERCENT = 80
BITS, BLOCKS, RADIUS = 64, 8, 23
WIDTH = BITS // BLOCKS
#: Marks of a benchmark that may go into the plan as a literal, and slots of its hash table.
IN_PLAN, SLOTS = 100_000, 1 << 16


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def marks_of(words: Column) -> Column:
    """Hash of each run of WORDS words, by its first word; none for shorter texts."""
    return F.when(F.size(words) >= WORDS, F.transform(
        F.sequence(F.lit(1), F.size(words) - (WORDS - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WORDS))))
    ).otherwise(F.array().cast("array<long>"))


def simhash(marks: Column) -> Column:
    """Bit j is set if most of the marks have it; a mark counts as often as it occurs."""
    def bit(j: Column) -> Column:
        ones = F.aggregate(marks, F.lit(0), lambda n, m: n + F.getbit(m, j).cast("int"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), j)
        return F.when(2 * ones > F.size(marks), one).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda acc, j: acc.bitwiseOR(bit(j)))


def block(fingerprint: Column, number: int) -> Column:
    return F.shiftrightunsigned(fingerprint, number * WIDTH).bitwiseAND(F.lit(2**WIDTH - 1)).cast("int")


def flips(width: int, most: int) -> Iterable[int]:
    """All masks of at most ``most`` bits."""
    for n in range(most + 1):
        for bits in combinations(range(width), n):
            yield sum(1 << b for b in bits)


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller of the two weights."""
    def least(mark: Column) -> Column:
        return F.least(F.size(F.filter(a, lambda x: x == mark)), F.size(F.filter(b, lambda x: x == mark)))

    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, m: n + least(m))


def needed(together: Column, percent: int) -> Column:
    """The least shared weight of two bags at the threshold: s of ``together`` - s is percent."""
    return F.ceil(together * percent / (100 + percent)).cast("int")


def least_found(size: Column, length: Column, percent: int) -> Column:
    """Shingles that a window for items of ``size`` words needs in a text of ``length`` shingles."""
    n = size - (WORDS - 1)
    return needed(n + F.least(n, length), percent)


def starts(found: Column, size: Column, length: Column, percent: int) -> Column:
    """Starts of all windows of ``size`` words that hold enough of the sorted positions ``found``.

    A text of fewer shingles (``length``) is one window.
    """
    n = size - (WORDS - 1)
    k = needed(2 * n, percent)

    def around(j: Column) -> Column:
        first, last = F.get(found, j), F.get(found, j + k - 1)
        return F.when(last - first < n, F.sequence(F.greatest(last - n + 1, F.lit(0)), first)).otherwise(
            F.array().cast("array<int>"))

    return F.when(length < n, F.array(F.lit(0))).otherwise(
        F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size(found) - k), around))))


def table_of(grams: DataFrame) -> Column:
    """Literal hash table from a mark to the sizes of the items that have it."""
    slots: list[list[dict]] = [[] for _ in range(SLOTS)]
    for row in grams.groupBy("mark").agg(F.collect_set("size").alias("sizes")).collect():
        slots[row["mark"] % SLOTS].append({"m": row["mark"], "s": row["sizes"]})
    return literal(slots, "array<array<struct<m:bigint,s:array<int>>>>")


def wanted_starts(marks: Column, table: Column, percent: int) -> Column:
    """By item size the starts of the windows that can be similar enough: structs of size and at."""
    def sizes_at(i: Column) -> Column:
        return F.flatten(F.transform(F.filter(
            F.get(table, F.pmod(F.get(marks, i), F.lit(SLOTS)).cast("int")), lambda e: e["m"] == F.get(marks, i)),
            lambda e: e["s"]))

    def by_size(hits: Column) -> Column:
        sizes = F.array_distinct(F.flatten(F.transform(hits, lambda h: h["sizes"])))

        def one(size: Column) -> Column:
            found = F.transform(F.filter(hits, lambda h: F.array_contains(h["sizes"], size)), lambda h: h["pos"])
            return let(found, lambda f: F.struct(size.alias("size"), F.when(
                F.size(f) >= least_found(size, F.size(marks), percent), starts(f, size, F.size(marks), percent)).otherwise(
                F.array().cast("array<int>")).alias("at")))

        return F.transform(sizes, one)

    # Most marks fall in empty slots; only the others are looked up.
    places = F.filter(F.sequence(F.lit(0), F.size(marks) - 1), lambda i: F.size(
        F.get(table, F.pmod(F.get(marks, i), F.lit(SLOTS)).cast("int"))) > 0)
    hits = F.filter(F.transform(places, lambda i: F.struct(i.alias("pos"), sizes_at(i).alias("sizes"))),
                    lambda h: F.size(h["sizes"]) > 0)
    return F.when(F.size(marks) > 0, let(hits, by_size)).otherwise(F.array().cast("array<struct<size:int,at:array<int>>>"))


def by_join(texts: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """(text_key, v) with the wanted windows, by joins that shuffle marks and texts instead of a literal table."""
    rows = texts.select("doc_id", "text_key", let(words_of(text_of()), marks_of).alias("marks")).select(
        "doc_id", "text_key", F.size("marks").alias("length"), F.posexplode("marks").alias("pos", "mark"))
    hits = rows.join(grams, "mark").groupBy("text_key", "size", "pos").agg(
        F.min("doc_id").alias("doc_id"), F.min("length").alias("length"))
    dense = hits.groupBy("text_key", "size").agg(
        F.sort_array(F.collect_list("pos")).alias("found"), F.min("doc_id").alias("doc_id"),
        F.min("length").alias("length")).filter(
        F.size("found") >= least_found(F.col("size"), F.col("length"), percent))
    at = starts(F.col("found"), F.col("size"), F.col("length"), percent)
    wanted = stash(dense.groupBy("text_key").agg(
        F.collect_list(F.struct("size", at.alias("at"))).alias("wanted"),
        F.min("doc_id").alias("of")), "wanted")
    bodies = texts.join(wanted.withColumnRenamed("text_key", "key"), (F.col("text_key") == F.col("key"))
                        & F.col("doc_id").eqNullSafe(F.col("of")))
    return bodies.select("text_key", F.explode(
        let(let(words_of(text_of()), marks_of), lambda m: cut(m, F.col("wanted")))).alias("v"))


def cut(marks: Column, wanted: Column) -> Column:
    """The marks of each wanted window that lies within the text, or is the text: structs of size, start, marks."""
    def one(by: Column, start: Column) -> Column:
        return F.struct(by["size"].alias("size"), start.alias("start"),
                        F.slice(marks, start + 1, by["size"] - (WORDS - 1)).alias("marks"))

    def inside(by: Column) -> Column:
        held = F.least(by["size"] - (WORDS - 1), F.size(marks))
        return F.filter(by["at"], lambda start: start + held <= F.size(marks))

    return F.flatten(F.transform(wanted, lambda by: F.transform(inside(by), lambda start: one(by, start))))


def windows_worth_a_look(texts: DataFrame, items: DataFrame, percent: int, in_plan: int = IN_PLAN) -> DataFrame:
    """(text_key, size, start, w) with the marks and the fingerprint of each window that can be similar enough.

    ``texts`` has text_key and text. Up to ``in_plan`` marks of the benchmark
    go into the plan, and texts are searched where they are read; a larger
    benchmark is joined.
    """
    grams = items.select("size", F.explode("marks").alias("mark")).distinct()
    if grams.limit(in_plan + 1).count() <= in_plan:
        table = table_of(grams)
        # Few windows are left. Written at once, so that the plan with the literal table is one stage.
        windows = stash(texts.select("text_key", F.explode(let(
            let(words_of(text_of()), marks_of), lambda m: cut(m, wanted_starts(m, table, percent)))).alias("v")), "windows")
    else:
        windows = by_join(texts, grams, percent)
    return windows.select("text_key", "v.size", "v.start", F.struct(
        F.col("v.marks").alias("marks"), simhash(F.col("v.marks")).alias("print")).alias("w"))


def matches(texts: DataFrame, benchmark: DataFrame, percent: int) -> DataFrame:
    """(text_key, item_id, start, n_words, shared, together): the best window of each text for each item found in it.

    ``together`` is the weight of window and item.
    """
    items = benchmark.select("item_id", let(words_of(text_of()), lambda w: F.struct(
        F.size(w).alias("size"), marks_of(w).alias("marks"))).alias("i")).select("item_id", "i.*").filter(
        F.size("marks") > 0).distinct()
    items = stash(items.withColumn("item_print", simhash(F.col("marks"))).withColumn(
        "item", F.monotonically_increasing_id()), "items")
    blocks = items.select("item", "size", "item_print", F.posexplode(F.array(*[
        block(F.col("item_print"), i) for i in range(BLOCKS)])).alias("number", "own"))
    index = stash(blocks.select("item", "size", "item_print", "number", F.explode(F.transform(
        F.lit(list(flips(WIDTH, RADIUS // BLOCKS))), lambda m: m.bitwiseXOR(F.col("own")))).alias("value")), "index")

    prints = windows_worth_a_look(texts, items, percent).select("text_key", "size", "start", "w", F.posexplode(F.array(*[
        block(F.col("w.print"), i) for i in range(BLOCKS)])).alias("number", "value"))
    apart = F.col("w.print").bitwiseXOR(F.col("item_print"))
    # A pair may meet in several blocks; the first of them stands for all.
    first = F.coalesce(*[F.when(F.bit_count(block(apart, i)) <= RADIUS // BLOCKS, i) for i in range(BLOCKS)])
    near = prints.join(small_or_not(index), ["size", "number", "value"]).filter(
        (F.bit_count(apart) <= RADIUS) & (first == F.col("number"))).select("text_key", "item", "start", "w.marks")
    wholes = small_or_not(items.select("item", "item_id", "size", F.col("marks").alias("item_marks")))
    judged = near.join(wholes, "item").withColumn("shared", shared_weight(F.col("marks"), F.col("item_marks"))).withColumn(
        "n_words", F.size("marks") + (WORDS - 1)).withColumn("together", F.size("marks") + F.size("item_marks"))
    good = judged.filter(F.col("shared") >= needed(F.col("together"), percent))
    best = good.groupBy("text_key", "item", "item_id").agg(
        F.max(F.struct("shared", -F.col("start"), "n_words", "together")).alias("best"))
    return stash(best.select("text_key", "item_id", (-F.col("best")["col2"]).alias("start"),
                             "best.n_words", "best.shared", "best.together"), "matches")


def keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("text_key", F.md5("text"))


def find_benchmark(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, start, n_words, shared, similarity.

    ``start`` is the word (from 0) at which the best window begins, the first of
    the best; ``n_words`` its words, fewer than the item's only where the text has fewer; ``shared`` its common weight. Words are compared in lower case.
    Null or empty texts, and items of fewer than WORDS words, match nothing. Null
    ids are carried through; rows that repeat an id are searched each, and equal
    results returned once; so are rows that repeat an item's id. Empty tables give no rows. Other columns are ignored.
    """
    texts = keyed(documents.select("doc_id", "text"))
    found = small_or_not(matches(texts, benchmark, percent))
    return texts.select("doc_id", "text_key").join(found, "text_key").select(
        "doc_id", "item_id", F.col("start").cast("long").alias("start"), F.col("n_words").cast("long").alias("n_words"),
        F.col("shared").cast("long").alias("shared"), (F.col("shared") / (F.col("together") - F.col("shared"))).alias("similarity")
    ).distinct()


def without_benchmark(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of documents in which no item is found, all columns as they are."""
    found = matches(keyed(documents.select("doc_id", "text")), benchmark, percent).select("text_key").distinct()
    found = small_or_not(found)
    key = "__text_key"
    kept = documents.withColumn(key, F.md5("text")).join(found.withColumnRenamed("text_key", key), key, "left_anti")
    return kept.select(*documents.columns)
