"""Toxicity by two Kneser-Ney bigram models, one of toxic and one of ordinary text.

Counts come from every labelled training row: words first, then bigrams over the
words the models know. A document counts an expression once, however often it
repeats it, and copies of a text count once. A bigram's probability in a class
backs off to the class's continuation counts (in how many contexts a word was
seen), and these to the continuation counts of both classes together. An
expression whose counts do not differ between the classes beyond chance and by
RATIO, as of most, has the shared counts in both. A text's measure is the
difference of its two log-likelihoods divided by its number of words. A logistic
curve turns measure and length into a score; it is fitted on texts measured by
models that did not count them (two folds).

Words seen in fewer than LEAST_SEEN training documents are one unknown word, whose
bigrams have no difference of their own. Words and bigrams are counted as tables that
grow with the labelled text; a word is named by KEY_BITS of a hash, and the rare words
of a document come to it by a join. Only words and bigrams that differ have a
difference other than that of their backoff, zero in the end, so these are all
that scoring looks up: sent to tasks if a count shows at most SENT of them, else
joined with the bigrams of the texts, by the same rule. The one bound is that the
curve is fitted on at most FITTED rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import small_or_not, stash

FITTED = 20_000
#: Rows of the model (8 to 40 bytes each) that may be sent to tasks.
SENT = 1_000_000
#: At most 3: the two documents of a rarer word are found as the least and the greatest.
LEAST_SEEN = 3
CACHED_WORDS = 100_000
#: Words, documents and bigrams that a task counts together before it sends its counts on.
HELD_WORDS, HELD_ROWS, HELD_PAIRS = 200_000, 30_000, 3_000_000
#: Bits of a word's hash, of a cell's number, and of a count on its way; a task's counts are at most HELD_ROWS.
#: A word, a cell and a count make one number. Words that share a hash, one pair in 2**46, would count as one word.
KEY_BITS, CELL_BITS, COUNT_BITS = 46, 2, 16
#: First bits of a hash by which the bigrams after one word are dealt.
SALT_BITS = 4
#: Log-likelihood ratio (G2) from which counts of the classes differ beyond chance, over tens of thousands of tests.
BEYOND_CHANCE = 20.0
#: How many times larger one class's share of documents must be. Small differences, such as that toxic texts are a little
#: longer, pass any test once there are enough texts, so a model of all rows would have them and one of a fold would not.
RATIO = 3.0
DISCOUNT = 0.75
THRESHOLD = 0.7
#: Rows whose id has this remainder are held out.
FOLDS, HELD_OUT = 3, 1
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "…“”„‘’«»¿¡"
#: Keys of the unknown word and of a text's start; those of other words are hashes.
UNKNOWN, START = 0, 1
#: Count columns: class (toxic, ordinary) by fold (first, second).
CELLS = ("t0", "o0", "t1", "o1")
#: Models: of one fold, the other, both.
GROUPS = ("0", "1", "01")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return [w for w in (x.strip(EDGES) for x in (text or "").lower().split()) if w]


def hashed(word: str) -> int:
    """The first KEY_BITS of what Spark's xxhash64 gives."""
    return max(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) >> 64 - KEY_BITS, START + 1)


def key_of(word: str) -> Column:
    return F.greatest(F.shiftrightunsigned(F.xxhash64(word), 64 - KEY_BITS), F.lit(START + 1))


def within(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which of the keys are in the sorted ``held``."""
    if not len(held):
        return np.zeros(len(keys), bool)
    return held[np.minimum(np.searchsorted(held, keys), len(held) - 1)] == keys


def keys_of(words: list[str], cache: dict[str, int]) -> list[int]:
    if len(cache) > CACHED_WORDS:
        cache.clear()
    for w in words:
        if w not in cache:
            cache[w] = hashed(w)
    return [cache[w] for w in words]


def joined(previous: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for a bigram."""
    x = (previous.view("uint64") ^ (previous.view("uint64") >> np.uint64(31))) * MIX
    return ((x ^ (x >> np.uint64(29))) + word.view("uint64")).view("int64")


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by word, the counts of the cells in one number, and the least and greatest row that has the word."""
    found: dict[str, list[int]] = {}

    def out() -> pd.DataFrame:
        return pd.DataFrame([(w, *x) for w, x in found.items()], columns=["word", "counts", "least", "greatest"])

    held = 0
    for pdf in batches:
        for text, cell, row in zip(pdf["text"], pdf["cell"], pdf["row"]):
            one = 1 << COUNT_BITS * cell
            for w in set(words_of(text)):
                x = found.get(w)
                if x is None:
                    found[w] = [one, row, row]
                else:
                    x[0] += one
                    x[1:] = min(x[1], row), max(x[2], row)
            held += 1
            if len(found) >= HELD_WORDS or held >= HELD_ROWS:
                yield out()
                found, held = {}, 0
    if found:
        yield out()


def cells(counts: str = "counts") -> list[Column]:
    """Sums of the cells of counts that are packed in one number."""
    mask = F.lit((1 << COUNT_BITS) - 1)
    return [F.sum(F.shiftrightunsigned(counts, COUNT_BITS * i).bitwiseAND(mask)).alias(c) for i, c in enumerate(CELLS)]


def coded(texts: pd.Series, cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the texts' words, each text with words led by START, and where each text begins and ends."""
    ids: list[int] = []
    ends = [0]
    for text in texts:
        words = words_of(text)
        if words:
            ids.append(START)
            ids.extend(keys_of(words, cache))
        ends.append(len(ids))
    return np.array(ids, "int64"), np.array(ends)


def count_bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by bigram and cell; ``entry`` has the word, the cell and the count, ``salt`` the first bits of the word.

    The words in ``rare`` are unknown.
    """
    cache: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> pd.DataFrame:
        previous, entry = (np.concatenate(x) for x in zip(*held))
        by = np.lexsort((entry, previous))  # neighbours that agree compress
        previous, entry = previous[by], entry[by]
        first = np.flatnonzero(np.append(True, (previous[1:] != previous[:-1]) | (entry[1:] != entry[:-1])))
        count = np.diff(np.append(first, len(entry))).astype("uint64")
        previous, entry = previous[first], entry[first]
        return pd.DataFrame({"previous": previous, "salt": (entry >> np.uint64(64 - SALT_BITS)).astype("int32"),
                             "entry": (entry | count).view("int64")})

    for pdf in batches:
        flat, ends = coded(pdf["text"], cache)
        for a, b, cell, rare in zip(ends[:-1], ends[1:], pdf["cell"], pdf["rare"]):
            if a == b:
                continue
            if rare is not None and len(rare):
                flat[a:b][within(flat[a:b], np.sort(np.asarray(rare, "int64")))] = UNKNOWN
            previous, word = flat[a:b - 1], flat[a + 1:b]
            _, at = np.unique(joined(previous, word), return_index=True)
            named = (word[at].view("uint64") << np.uint64(CELL_BITS) | np.uint64(cell)) << np.uint64(COUNT_BITS)
            held.append((previous[at], named))
            size += len(at)
            if size >= HELD_PAIRS or len(held) >= HELD_ROWS:
                yield out()
                held.clear()
                size = 0
    if held:
        yield out()


def text_bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bigrams of each text and how often, after a row (START, START) with the number of its words."""
    cache: dict[str, int] = {}
    for pdf in batches:
        flat, ends = coded(pdf["text"], cache)
        for a, b, key, which in zip(ends[:-1], ends[1:], pdf["key"], pdf["which"]):
            previous, word = flat[a:max(b - 1, a)], flat[a + 1:b]
            _, at, n = np.unique(joined(previous, word), return_index=True, return_counts=True)
            yield pd.DataFrame({"key": key, "which": which, "previous": np.append(START, previous[at]),
                                "word": np.append(START, word[at]), "n": np.append(len(word), n)})


def g2(toxic: list[str], ordinary: list[str], documents: dict[str, int]) -> Column:
    """Log-likelihood ratio of counts, out of so many documents of each class."""
    n_toxic, n_ordinary = sum(documents[c] for c in toxic), sum(documents[c] for c in ordinary)
    share = n_toxic / max(n_toxic + n_ordinary, 1)
    a, b = sum((F.col(c) for c in toxic), F.lit(0)), sum((F.col(c) for c in ordinary), F.lit(0))

    def term(count: Column, part: float) -> Column:
        return F.when(count > 0, count * F.log(count / ((a + b) * max(part, 1e-12)))).otherwise(0.0)

    return 2 * (term(a, share) + term(b, 1 - share))


#: What scoring looks up, as plain arrays, which need no class on the workers: sorted keys of the words and bigrams that
#: differ, and their differences by model; NaN where a bigram has none of its own in a model.
Model = dict[str, np.ndarray]


def difference(model: Model, which: int, previous: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Log-likelihood difference of each bigram: its own entry, or what it backs off to."""
    out = np.zeros(len(word))
    if len(held := model["words"]):
        at = np.minimum(np.searchsorted(held, word), len(held) - 1)
        out = np.where(held[at] == word, model["by_word"][at, which], out)
    if len(held := model["joined"]):
        at = np.minimum(np.searchsorted(held, joined(previous, word)), len(held) - 1)
        own = model["by_pair"][at, which]
        out = np.where((model["previous"][at] == previous) & (model["word"][at] == word) & ~np.isnan(own), own, out)
    return out


def measured(model, pick) -> object:
    """Adds n_words and the mean difference per word, by the model that ``pick`` names for a row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for pdf in batches:
            flat, ends = coded(pdf["text"], cache)
            previous = np.concatenate([flat[:1], flat[:-1]])
            which = pick(pdf)
            gaps = np.diff(ends)
            lengths = np.maximum(gaps - 1, 0)
            sums = np.zeros(len(pdf))
            for m in np.unique(which):
                rows = which == m
                inner = np.repeat(rows, gaps)
                inner[ends[:-1][gaps > 0]] = False
                owner = np.repeat(np.arange(len(pdf)), gaps)[inner]
                sums += np.bincount(owner, difference(model.value, m, previous[inner], flat[inner]), len(pdf))
            out = pdf.drop(columns="text")
            out["n_words"], out["measure"] = lengths, sums / np.maximum(lengths, 1)
            yield out
    return run


def features(measure: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    size = np.log1p(n_words)
    return np.stack([np.ones(len(measure)), measure, measure * np.sqrt(n_words), measure * size, size], axis=1)


def curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps with a small penalty.

    A step is halved until it lowers the penalised loss enough. Whole steps can overshoot to where every row is
    certain; there the penalty alone makes the next step, and the weights only grow.
    """
    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, (1 - 2 * y) * (x @ w)).sum() + ridge / 2 * w @ w

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), gradient)
        gain, slack = gradient @ step, 1e-12 * (1 + now)
        if np.abs(step).max() < 1e-8 or gain < slack:
            return w - step
        for part in 0.5 ** np.arange(60):
            then = loss(w - part * step)
            if then <= now - 1e-4 * part * gain + slack:
                break
        w, now = w - part * step, then
    raise ValueError(f"the toxicity curve did not settle: weights {w}")


@dataclass
class Tables:
    """A fitted model: differences ``m0``, ``m1``, ``m01`` by model of words (key) and of bigrams (previous, word).

    A word that differs in one model only has 0 in the others; a bigram has NULL there, and backs off to its word.
    """

    words: DataFrame
    pairs: DataFrame

    @cached_property
    def sent(self) -> object | None:
        """The model as a broadcast, or None if it has too many rows."""
        if any(p.limit(SENT + 1).count() > SENT for p in (self.words, self.pairs)):
            return None
        words, pairs = self.words.toPandas().sort_values("key"), self.pairs.toPandas()
        code = joined(pairs["previous"].to_numpy("int64"), pairs["word"].to_numpy("int64"))
        order, columns = np.argsort(code), [f"m{g}" for g in GROUPS]
        model = {"words": words["key"].to_numpy("int64"), "by_word": words[columns].to_numpy(float), "joined": code[order],
                 "by_pair": pairs[columns].to_numpy(float)[order],
                 "previous": pairs["previous"].to_numpy("int64")[order], "word": pairs["word"].to_numpy("int64")[order]}
        return self.words.sparkSession.sparkContext.broadcast(model)

    def measures(self, texts: DataFrame) -> DataFrame:
        """(key, n_words, measure) of rows (key, text, which), by the model at that place in GROUPS."""
        kind = texts.schema["key"].dataType.simpleString()
        if self.sent is not None:
            return texts.mapInPandas(
                measured(self.sent, lambda pdf: pdf["which"].to_numpy()),
                f"key {kind}, which int, n_words long, measure double").drop("which")
        rows = texts.mapInPandas(text_bigrams, f"key {kind}, which int, previous long, word long, n long")
        start = self.words.sparkSession.createDataFrame([(START,)], "word long")
        # Whatever has no difference adds nothing and is left out before anything is shuffled.
        some = stash(self.words.select(F.col("key").alias("word")).union(self.pairs.select("word")).union(start).distinct(),
                     "looked-up")
        rows = rows.join(small_or_not(some, SENT), "word", "left_semi")

        def by_model(name: str) -> Column:
            return F.array(*[F.col(f"m{g}") for g in GROUPS]).alias(name)

        pairs = self.pairs.select("previous", "word", by_model("own"))
        words = self.words.select(F.col("key").alias("word"), by_model("back"))
        rows = rows.join(small_or_not(pairs, SENT), ["previous", "word"], "left").join(
            small_or_not(words, SENT), "word", "left")
        gap = F.coalesce(F.get("own", "which"), F.get("back", "which"), F.lit(0.0))
        counts = F.col("word") == START
        sums = rows.groupBy("key").agg(F.sum(F.when(counts, F.col("n")).otherwise(0)).alias("n_words"),
                                       F.sum(F.when(counts, 0.0).otherwise(F.col("n") * gap)).alias("total"))
        return sums.select("key", "n_words", (F.col("total") / F.greatest("n_words", F.lit(1))).alias("measure"))


@dataclass
class Scorer:
    """Tables of the model, and weights of the curve."""

    tables: Tables
    weights: np.ndarray

    def with_score(self, documents: DataFrame, score: str = "score") -> DataFrame:
        """Adds the score of the column text; null and empty texts get the score of no words."""
        if self.tables.sent is not None:
            return documents.withColumn(score, self._column())
        key = "__text_key"
        keyed = documents.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
        texts = keyed.groupBy(F.col(key).alias("key")).agg(F.first("text").alias("text"))
        size, m = F.log1p("n_words"), F.col("measure")
        z = sum(w * x for w, x in zip(map(float, self.weights), (F.lit(1.0), m, m * F.sqrt("n_words"), m * size, size)))
        scores = self.tables.measures(texts.withColumn("which", F.lit(len(GROUPS) - 1))).select(
            F.col("key").alias(key), (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).alias(score))
        return keyed.drop(score).join(small_or_not(stash(scores, "scores")), key).drop(key)

    def _column(self) -> Column:
        weights = self.weights
        run = measured(self.tables.sent, lambda pdf: np.full(len(pdf), len(GROUPS) - 1))

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for pdf in run(pd.DataFrame({"text": texts}) for texts in batches):
                z = features(pdf["measure"].to_numpy(), pdf["n_words"].to_numpy()) @ weights
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score("text")


def held_out(column: str) -> Column:
    remainder = F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == HELD_OUT
    return F.coalesce(remainder, F.lit(False))


def fitted(rows: DataFrame, documents: dict[str, int]) -> Tables:
    """Kneser-Ney estimates of both classes, by model, from rows (row, text, cell)."""
    seen = sum((F.col(c) for c in CELLS[1:]), F.col(CELLS[0]))
    # Counted in the tasks already, so rows go to their key as they are, in few bytes, and are added up there.
    words = stash(rows.select("text", "cell", "row").mapInPandas(
        count_words, "word string, counts long, least long, greatest long").repartition("word").groupBy("word").agg(
        *cells(), F.min("least").alias("least"), F.max("greatest").alias("greatest")).withColumn(
        "key", key_of("word")), "words")
    rare = words.filter(seen < LEAST_SEEN).select(
        F.explode(F.array_distinct(F.array("least", "greatest"))).alias("row"), "key").groupBy("row").agg(
        F.collect_list("key").alias("rare"))
    known = words.filter(seen >= LEAST_SEEN)
    cell = F.shiftrightunsigned("entry", COUNT_BITS).bitwiseAND(F.lit(len(CELLS) - 1))
    count = F.col("entry").bitwiseAND(F.lit((1 << COUNT_BITS) - 1))
    by_cell = [F.sum(F.when(cell == i, count).otherwise(0)).alias(c) for i, c in enumerate(CELLS)]
    pairs = stash(rows.select("text", "cell", "row").join(rare, "row", "left").select("text", "cell", "rare").mapInPandas(
        count_bigrams, "previous long, salt int, entry long").repartition("previous", "salt").groupBy(
        "previous", "salt", F.shiftrightunsigned("entry", CELL_BITS + COUNT_BITS).alias("word")).agg(*by_cell).drop("salt"),
        "bigrams")

    def of(c: str, g: str) -> Column:
        """Documents of a class in the folds of a model."""
        return sum((F.col(f"{c}{f}") for f in g), F.lit(0))

    def kinds(classes: str, prefix: str) -> list[Column]:
        """How many different bigrams, by class and folds."""
        return [F.count_if(sum((of(c, g) for c in classes), F.lit(0)) > 0).alias(f"{prefix}{g}") for g in GROUPS]

    def telling(g: str) -> Column:
        """Whether the classes' shares of documents differ beyond chance, and enough to matter."""
        shares = [(of(c, g) + 0.5) / max(sum(documents[f"{c}{f}"] for f in g), 1) for c in "to"]
        enough = (shares[0] >= RATIO * shares[1]) | (shares[1] >= RATIO * shares[0])
        return enough & (g2([f"t{f}" for f in g], [f"o{f}" for f in g], documents) >= BEYOND_CHANCE)

    # A word of a class has a word or the start before it there, so it has some bigram.
    used = {f"{c}{g}": of(c, g) > 0 for c in "to" for g in GROUPS}
    unknown = F.col("key") == UNKNOWN
    named = words.withColumn("key", F.when(seen >= LEAST_SEEN, F.col("key")).otherwise(UNKNOWN))
    some = named.agg(*[F.count_if(u & ~unknown).alias(k) for k, u in used.items()], *[
        F.max((u & unknown).cast("int")).alias(f"unknown_{k}") for k, u in used.items()],
        F.count_if(~unknown).alias("known")).first().asDict()
    totals = pairs.agg(*kinds("t", "nt"), *kinds("o", "no"), *kinds("to", "s")).first().asDict()
    totals |= {f"some_n{k}": (some[k] or 0) + (some[f"unknown_{k}"] or 0) for k in used}
    size = some["known"] + 2

    def p_word(c: str, g: str) -> Column:
        """A word's probability; needs the columns of follows and ``differs`` by model."""
        shared = (F.coalesce(f"s{g}", F.lit(0)) + 1.0) / float(totals[f"s{g}"] + size)
        n = float(max(totals[f"n{c}{g}"], 1))
        rest = DISCOUNT * totals[f"some_n{c}{g}"] / n if totals[f"n{c}{g}"] else 1.0
        own = F.greatest(F.coalesce(f"n{c}{g}", F.lit(0)) - DISCOUNT, F.lit(0.0)) / n + rest * shared
        return F.when(F.col(f"differs{g}"), own).otherwise(shared)

    tests = [telling(g).alias(f"differs{g}") for g in GROUPS]
    any_differs = F.expr(" OR ".join(f"differs{g}" for g in GROUPS))
    differing = stash(known.select("key", *tests).filter(any_differs), "differing")
    of_known = (F.col("previous") != UNKNOWN) & (F.col("word") != UNKNOWN)
    own = stash(pairs.filter(of_known & (seen >= 2 * LEAST_SEEN)).select(
        "*", *[telling(g).alias(f"own{g}") for g in GROUPS]).filter(" OR ".join(f"own{g}" for g in GROUPS)), "telling")
    # Sums by word are wanted for what differs only, so little else is shuffled.
    wanted = stash(differing.select(F.col("key").alias("word")).union(own.select("word")).distinct(), "wanted")
    follows = stash(pairs.join(small_or_not(wanted), "word", "left_semi").groupBy("word").agg(
        *kinds("t", "nt"), *kinds("o", "no"), *kinds("to", "s")), "follows")
    by_word = differing.join(follows.withColumnRenamed("word", "key"), "key", "left").select("key", *[
        F.when(F.col(f"differs{g}"), F.log(p_word("t", g)) - F.log(p_word("o", g))).otherwise(0.0).alias(f"m{g}")
        for g in GROUPS])

    before = stash(own.select("previous").distinct(), "before")
    contexts = pairs.join(small_or_not(before), "previous", "left_semi").groupBy("previous").agg(
        *[F.sum(of(c, g)).alias(f"all_{c}{g}") for c in "to" for g in GROUPS], *kinds("t", "kt"), *kinds("o", "ko"))

    def log_pair(c: str, g: str) -> Column:
        total = F.col(f"all_{c}{g}")
        left = F.when(total > 0, DISCOUNT * F.col(f"k{c}{g}") / total).otherwise(1.0)
        return F.log(F.greatest(of(c, g) - DISCOUNT, F.lit(0.0)) / F.greatest(total, F.lit(1)) + left * p_word(c, g))

    differs = differing.withColumnRenamed("key", "word")
    by_pair = own.join(contexts, "previous").join(follows, "word").join(differs, "word", "left").select(
        "previous", "word", *[F.when(F.col(f"own{g}"), log_pair("t", g) - log_pair("o", g)).alias(f"m{g}") for g in GROUPS])
    return Tables(stash(by_word, "by-word"), stash(by_pair, "by-pair"))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> Scorer:
    """Fit on the labelled rows that are not held out.

    ``labels`` (doc_id, toxic): repeated rows count as toxic if any says so;
    null labels and null ids are left out. With no training rows, or of one
    class only, the curve is flat at the share of toxic rows, one half for none.
    """
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).filter(~held_out("doc_id"))
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0).cast("int")
    texts = documents.select("doc_id", "text").filter(~held_out("doc_id"))
    same = stash(texts.select("doc_id", F.xxhash64("text").alias("same")).join(small_or_not(marks), "doc_id"), "training")
    firsts = same.groupBy("same", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic").distinct()
    rows = stash(texts.join(small_or_not(firsts), "doc_id").withColumn("fold", fold).withColumn(
        "cell", 2 * F.col("fold") + (F.col("toxic") != 1).cast("int")).withColumn(
        "row", F.monotonically_increasing_id()), "distinct")
    documents_of = {c: 0 for c in CELLS} | {CELLS[r["cell"]]: r["count"] for r in rows.groupBy("cell").count().collect()}
    tables = fitted(rows, documents_of)

    sample = rows.select("row", "toxic", F.xxhash64("doc_id").alias("at")).orderBy("at", "row").limit(FITTED)
    sample = stash(sample.select("row", "toxic"), "sample")
    fit = tables.measures(rows.join(F.broadcast(sample.select("row")), "row").select(
        F.col("row").alias("key"), "text", (1 - F.col("fold")).alias("which"))).join(
        F.broadcast(sample), F.col("key") == F.col("row")).select("toxic", "n_words", "measure").toPandas()
    y = (fit["toxic"] == 1).to_numpy(float)
    if 0 < y.sum() < len(y):
        weights = curve(features(fit["measure"].to_numpy(), fit["n_words"].to_numpy()), y)
    else:
        share = (y.sum() + 0.5) / (len(y) + 1)
        weights = np.array([np.log(share / (1 - share)), 0, 0, 0, 0])
    if not np.isfinite(weights).all():
        raise ValueError(f"the toxicity curve was not fitted: weights {weights}")
    return Scorer(tables, weights)


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words; a null id is never
    held out. Repeated rows are scored alike. Other columns are ignored.
    """
    scorer = train(documents.sparkSession, documents, labels)
    scored = scorer.with_score(documents.select("doc_id", "text"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that are not scored at the threshold or above, all columns as they are."""
    scorer = train(documents.sparkSession, documents, labels)
    score = "__score"
    return scorer.with_score(documents, score).filter(
        F.coalesce(F.col(score) < THRESHOLD, F.lit(True))).select(*documents.columns)
