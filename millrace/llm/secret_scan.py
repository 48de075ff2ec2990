"""Secrets in text: fixed patterns, and windows of high entropy inside long tokens.

Runs of letters must also differ from words: a window counts only if enough of
its letter pairs are rare in words. Tokens of digits alone are left out, as
neither entropy nor pairs tell secret ones from ids and other numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPANS, counts_of, let, listed, of_kind, spans_of, text_of

#: Fixed patterns of the base kinds, in listing order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
BASE_KINDS = ("assign", "access", "hex")

#: Candidate strings: longest runs of token characters.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20

#: Character classes by the pattern the whole candidate must fit, first fit wins, and the bits per
#: character above which a window of WINDOW characters counts as random.
CLASSES: list[tuple[str, str, float]] = [
    ("digits", r"^[0-9]+$", 99.0),  # out of reach: left out
    ("hexadecimal", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9),
    ("lower", r"^[a-z]+$", 3.1),
    ("upper", r"^[A-Z]+$", 3.1),
    ("mixed", r"^[A-Za-z]+$", 3.4),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.7),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
]
#: Letter pairs usual in words of English, German, French and Spanish, and how many of the WINDOW - 1 pairs of a window
#: of letters must be others.
COMMON_PAIRS = (
    "aa ac ad ae ai al am an ar as at au ay be bl bo ca ce ch ci co ct da de di do dt du ea eb ec ed ee eh ei el "
    "em en eo ep eq er es et eu ev ew ez fo ga ge ha hb hc he hg hh hi hl hn ho hr hs ht hu ia ic id ie ig il im "
    "in io ir is it ja ke la le li ll lo ly ma me mi mp na nb nc nd ne ng nh ni nk nl nm nn no np nq nr ns nt nu "
    "nv nw nz oa oc oe of oi ol om on or os ot ou ow pa pe pf po pr qu ra rb re rh ri rn ro rr rs rt sa sc sd se "
    "sg sh si sj sl sm so sq sr ss st su ta tb te th ti to tr ts tt ty tz ua ue uf ui ul un uo ur us ut ux ve vi "
    "vo wa wh xa xe xo zu "
)
ODD_PAIRS = 10
#: Candidates that are never secrets, by a pattern found anywhere in them.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[a-z]+(?:[-_/][a-z]+)+$",
    r"(?i:example|sample|dummy|placeholder|changeme)",
    r"(?i:abcdefghij|0123456789|1234567890)",
    r"^(.)\1+$",
]


def random_spans(candidate: Column, threshold: Column) -> Column:
    """Longest runs of overlapping windows whose entropy reaches the threshold.

    The window slides by one character. Counts are kept as one character per
    letter of the alphabet; a step changes one of them up and one down, and with
    them the running sum of c log2 c. In a run of letters the unusual pairs are
    counted likewise.
    """
    letters = F.regexp_like(candidate, F.lit(r"^[A-Za-z]+$"))
    parts = F.array(*[F.lit(0.0 if c == 0 else c * math.log2(c)) for c in range(WINDOW + 2)])
    start = F.struct(F.lit("0" * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"),
                     F.lit(0).alias("odd"), F.array().cast(SPANS).alias("found"))

    def changed(counts: Column, total: Column, ch: Column, by: int) -> Column:
        at = F.instr(F.lit(ALPHABET), ch)
        return let(F.struct(at.alias("at"), (F.ascii(F.substring(counts, at, F.lit(1))) - 48).alias("c")),
                   lambda x: F.struct(
                       F.overlay(counts, F.char((x["c"] + (48 + by)).cast("long")), x["at"], F.lit(1)).alias("counts"),
                       (total + F.get(parts, x["c"] + by) - F.get(parts, x["c"])).alias("total")))

    def odd(i: Column) -> Column:
        """One if the pair that begins at ``i`` is unusual."""
        return (F.instr(F.lit(COMMON_PAIRS), F.lower(F.substring(candidate, i, F.lit(2)))) == 0).cast("int")

    def step(acc: Column, i: Column) -> Column:
        added = changed(acc["counts"], acc["total"], F.substring(candidate, i, F.lit(1)), 1)
        moved = let(added, lambda a: F.when(i <= WINDOW, a).otherwise(
            changed(a["counts"], a["total"], F.substring(candidate, i - WINDOW, F.lit(1)), -1)))
        pairs = F.when(letters, acc["odd"] + F.when(i > 1, odd(i - 1)).otherwise(0)
                       - F.when(i > WINDOW, odd(i - WINDOW)).otherwise(0)).otherwise(0)

        def noted(m: Column) -> Column:
            bits = math.log2(WINDOW) - m["total"] / WINDOW
            last = F.element_at(acc["found"], -1)
            fresh = F.struct((i - WINDOW).alias("start"), i.alias("end"), F.lit("").alias("hit"))
            longer = F.struct(last["start"].alias("start"), i.alias("end"), F.lit("").alias("hit"))
            n = F.size(acc["found"])
            joined = F.when((n > 0) & (last["end"] >= i - WINDOW),
                            F.concat(F.slice(acc["found"], F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(longer))
                            ).otherwise(F.concat(acc["found"], F.array(fresh)))
            return F.struct(m["counts"].alias("counts"), m["total"].alias("total"), pairs.alias("odd"),
                            F.when((i >= WINDOW) & (bits >= threshold) & (~letters | (pairs >= ODD_PAIRS)), joined).otherwise(acc["found"]).alias("found"))

        return let(moved, noted)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(candidate)), start, step)["found"]


def entropy_spans(text: Column) -> Column:
    """Spans of kind ``entropy`` over all candidates of the text that no allow-list pattern fits."""
    def threshold(c: Column) -> Column:
        bits = F.lit(99.0)
        for _, pattern, least in reversed(CLASSES):
            bits = F.when(F.regexp_like(c, F.lit(pattern)), F.lit(least)).otherwise(bits)
        return bits

    def suspect(s: Column) -> Column:
        benign = F.lit(False)
        for pattern in ALLOWED:
            benign = benign | F.regexp_like(s["hit"], F.lit(pattern))
        return ~benign

    def within(s: Column) -> Column:
        runs = let(threshold(s["hit"]), lambda t: random_spans(s["hit"], t))
        return F.transform(runs, lambda r: F.struct(
            (s["start"] + r["start"]).alias("start"), (s["start"] + r["end"]).alias("end"),
            F.substring(s["hit"], r["start"] + 1, r["end"] - r["start"]).alias("hit")))

    return F.flatten(F.transform(F.filter(spans_of(text, TOKEN), suspect), within))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by start, then kind as listed."""
    assign = F.filter(spans_of(text, ASSIGN),
                      lambda s: F.char_length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= 6)
    named = F.regexp_like(text, F.lit(r"(?i:password|passwd|secret|token|api_?key)"))
    assign = F.when(named, assign).otherwise(F.array().cast(SPANS))
    access = F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)).otherwise(F.array().cast(SPANS))
    one = F.lit(1.0)
    return F.array_sort(F.concat(of_kind(assign, "assign", 0, one), of_kind(access, "access", 1, one),
                                 of_kind(spans_of(text, HEX), "hex", 2, one)))


def find_secrets(documents: DataFrame, text: str = "text", found: str = "secrets") -> DataFrame:
    """All columns plus ``found``: structs (start, rank, end, kind, score, hit) by start, then kind.

    Offsets count code points; ends are exclusive. Null and empty texts have no
    secrets. A token inside a base span still gets its own ``entropy`` span.
    The column ``found`` is replaced where it exists; others stay as they are.
    """
    body = text_of(text)
    extra = of_kind(entropy_spans(body), "entropy", len(BASE_KINDS), F.lit(0.5))
    return documents.withColumn(found, F.array_sort(F.concat(base_spans(body), extra)))


def secrets_digest(documents: DataFrame) -> DataFrame:
    """The spans of ``find_secrets`` as counts and digests, one row per document."""
    spans = find_secrets(documents.select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE_KINDS))
    return spans.select("doc_id", *counts_of("secrets", BASE_KINDS),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))
