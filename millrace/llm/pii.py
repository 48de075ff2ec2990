"""Personal data in text: patterns propose spans, checksums confirm them, context words move the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPANS, counts_of, let, listed, of_kind, spans_of, text_of

#: Fixed patterns of the base kinds, in listing order. Same matches as the
#: plain forms, written without nested repeats so that long texts need neither
#: a deep stack nor repeated scans: a start inside a run could only match what
#: the run's own start matches, unless an earlier match ended there (\G).
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
         r"[A-Za-z0-9.-]*?(?![A-Za-z0-9-]|\.[A-Za-z0-9-])")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]*?(?![0-9]|[\x20-][0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

#: Added kinds: bank account numbers (mod 97), and number forms that only context words make personal.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
NUMBER = r"(?<![0-9A-Za-z+.-])[0-9]{3,4}[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z]|[.-][0-9])"

#: Score of a proposed span, and what a context word within REACH characters before it adds or takes.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "number": 0.2}
CONTEXT = {
    "email": r"(?i:\b(?:e-?mail|mail|contact|write to)\b)",
    "ip": r"(?i:\b(?:ip|address|host|server|from)\b)",
    "card": r"(?i:\b(?:card|visa|mastercard|credit|payment|pay)\b)",
    "phone": r"(?i:\b(?:phone|tel|telephone|call|mobile|fax|cell)\b)",
    "iban": r"(?i:\b(?:iban|account|bank|transfer)\b)",
    "number": r"(?i:\b(?:phone|tel|telephone|call|mobile|fax|cell|ssn|social security|passport|id no)\b)",
}
AGAINST = r"(?i:\b(?:version|order|isbn|issn|serial|invoice|example)\b)"
REACH, ADDED, TAKEN, LEAST = 40, 0.4, 0.3, 0.5


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.char_length(digits) - i + 1, F.lit(1))) - 48
        return total + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number leaves 1 on division by 97, letters counting from A = 10."""
    def moved(compact: Column) -> Column:
        turned = F.concat(F.substring(compact, F.lit(5), F.char_length(compact)), F.substring(compact, 1, 4))

        def folded(text: Column) -> Column:
            def add(rest: Column, i: Column) -> Column:
                code = F.ascii(F.substring(text, i, F.lit(1)))
                return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

            return F.aggregate(F.sequence(F.lit(1), F.char_length(text)), F.lit(0), add) == 1

        return let(turned, folded)

    return let(F.regexp_replace(account, " ", ""), moved)


def base_spans(text: Column) -> Column:
    """Confirmed spans of the base kinds, by kind: arrays of start, end and matched text."""
    none = F.array().cast(SPANS)
    octet = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    address = rf"^{octet}\.{octet}\.{octet}\.{octet}$"
    email = F.when(F.contains(text, F.lit("@")), spans_of(text, EMAIL)).otherwise(none)
    ip = F.filter(spans_of(text, IP), lambda s: F.regexp_like(s["hit"], F.lit(address)))
    digits = F.regexp_like(text, F.lit(r"[0-9][0-9\x20-]{11}"))
    card = F.filter(spans_of(text, CARD), lambda s: let(digits_of(s["hit"]), lambda d: F.when(
        F.char_length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))))
    card = F.when(digits, card).otherwise(none)
    phone = F.filter(spans_of(text, PHONE), lambda s: F.char_length(digits_of(s["hit"])).between(9, 15))
    phone = F.when(F.contains(text, F.lit("+")), phone).otherwise(none)
    return F.struct(*[c.alias(k) for k, c in zip(BASE_KINDS, (email, ip, card, phone))])


def find_pii(documents: DataFrame, text: str = "text", found: str = "pii") -> DataFrame:
    """All columns plus ``found``: structs (start, rank, end, kind, score, hit) in listing order of kind, then start.

    Offsets count code points; ends are exclusive. Base kinds are reported
    whatever their score; added kinds need a score of LEAST. Null and empty
    texts have none. The column ``found`` is replaced where it exists.
    """
    body = text_of(text)

    def scored(kind: str, spans: Column) -> Column:
        def score(s: Column) -> Column:
            begin = F.greatest(s["start"] - REACH, F.lit(0))
            before = F.substring(body, begin + 1, s["start"] - begin)
            return let(before, lambda b: F.lit(SCORES[kind])
                       + F.when(F.regexp_like(b, F.lit(CONTEXT[kind])), ADDED).otherwise(0.0)
                       - F.when(F.regexp_like(b, F.lit(AGAINST)), TAKEN).otherwise(0.0))

        rank = list(SCORES).index(kind)
        return of_kind(spans, kind, rank, score)

    accounts = F.filter(spans_of(body, IBAN), lambda s: mod97(s["hit"]))
    numbers = spans_of(body, NUMBER)
    base = base_spans(body)
    likely = F.filter(F.concat(scored("iban", accounts), scored("number", numbers)), lambda s: s["score"] >= LEAST)
    return documents.withColumn(found, let(base, lambda b: F.concat(
        *[scored(k, b[k]) for k in BASE_KINDS], likely)))


def mask_pii(documents: DataFrame, text: str = "text") -> DataFrame:
    """The same columns with each span replaced by its kind in brackets; ``n_chars`` follows where it exists.

    Of overlapping spans the one that starts first is replaced, the longer of
    those that start together; a later one that starts inside it goes with it,
    and what it covers beyond is cut as well. Null texts stay null.
    """
    held = "__pii_spans"

    def cover(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        put = F.concat(acc["out"], piece, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), put.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    ordered = F.array_sort(F.transform(held, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("less"), s["end"].alias("end"), s["kind"].alias("kind"))))
    masked = let(F.aggregate(ordered, start, cover), lambda a: F.concat(
        a["out"], F.substring(F.col(text), a["at"] + 1, F.char_length(F.col(text)))))
    out = find_pii(documents, text, held)
    out = out.withColumn(text, F.when(F.size(held) > 0, masked).otherwise(F.col(text)))
    if "n_chars" in documents.columns:
        changed = F.when(F.size(held) > 0, F.char_length(text)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


def pii_digest(documents: DataFrame) -> DataFrame:
    """The spans of ``find_pii`` as counts and digests, one row per document."""
    spans = find_pii(documents.select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["rank"] < len(BASE_KINDS))
    return spans.select("doc_id", *counts_of("pii", BASE_KINDS),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("pii")).alias("spans"))
