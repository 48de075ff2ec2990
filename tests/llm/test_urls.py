import random
import re

import pytest

from millrace.llm import urls

RULES = [("net", "/", "net/", "block"), ("example.net", "/en/", "example.net/en/", "allow"),
         ("example.com", "/de/", "example.com/de/", "block"), ("org", "/fr/", "org/fr/", "allow")]


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [name for h, p, name, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = ["http://a.net", "http://a.net/", "https://X.Example.NET/en/1?q=/de/", "http://example.net/en", "http://notexample.com/de/x",
        "http://example.com/de/x#y", "ftp://www.example.com/de", "http://a.org/fr/1", "http://org/fr/", "a.net/x", None, "",
        "http://", "x://y://z.net/a", "http://b.net?x=/", "http://é.org/fr/ü", "HTTP://A.ORG/FR/", "http://u@example.com:80/de/"]


def pages_of(spark, urls_):
    rows = [(i, u, "<p>", 1.5) for i, u in enumerate(urls_)] + [(None, urls_[0], None, None), (0, urls_[0], None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, confidence double")


def test_fixed_rules(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = urls.judge_urls(pages_of(spark, URLS), labels).collect()
    assert len(rows) == len(URLS) + 2
    verdicts = {name: v for *_, name, v in RULES}
    for r in rows:
        if r["page_id"] is not None:
            host, path, rule = plain(URLS[r["page_id"]])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert r["verdict"] == verdicts.get(rule, "allow")
    assert urls.judge_urls(pages_of(spark, URLS).limit(0), labels).collect() == []


def labelled(spark, seed):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(1200):
        words = [rng.choice(["casino", "news", "blog"]), rng.choice(["free", "daily", "old"]), f"n{rng.randint(0, 3)}"]
        bad = {"casino", "free"} <= set(words) and rng.random() < 0.95 or rng.random() < 0.03
        rows.append((i, f"https://{words[0]}.example.com/{words[1]}/{words[2]}/{i}"))
        marks.append((i, int(not bad), int(bad and rng.random() < 0.5)))
    return (spark.createDataFrame(rows, "page_id long, url string"),
            spark.createDataFrame(marks + [marks[0], (None, 0, 1), (10**6, None, None)], "doc_id long, quality int, toxic int"),
            rows, marks)


@pytest.mark.parametrize("seed", range(2))
def test_mined_rules(spark, seed):
    """Rules against counts over all pages; verdicts against all rules."""
    pages, labels, rows, marks = labelled(spark, seed)
    rules = urls.mine(pages, labels, least_support=0.02).collect()
    tokens = {i: {f"h:{w}" for w in re.findall("[a-z]+", u.split("/")[2])} | {f"p:{w}" for w in u.split("/")[3:5]} for i, u in rows}
    bad = {i for i, q, t in marks if q == 0 or t == 1}
    assert ["h:casino", "p:free"] in [r["tokens"] for r in rules]
    for r in rules:
        fit = {i for i, x in tokens.items() if set(r["tokens"]) <= x}
        assert r["confidence"] == pytest.approx(len(fit & bad) / len(fit)) and r["confidence"] >= urls.LEAST_CONFIDENCE
        assert r["support"] == pytest.approx(len(fit & bad) / len(rows))
        assert not any(set(o["tokens"]) < set(r["tokens"]) and o["confidence"] >= r["confidence"] for o in rules)
    got = urls.judge_urls(pages, labels, least_support=0.02).collect()
    assert len(got) == len(rows)
    for r in got:
        fits = [x for x in rules if set(x["tokens"]) <= tokens[r["page_id"]]]
        assert (r["verdict"], r["mined"] is not None) == (("block", True) if fits else ("allow", False))
        if fits:
            assert r["confidence"] == max(x["confidence"] for x in fits)
