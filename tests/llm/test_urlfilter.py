from __future__ import annotations

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from catchframe.llm import urlfilter

PAGES = "page_id long, url string, html string"


def urls(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        host = r.choice(["", "www.", "m."]) + r.choice(["news", "shop", "bets", "forum"]) + r.choice([".example.org", ".Example.COM", ".example.net"])
        out.append((i, f"http{r.choice(['', 's'])}://{host}/{r.choice(['en', 'de', 'fr', 'es'])}/{r.randrange(300)}{r.choice(['', '?a=1', '#t', '.html'])}", None))
    return out


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:stop]


def ruled(host, path):
    best = None
    for rule, verdict in urlfilter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


class Model:
    """Interpolated probabilities by recursion over contexts."""

    def __init__(self, texts, order):
        self.order, self.seen = order, {}
        for t in texts:
            for gram in self.grams(t):
                for k in range(order + 1):
                    self.seen.setdefault(gram[order - k:order], {}).setdefault(gram[order], 0)
                    self.seen[gram[order - k:order]][gram[order]] += 1

    def grams(self, t):
        s = urlfilter.START * self.order + t + urlfilter.END
        return [s[i:i + self.order + 1] for i in range(len(t) + 1)]

    def p(self, context, c):
        below = self.p(context[1:], c) if context else 1 / urlfilter.SYMBOLS
        after = self.seen.get(context)
        if not after:
            return below
        return (after.get(c, 0) + len(after) * below) / (sum(after.values()) + len(after))


def brute(rows, order=urlfilter.ORDER):
    known = [(i, u or "", *split(u), *ruled(*split(u)), zlib.crc32((u or "").encode()) % 5) for i, u, _ in rows]
    good, bad = (Model([t for _, t, _, _, _, v, f in known if v == want and f], order) for want in ("allow", "block"))
    scores = []
    for _, t, *_ in known:
        grams = good.grams(t)
        total = sum(round(1e6 * (math.log(good.p(g[:-1], g[-1])) - math.log(bad.p(g[:-1], g[-1])))) for g in grams)
        scores.append(math.floor(math.floor(total / len(grams)) / 1000))
    held = [(s, k[5]) for s, k in zip(scores, known) if k[6] == 0 and k[5]]
    n_good, n_bad = (sum(v == w for _, v in held) for w in ("allow", "block"))
    least = 0
    if n_good and n_bad:
        edges = sorted({s for s, _ in held})
        costs = [
            (sum(v == "allow" and s < e for s, v in held) / n_good + sum(v == "block" and s >= e for s, v in held) / n_bad, abs(e), e)
            for e in [*edges, edges[-1] + 1]
        ]
        least = min(costs)[2]
    return sorted(((k[0], k[2], k[3], k[4], k[5] or ("allow" if s >= least else "block")) for k, s in zip(known, scores)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)


def test_against_brute_force(spark):
    rows = urls(300)
    assert got(urlfilter.judge(spark.createDataFrame(rows, PAGES))) == brute(rows)


def test_held_out_urls(spark):
    """The models alone against the rules, on the fold that they did not learn from."""
    out = urlfilter.judge(spark.createDataFrame(urls(2000), PAGES)).where("fold = 0 AND rule IS NOT NULL")
    assert out.where("model_verdict = verdict").count() > 0.9 * out.count()


def test_odd_rows(spark):
    rows = urls(60) + [
        (None, "https://news.example.org/en/2", None), (61, None, None), (62, "", None), (63, "no scheme", None), (64, "a://", None),
        (65, "http://org?x", None), (66, "http://ORG/é😀/" + "x" * 3000, None), (67, "x://com/fr", None), (67, "x://com/fr", None),
        (68, "http://a.com/fr/\nb#c", None), (69, "http://xorg/", None), (70, "p://q://r.org/a", None),
    ]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("own") for c in ("host", "path", "rule", "row", "gram", "fold", "bin", "found")})
    assert got(urlfilter.judge(df)) == brute(rows)
    assert urlfilter.judge(df.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [[(1, "http://a.net/", None)], [(1, "http://a.org/", None)] * 3])
def test_without_one_of_the_classes(spark, rows):
    """Nothing to learn or to calibrate on: threshold 0, and a URL that tells nothing is allowed."""
    out = urlfilter.judge(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.verdict for r in out} == {"allow"} and {r.threshold for r in out} == {0.0}


def test_no_table_goes_to_the_driver(spark, monkeypatch):
    """A broadcast is built on the driver, and the grams are many times what Spark takes them for."""
    plans, store = [], urlfilter.stored

    def seen(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(urlfilter, "stored", seen)
    rows = urls(300)
    assert got(urlfilter.judge(spark.createDataFrame(rows, PAGES))) == brute(rows)
    assert sum("SortMergeJoin" in p for p in plans) == urlfilter.ORDER + 1
    assert not [p for p in plans if "Broadcast" in p]
