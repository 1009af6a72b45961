import re
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from basketflow.llm.resample import cut_between
from basketflow.llm.url_filter import RULES, calibrated_cut, contexts, url_verdicts

SCHEMA = "page_id long, url string, html string, host int, rule double, ratio string"
ODD = [
    (1, "https://A.Example.ORG/es/1?q=/x#y"),
    (2, "http://example.org/en/12"),
    (3, "http://xexample.org/es/12"),
    (4, "ftp://b.com/fr/"),
    (5, "http://b.com/de/#a://c.org/"),
    (6, "no scheme org/"),
    (7, ""),
    (8, None),
    (9, "://org"),
    (9, "://org"),
    (None, "x://y.net/p?org/"),
    (10, "http://é.example.net/日本#ü"),
    (11, "http://long.net/" + "a/" * 5000),
    (12, "http://org/\nline"),
]


def expected(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


def check(pages):
    urls = [(r.page_id, r.url) for r in pages.collect()]
    found = url_verdicts(pages).collect()
    assert sorted(str((i, *expected(u)[:3])) for i, u in urls) == sorted(str((r.page_id, r.host, r.path, r.rule)) for r in found)
    for r in found:
        said = {v: x for v, x in ((x, v) for v, x in RULES)}.get(r.rule)
        assert r.verdict == said if said else r.verdict in ("allow", "block")
    return found


def test_pages(spark):
    found = check(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet"))
    free = [(r.ratio, r.verdict) for r in found if r.rule is None]
    blocked, allowed = [x for x, v in free if v == "block"], [x for x, v in free if v == "allow"]
    assert blocked and allowed and max(blocked) < min(allowed)
    by_rule = [(r.ratio, r.verdict) for r in found if r.rule]
    good, bad = [x for x, v in by_rule if v == "allow"], [x for x, v in by_rule if v == "block"]
    assert np.mean(good) > np.mean(bad) + 0.2


def test_odd_rows(spark):
    pages = spark.createDataFrame([(i, u, None, 1, 2.0, "r") for i, u in ODD], SCHEMA)
    assert len(check(pages)) == len(ODD)
    assert url_verdicts(pages.limit(0)).collect() == []
    assert {r.verdict for r in url_verdicts(pages, rules=[]).collect()} == {"allow"}


@pytest.mark.parametrize("url", ["abcab", "a", "é/é"])
def test_contexts_are_equal_where_the_bytes_are(url):
    data = url.encode()
    context, joined = contexts(url, 3, 40)
    for k in range(4):
        before = [(b"\0" * 3 + data)[3 + i - k : 3 + i] for i in range(len(data))]
        for i in range(len(data)):
            for j in range(len(data)):
                assert (context[k][i] == context[k][j]) == (before[i] == before[j])
                assert (joined[k][i] == joined[k][j]) == ((before[i], data[i]) == (before[j], data[j]))


def test_held_out_urls_are_told_apart(spark):
    rows = [(i, f"http://h{i % 40}.org/news/{i * 7919 % 1000}", None, 1, 2.0, "r") for i in range(600)] + [(1000 + i, f"http://h{i % 40}.com/de/casino-{i * 7919 % 1000}", None, 1, 2.0, "r") for i in range(600)]
    free = [(5000 + i, f"http://h{i}.net/{p}/{i}", None, 1, 2.0, "r") for i in range(40) for p in ("news", "de/casino-1")]
    found = url_verdicts(spark.createDataFrame(rows + free, SCHEMA)).filter("page_id >= 5000").collect()
    assert all((r.verdict == "block") == ("casino" in r.path) for r in found)


def test_counts_are_exact(spark):
    pick = Random(4)
    rows = [(i, f"http://h.{'org' if i % 2 else 'com/de'}/{pick.getrandbits(320):080x}", None, 1, 2.0, "r") for i in range(800)]
    pages = spark.createDataFrame(rows, SCHEMA)
    taught = pages.filter(F.pmod(F.xxhash64("url", F.lit("held")), F.lit(10)) != 0).collect()
    counts, totals, follows = Counter(), Counter(), defaultdict(set)
    for r in taught:
        data, good = b"\0" * 5 + r.url.encode(), expected(r.url)[3] == "allow"
        for i in range(5, len(data)):
            for k in range(6):
                context = (good, data[i - k : i])
                counts[context, data[i]] += 1
                totals[context] += 1
                follows[context].add(data[i])

    def ratio(url):
        data, logs = b"\0" * 5 + url.encode(), []
        for good in (False, True):
            ps = []
            for i in range(5, len(data)):
                p = 1 / 256
                for k in range(6):
                    context = (good, data[i - k : i])
                    if totals[context]:
                        seen = len(follows[context])
                        p = (counts[context, data[i]] + seen * p) / (totals[context] + seen)
                ps.append(p)
            logs.append(np.log(ps).mean())
        return logs[1] - logs[0]

    urls = {r[0]: r[1] for r in rows}
    assert all(abs(r.ratio - ratio(urls[r.page_id])) < 1e-6 for r in url_verdicts(pages).collect())


def test_hot_grams_change_nothing(spark, monkeypatch):
    from basketflow.llm import url_filter

    pages = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet")
    plain = {r.page_id: (r.ratio, r.verdict) for r in url_verdicts(pages).collect()}
    monkeypatch.setattr(url_filter, "HOT", 20)
    assert {r.page_id: (r.ratio, r.verdict) for r in url_verdicts(pages).collect()} == plain


@pytest.mark.parametrize("loss", [0.0, 0.01, 0.3])
def test_cut_by_brute_force(spark, loss):
    pick = Random(5)
    for digits in (1, 6):
        rows = [(int(good), round(pick.gauss(0.5 if good else -0.5, 1), digits)) for good in (pick.random() < 0.7 for _ in range(3000))]
        good, bad = (sorted(x for g, x in rows if g == kind) for kind in (1, 0))
        found = calibrated_cut(spark.createDataFrame(rows, "good int, ratio double").repartition(3), loss)
        assert found == min(cut_between(good, bad), good[int(loss * len(good))])
    assert calibrated_cut(spark.createDataFrame([(1, 0.5)], "good int, ratio double"), loss) == 0.0


def test_all_held_out_rows_make_the_cut(spark):
    """A held-out URL that comes more often than 20,000 times leaves the others their say."""
    pick, n = Random(6), 3000
    hosts = [("org", 1)] * n + [("com/de", 0)] * n + [("net", None)] * 400
    urls = [(f"http://h{i % 9}.{host}/{pick.choice(['news', 'casino'])}/{pick.getrandbits(24):x}", good) for i, (host, good) in enumerate(hosts)]
    strong = [(f"http://news.org/{'org/' * 9}{i}", 2) for i in range(500)]
    hashed = spark.createDataFrame(urls + strong, "url string, good int").withColumn("h", F.xxhash64("url", F.lit("held"))).withColumn("held", F.pmod("h", F.lit(10)) == 0).collect()
    hot = min((r for r in hashed if r.good == 2 and r.held), key=lambda r: r.h)
    kept = [r for r in hashed if r.good != 2 and not (r.good == 1 and r.held and r.h < hot.h)]
    held = {i: r.good for i, r in enumerate(kept) if r.held and r.good is not None} | {-1: 1}
    rows = spark.createDataFrame([(i, r.url) for i, r in enumerate(kept)], "page_id long, url string")
    more = spark.range(20_100).select(F.lit(-1).cast("long").alias("page_id"), F.lit(hot.url).alias("url"))
    found = url_verdicts(rows.unionByName(more)).collect()
    good, bad = (sorted(r.ratio for r in found if held.get(r.page_id) == kind) for kind in (1, 0))
    cut = min(cut_between(good, bad), good[int(0.01 * len(good))])
    free = [r for r in found if r.rule is None]
    assert all((r.verdict == "allow") == (r.ratio >= cut) for r in free) and any(cut <= r.ratio < (max(bad) + good[-1]) / 2 for r in free)
