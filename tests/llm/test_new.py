"""Integer k-means, phrase collocations and URL rules against brute force, on awkward rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import centroids, phrases, queries, urls

# --- clusters -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, cluster string, id int, q int"


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    rank = lambda r: (r[0] is not None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    starts = sorted((r for r in kept if r[0] is not None), key=rank) + sorted((r for r in kept if r[0] is None), key=rank)
    cents = [list(v) for _, v in starts[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    last = [(i, *near(v)) for i, v in kept]
    per = Counter()
    for _, d, j in last:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted((str(i), j, fits(d), fits(per[j]), fits(sum(per.values())), sha[j]) for i, d, j in last)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_clusters(spark, scale):
    rnd = random.Random(int(scale))
    rows = [(i, [rnd.gauss(0, scale) for _ in range(4)]) for i in range(80)]
    rows += [(100 + i, [0.5, -0.5, 0.25, 0.0]) for i in range(40)] + [(7, [1.0] * 4), (7, [1.0] * 4), (None, [-scale] * 4)]
    rows += [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 1.0, 1.0]), (204, [float("nan")] * 4), (205, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)
    for k, rounds in ((5, 3), (500, 1)):
        got = centroids.cluster(df, k=k, rounds=rounds, dims=4).collect()
        assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == brute_clusters(rows, k, rounds, 4)


def test_clusters_extremes(spark):
    rows = [(i, [float(i % 3), 0.0], "x", 1, 2) for i in range(30)] + [(99, [3e38, -3e38], "x", 1, 2)]
    got = {r.vec_id: r for r in centroids.cluster(spark.createDataFrame(rows, VECTORS), k=30, rounds=2, dims=2).collect()}
    assert len(got) == 31 and got[99].distance == 0 and got[0].inertia is not None
    empty = centroids.cluster(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(i, [float(i)] * 4, "x", 1, 2) for i in range(10)], VECTORS)
    near = df.select(centroids.quantise(F.col("embedding"), 4, 256).alias("q")).select(centroids.nearest("q", [[1, 2, 3, 4], [0, 0, 0, 0]], "bigint").alias("n"))
    assert "Python" not in near._jdf.queryExecution().executedPlan().toString()


def test_op11_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.QUERIES["op11_centroids"](spark, sf).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == brute_clusters(rows, 40, 5, 64)


# --- phrases --------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, phrase string, words int, n long, a int"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute_phrases(rows, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    over = Counter()
    for (lang, g), a in cand.items():
        if len(g) == 3:
            for part in (g[:2], g[1:]):
                over[lang, part] = max(over[lang, part], a)
    out = {}
    for (lang, g), a in cand.items():
        if over[lang, g] and 100 * over[lang, g] >= share * a:
            continue
        s, _, left, right = min((1000000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        out.setdefault(lang, []).append((-s, -a, " ".join(g).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def frame(spark, rows):
    return spark.createDataFrame([(1, t, g, "x", 0, 0, 0) for t, g in rows], DOCS)


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(5)
    vocabulary = ["a", "B", "é", "the", "of", "new", "york", "\x00", "x_y", "日本", "a\xa0b"]
    weights = [5, 3, 1, 8, 6, 2, 2, 1, 1, 1, 1]
    rows = []
    for i in range(120):
        words = rnd.choices(vocabulary, weights, k=rnd.randrange(0, 120))
        seps = rnd.choices([" ", "  ", "\t", ". ", ",", "\n", "\x0b", "; "], [20, 2, 2, 1, 1, 1, 1, 1], k=len(words))
        rows.append(("".join(w + s for w, s in zip(words, seps)), rnd.choice(["en", "en", "en", "und", None, ""])))
    rows += [(None, "en"), ("", None), (" \t\n", "fr"), ("...", "en"), ("NEW YORK " * 3000, "en"), rows[0], rows[0]]
    return rows


def test_phrases(spark, prose, monkeypatch):
    whole = phrases.collocations(frame(spark, prose)).collect()
    assert sorted(map(tuple, whole)) == brute_phrases(prose)
    few = phrases.collocations(frame(spark, prose), least=3, share=80, top=4).collect()
    assert sorted(map(tuple, few)) == brute_phrases(prose, 3, 80, 4)
    # small blocks and partitions: many windows, merges and losses
    for name, value in (("BLOCK", 50), ("WAITING", 120), ("PART", 500), ("COMBINE", 200)):
        monkeypatch.setattr(phrases, name, value)
    small = phrases.collocations(frame(spark, prose)).collect()
    assert sorted(map(tuple, small)) == brute_phrases(prose)
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(None, None)])).count() == 0


def test_windows_count_each_word_once(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 20)
    for text in (b"x" * 300, b"aa bb " * 100, (b"y" * 70 + b" ") * 5, b"a. " * 40 + b"z" * 50, b" " * 200, b"one " + b"w" * 90 + b" two three"):
        want = text.split()
        got = []
        for piece, seen in phrases._windows(text):
            got += piece.split()[seen:]
        assert got == want


def test_summary_keeps_whatever_is_frequent():
    rnd = np.random.default_rng(2)
    for least in (3, 10):
        keys = np.concatenate([rnd.integers(0, 5000, 20000), rnd.zipf(1.5, 10000)]).astype(np.uint64)
        rnd.shuffle(keys)
        summary = phrases.Summary(len(keys) // least + 1)
        tight = phrases.Summary(len(keys) // least + 1)
        for part in np.array_split(keys, 37):
            summary.merge(part, np.ones(len(part), np.int64))
            other = phrases.Summary(len(keys) // least + 1)
            other.merge(part, np.ones(len(part), np.int64))
            tight.merge(other.keys, other.counts)
        values, counts = np.unique(keys, return_counts=True)
        for s in (summary, tight):
            assert s.lost < least and len(s.keys) <= s.capacity
            assert set(values[counts >= least]) <= set(s.at_least(least))


def test_summary_loses_and_still_keeps():
    keys = np.arange(1000, dtype=np.uint64)
    summary = phrases.Summary(100)
    for _ in range(3):
        summary.merge(keys, np.ones(1000, np.int64))
        summary.merge(np.array([5], np.uint64), np.array([50]))
    assert summary.lost > 0 and 5 in summary.at_least(100) and len(summary.at_least(100)) <= 100


def test_scores_are_exact(spark):
    rows = [(10**15, 10**15, 10**15), (999_999_999_999_999, 10**15, 10**15 - 1), (3, 7, 11)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select(F.expr(phrases.score("a", "l", "r")).alias("s"))
    assert [r.s for r in df.collect()] == [1000000 * a * a // (x * y) for a, x, y in rows]


# --- urls -----------------------------------------------------------------------------------

PAGES = "page_id long, url string, host int, verdict string, key string, best string"


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTPS://A.NET/x?y#z", "http://a.net?q=/", "http://planet/", "http://x.example.net/en/",
    "http://example.net/en", "http://example.net/EN/", "http://example.com/de/1", "http://org/fr/x", "http://a.b.org/fr/", "http://a.b.org/fr", "x://net./",
    "http://user@net:80/", "a?b://c.net/d", "http://.net/", "http://é.net/日本#", "http://net//", "http://" + "a." * 5000 + "net/" + "p" * 20000,
]


def test_urls(spark):
    rnd = random.Random(9)
    rows = URLS + ["http://" + ".".join(rnd.choices(["a", "net", "org", "example", "com"], k=rnd.randrange(1, 5))) + rnd.choice(["", "/", "/en/", "/fr/", "/de/x", "/e"]) for _ in range(400)]
    df = spark.createDataFrame([(i if i != 3 else None, u, 1, "x", "k", "b") for i, u in enumerate(rows)], PAGES)
    many = [(v, ".".join(h), p) for v, h, p in itertools.product(["block", "allow"], [("a",), ("net",), ("a", "net"), ("org", "com"), ("example", "a", "org")], ["", "/", "/e", "/de/"])]
    many = [r for r in many if (len(r[1]) + len(r[2])) % 2 == (r[0] == "block")]
    for rules in (queries.URL_RULES, many, []):
        made = urls.judge(df, rules)
        assert made.columns == ["page_id", "url", "key", "best", "host", "path", "rule", "verdict"]
        assert sorted(map(str, ((r.url, r.host, r.path, r.rule, r.verdict) for r in made.collect()))) == sorted(map(str, ((u, *brute_rule(u, rules)) for u in rows)))
    assert urls.judge(spark.createDataFrame([], PAGES), queries.URL_RULES).count() == 0
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_urls_in_parts(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_RULES", 3)
    df = spark.createDataFrame([(i, u, 1, "x", "k", "b") for i, u in enumerate(URLS)], PAGES)
    rules = [*queries.URL_RULES, ("block", "b.org", "/"), ("allow", "a.net", ""), ("allow", "net", "/"), ("block", "É.NET", "")]
    known = [r for r in rules[:-1] if r != ("allow", "net", "/")]
    got = urls.judge(df, rules).collect()
    assert sorted(map(str, ((r.url, r.rule, r.verdict) for r in got))) == sorted(str((u, *brute_rule(u, known)[2:])) for u in URLS)
    for wrong in (("maybe", "a", "/"), ("block", "", "/"), ("block", "a/b", "/"), ("block", "a", "b")):
        with pytest.raises(ValueError):
            urls.judge(df, [wrong])


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(30000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where(F.xxhash64("key") % 23 == 0)
    cascade = urls.build(listed, universe.unionByName(universe))
    assert len(cascade.levels) >= 3
    assert universe.where(cascade.contains(F.col("key")) != (F.xxhash64("key") % 23 == 0)).count() == 0
    # a list costs some bits a key, not the universe
    assert cascade.bits < 16 * listed.count()
    assert not urls.build(listed.limit(0), universe).levels
