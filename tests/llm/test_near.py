import random

import numpy as np
from pyspark.sql import functions as F
from riskloom.llm import near, simhash

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def words_of(rng, n):
    return ["".join(rng.choices(LETTERS, k=6)) for _ in range(n)]


def similarity(a, b):
    def sets(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    x, y = sets(a), sets(b)
    return len(x & y) / len(x | y)


def test_wide_words_are_majorities_and_start_with_the_plain_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 3, 5, 40, 700):
        text = " ".join(words_of(rng, n)).encode()
        made = near.wide_fingerprint(text)
        assert len(made) == near.WORDS and int(made[0]) == simhash.fingerprint(text, 5)
        hashes = simhash.shingle_hashes(text, 5)
        mixed = near._mixed(np.array(hashes, np.uint64)).astype(np.uint64)
        for w in (0, 1, near.WORDS - 1):
            ones = [sum(int(h) >> bit & 1 for h in mixed[:, w]) for bit in range(64)]
            assert int(made[w]) == sum(1 << bit for bit in range(64) if ones[bit] * 2 > len(hashes))


def test_near_copies_of_a_word_or_more_are_joined_and_others_stay(spark):
    rng = random.Random(2)
    rows, pairs = [], []
    for i in range(300):
        first = words_of(rng, 100)
        second = list(first)
        for at in rng.sample(range(100), 1 + i % 3):
            second[at] = "changed"
        rows += [(2 * i, " ".join(first)), (2 * i + 1, " ".join(second))]
        pairs.append(similarity(rows[-2][1], rows[-1][1]))
    # half shared: no near copies
    for i in range(300):
        rows.append((1000 + i, " ".join(rows[2 * i][1].split()[:50] + words_of(rng, 50))))
    kept = {r.doc_id for r in near.keep_first(frame(spark, rows)).collect()}
    assert all(2 * i in kept for i in range(300)) and all(1000 + i in kept for i in range(300))
    alike = [i for i, s in enumerate(pairs) if s >= 0.83]
    assert len(alike) > 100
    assert np.mean([2 * i + 1 not in kept for i in alike]) >= 0.9


def test_large_groups_go_through_pivots(spark):
    rng = random.Random(3)
    base = words_of(rng, 200)
    rows = []
    for i in range(400):
        text = list(base)
        text[rng.randrange(200)] = f"x{i}"
        rows.append((i + 5, " ".join(text)))
    rows += [(1000 + i, " ".join(words_of(rng, 200))) for i in range(50)]
    kept = sorted(r.doc_id for r in near.keep_first(frame(spark, rows)).collect())
    assert kept == [5] + [1000 + i for i in range(50)]


def test_links_of_large_buckets_are_those_within_the_distance(spark):
    # one bucket for all: every chain is equal, but only some rows are within the distance
    rng = random.Random(4)
    form = near.Shape(bits=8, chains=1, distance=40, first=64)
    rows = []
    for group in range(3):
        middle = [0] + [rng.getrandbits(62) for _ in range(near.WORDS - 1)]
        rows += [[(group << 40 | i << 20)] + middle[1:] for i in range(70)]
    nodes = spark.createDataFrame([(r[0], r) for r in rows], "fp long, wide array<bigint>")
    found = near.links(nodes, form).collect()
    assert all(r.a >> 40 == r.b >> 40 for r in found)
    whole = simhash.components(spark.createDataFrame([(r.a, r.b) for r in found], "a long, b long")).collect()
    assert len({r.node for r in whole}) == 210 and {r.root for r in whole} == {g << 40 for g in range(3)}


def test_awkward_rows(spark):
    long = " ".join(words_of(random.Random(5), 30_000))
    rows = [(None, None), (None, ""), (1, "a b"), (1, "other words here"), (7, long), (3, long + " end"), (None, "alone stands this text"), (9, " A  B ")]
    kept = near.keep_first(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept) == sorted([(0, ""), (1, "a b"), (1, "other"), (3, long[:5]), (0, "alone")])
    clash = frame(spark, [(1, "a"), (2, "a")]).selectExpr("doc_id", "text", "1 as __place", "2 as fp", "3 as wide", "4 as root")
    out = near.keep_first(clash)
    assert out.columns == clash.columns and [r.doc_id for r in out.collect()] == [1]
    assert near.keep_first(frame(spark, [])).count() == 0


def test_no_pair_at_the_threshold_is_left_out(spark):
    # 96 shingles, and 24 or 25 more: similarity 0.8, or just below
    rng = random.Random(6)
    rows, alike = [], []
    for i in range(200):
        text = words_of(rng, 100)
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text + words_of(rng, 24 + i % 2)))]
        alike.append(similarity(rows[-2][1], rows[-1][1]) >= 0.8)
    assert alike == [i % 2 == 0 for i in range(200)]
    kept = {r.doc_id for r in near.keep_first(frame(spark, rows)).collect()}
    assert {2 * i for i in range(200)} <= kept and not any(2 * i + 1 in kept for i in range(200) if alike[i])


def test_all_pairs_leave_nothing_more_to_drop(spark):
    # few words, so that shingles are frequent, sets small, and prefixes alike
    rng = random.Random(7)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(0, 40))) for _ in range(250)]
    for i in range(150):
        words = texts[i].split()
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice("abc"))
        texts.append(" ".join(words))
    sets = [frozenset(simhash.shingle_hashes(t.encode(), 5)) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if 9 * len(x & sets[j]) >= 4 * (len(x) + len(sets[j])):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    kept = sorted(r.doc_id for r in near.keep_first(frame(spark, list(enumerate(texts)))).collect())
    assert set(kept) <= {i for i in range(len(texts)) if top(i) == i}


def _generated(df):
    """Rows that each Generate of a collected frame made."""
    found = []

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        if kind == "GenerateExec":
            found.append(plan.metrics().get("numOutputRows").get().value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_stray_set_meets_only_members_with_room_for_it(spark):
    # one component of 60 sets and 40 strays have shingle 7; in most of the component it stands so late that no stray may link
    large = [(i, 0, 100, [1000 + 100 * i + j for j in range(15)] + [7]) for i in range(58)]
    early = [(58 + i, 0, 100, [7]) for i in range(2)]
    strays = [(100 + i, None, 100, [7, 90_000 + i]) for i in range(40)]
    nodes = spark.createDataFrame([*large, *early, *strays], "node long, root long, size long, prefix array<long>")
    pairs = near.left_over(nodes, 0.8)
    found = {tuple(r) for r in pairs.collect()}
    stray = {(100 + i, 100 + j) for i in range(40) for j in range(i + 1, 40)}
    assert found == stray | {(58 + i, 100 + j) for i in range(2) for j in range(40)}
    assert max(_generated(pairs)) <= len(found)


def test_parities_tell_large_sets_apart(spark):
    texts = [" ".join(f"{w}{i}" for i in range(4000)) for w in "ab"]
    near_b = texts[1].replace("b100 ", "c ")
    rows = [(i, t, np.unique(np.array(near.shingle_hashes(t.encode(), 5, 42), np.uint64))) for i, t in enumerate([*texts, near_b, " ".join(texts[1].split()[:3300])])]
    nodes = spark.createDataFrame(
        [(i, len(s), near._parity(s).view(np.int64).tolist()) for i, _, s in rows], "node long, size long, parity array<long>"
    )
    assert {len(near._parity(s)) for *_, s in rows} == {64}
    pairs = nodes.select(F.col("node").alias("a"), "parity").crossJoin(nodes.select(F.col("node").alias("b"), F.col("parity").alias("other"))).where("a < b")
    told = pairs.withColumn("d", near._differing_parities("parity", "other")).collect()
    sets = {i: set(s.tolist()) for i, _, s in rows}
    for r in told:
        assert r["d"] <= len(sets[r["a"]] ^ sets[r["b"]])
        # what may link: a ninth of both sizes
        assert (r["d"] * 9 <= len(sets[r["a"]]) + len(sets[r["b"]])) == (0 not in (r["a"], r["b"]))
    # a parity of half the length is the folded one
    short = near._parity(np.array([3, 1024 + 3, 5], np.uint64)).view(np.int64).tolist()
    wide = spark.createDataFrame([(short, short + [0] * 12 + [1] + [0] * 3)], "a array<long>, b array<long>")
    assert wide.select(near._differing_parities("a", "b")).first()[0] == 1
    texts_of = spark.createDataFrame([(i, t) for i, t, _ in rows], "place long, text string")
    linked = near.checked(pairs.select("a", "b"), nodes, texts_of, 0.8)
    assert {tuple(r) for r in linked.collect()} == {(a, b) for a in sets for b in sets if a < b and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))}
