"""The operators against brute force, on awkward rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from riskloom.llm import bpe, chat, counts, exact, graph, importance, lyndon, packing, queries, repeats, simhash, toxicity

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, id int, g string, keep_id string, score double"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, 1, "x", None, 0.5) for i, t in texts], schema)


@pytest.fixture(scope="module")
def awkward():
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ab é\n") for _ in range(rnd.randrange(0, 300))) for _ in range(12)]
    rows = [(i, rnd.choice(base)) for i in range(60)]
    rows += [(60 + i, rnd.choice(base) + str(i) + rnd.choice(base)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, None), (103, " \t\n"), (104, "x" * 70_000), (105, "word " * 9000), (106, "HELLO"), (107, "hello"), (106, "HELLO")]
    rnd.shuffle(rows)
    return rows


def test_exact(spark, awkward):
    for keep, best in (("largest", max), ("smallest", min)):
        norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups = {}
        for i, t in awkward:
            groups.setdefault(norm(t), []).append(i)
        got = exact.groups(frame(spark, awkward), keep=keep).collect()
        want = sorted((i, best(groups[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in awkward)
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sorted(r.doc_id for r in got if r.kept) == sorted(best(v) for v in groups.values())
        left = exact.dedup(frame(spark, awkward), keep=keep)
        assert left.columns == frame(spark, awkward).columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(best(v) for v in groups.values())


def test_exact_hot_group_and_null_ids(spark):
    rows = [(i, "same") for i in range(400)] + [(None, "same"), (None, "only"), (None, None)]
    got = exact.groups(frame(spark, rows), keep="largest").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(399, 401), (None, 1)}
    assert sum(r.kept for r in got) == 3
    assert exact.groups(frame(spark, [])).count() == 0 and exact.dedup(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact.groups(frame(spark, rows), keep="first")


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (50, 8), (40, 39)])
def test_bpe(spark, awkward, chunk, overlap):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [r for r in awkward if len(r[1] or "") < 5000 or chunk > 100] + [(200, "I'm  héllo   \n\n 12 <|endoftext|> 日本語 " * 30), (None, "z")]
    want = sorted(
        (str(i), len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in rows for e in [coder.encode_ordinary(t or "")]
    )
    got = bpe.digests(frame(spark, rows), RANKS, P.PATTERN, keep=["doc_id"], chunk=chunk, overlap=overlap).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    coded = bpe.encode(frame(spark, rows[:20]), RANKS, P.PATTERN, chunk=chunk, overlap=overlap)
    for r in bpe.decode(coded, RANKS, P.PATTERN).collect():
        assert bytes(r["bytes"]).decode() == (r.text or "")
    assert bpe.encode(frame(spark, []), RANKS, P.PATTERN).count() == 0


def test_bpe_where_neighbouring_chunks_agree_on_a_wrong_boundary(spark):
    # digits in threes: chunks of 30 agree with each other, but not with what comes before the run
    pattern = r"\p{N}{1,3}| ?\p{L}+|\s+|."
    rows = [(0, "a" + "7" * 200 + " b" * 40), (1, "ab" + "12345" * 50)]
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.ids for r in bpe.encode(frame(spark, rows), RANKS, pattern, chunk=30, overlap=9).collect()}
    assert got == {i: coder.encode_ordinary(t) for i, t in rows}


def _components(values):
    values = sorted(values)
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def _fingerprint(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, awkward):
    want = {(i, _fingerprint(t)) for i, t in awkward}
    root = _components({f for _, f in want})
    least = {}
    for i, f in want:
        least[root[f]] = min(least.get(root[f], i), i)
    got = simhash.near_duplicates(frame(spark, awkward)).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{_fingerprint(t):016x}", least[root[_fingerprint(t)]]) for i, t in awkward)
    kept = simhash.keep_first(frame(spark, awkward))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert simhash.near_duplicates(frame(spark, [])).count() == 0 and simhash.keep_first(frame(spark, [])).count() == 0


def test_near_copies_are_told_apart_by_row_not_by_id(spark):
    rnd = random.Random(8)
    plain = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(12)]
    rows = [(None, t) for t in plain[:4]]  # unrelated texts without an id
    rows += [(5, t) for t in plain[4:7]]  # unrelated texts of one id
    rows += [(3, plain[7]), (5, plain[7].upper())]  # id 5 again, in the component of id 3
    rows += [(None, plain[8]), (9, plain[8].title()), (None, plain[9].upper()), (None, plain[9])]
    rows += [(5, plain[10]), (5, plain[10].upper()), (None, plain[10].title()), (5, plain[10]), (None, None), (None, "")]
    root = _components({_fingerprint(t) for _, t in rows})
    parts = {}
    for i, t in rows:
        parts.setdefault(root[_fingerprint(t)], []).append((i is None, i or 0, t or "", (i, t)))
    assert len(parts) == 12
    want = [min(p, key=lambda x: (*x[:3], x[3][1] is not None))[3] for p in parts.values()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    got = simhash.keep_first(frame(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("small", [64, 3])
def test_links_connect_alike_in_small_and_large_buckets(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rnd = random.Random(small)
    centre = rnd.getrandbits(64)
    values = {centre} | {rnd.getrandbits(64) for _ in range(50)}
    for _ in range(250):
        v = centre
        for _ in range(rnd.randrange(1, 5)):
            v ^= 1 << rnd.randrange(64)
        values.add(v)
    nodes = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}

    def classes(of):
        out = {}
        for v in values:
            out.setdefault(of(v), set()).add(v)
        return {frozenset(s) for s in out.values()}

    want = _components(values)
    assert classes(lambda v: want[v]) == classes(lambda v: root.get(simhash._signed(v), simhash._signed(v)))


def test_packing(spark, awkward):
    rows = awkward + [(300, "hello <|endoftext|> world <|startoftext|>"), (301, "<|endoftext|><|ENDOFTEXT|> <| endoftext|>")]
    rows += [(None, "<|endoftext|> İstanbul ΣΑΣ a\x1cb c\x85d ﬁ 日本 ẛ̣ don't 12")]
    got = packing.pack(frame(spark, rows), WORDS).toPandas()
    coder = tokenizers.Tokenizer.from_file(WORDS)
    want = []
    for i, t in rows:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.append((str(float(i)) if i is not None else "nan", k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(zip(got.doc_id.astype(float).astype(str), got.piece, got.start, got.length, got.ids_crc32)) == sorted(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.values == np.concatenate([[0], np.cumsum(s.length.values)[:-1]])).all() and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy alone: 6 + 2, then 4 + 4 + ...; the two for the smallest fill the bin
    plan = packing.plan_bins({6: 1, 2: 0, 3: 1, 1: 2}, 10)
    assert plan.bins == 2
    plan = packing.plan_bins({7: 1, 5: 2}, 10)
    assert plan.bins == 2
    assert packing._fill(np.array([0, 0, 0, 0, 2, 0, 1, 0, 0, 0, 0])[:11], 8) == {4: 2}
    counts_ = {n: 50 + n % 7 for n in range(1, 60)}
    plan = packing.plan_bins(counts_, 64)
    assert plan.bins <= 1.02 * sum(n * c for n, c in counts_.items()) / 64 + 1


def _covered(rows):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen[b[k : k + 50]] = min(seen.get(b[k : k + 50], i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        yield i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("many", [64, 2])
def test_repeats(spark, awkward, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    rows = [r for r in awkward if len(r[1] or "") < 50_000]
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(_covered(rows))
    out = repeats.without_repeats(frame(spark, rows).withColumn("n_chars", F.length("text").cast("long")))
    kept = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.text is not None)
    assert len(kept) == sum(t is not None for _, t in rows) and all(len(t) == n for _, t, n in kept)
    clash = frame(spark, rows).selectExpr("*", "1 as sha", "2 as `first`", "3 as kept", "4 as __sha", "5 as `row`", "6 as __id", "7 as __n", "8 as __place")
    for made in (repeats.without_repeats(clash), simhash.keep_first(clash), exact.dedup(clash)):
        assert made.columns == clash.columns and made.select("sha", "kept", "__n").distinct().collect() == [(1, 3, 7)]
    assert repeats.without_repeats(clash).count() == len(rows)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(TypeError):
        repeats.remove_repeats(frame(spark, rows), key="g")


def test_suffix_order():
    rng = np.random.default_rng(5)
    for _ in range(80):
        texts = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(0, 25))).astype(np.uint8)) for _ in range(int(rng.integers(1, 12)))]
        problem = np.sort(rng.integers(0, 4, len(texts)))
        order, _, begins = lyndon.suffix_order(texts, problem)
        at = {int(b) + i: (int(p), t[i:]) for t, b, p in zip(texts, begins, problem) for i in range(len(t))}
        got = [at[int(x)] for x in order if int(x) in at]
        assert got == sorted(at.values())


def test_toxicity(spark):
    rnd = random.Random(1)
    plain = ["".join(rnd.choice(["ka", "to", "mi", "ra", "su"]) for _ in range(rnd.randrange(2, 5))) for _ in range(300)]
    bad = ["grumblefoo", "snarkwit", "vilebarg"]
    rows = []
    for i in range(400):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(20, 60))]
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad).title())
        rows.append((i, " ".join(words)))
    docs = frame(spark, rows + [(None, "ka"), (1000, None), (1001, "")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    got = toxicity.score(docs, model, keep=["doc_id"]).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95
    empty = [r.score for r in got if r.doc_id in (1000, 1001)]
    assert empty[0] == empty[1]
    again = toxicity.fit(docs.unionByName(docs).unionByName(docs), labels.where(~toxicity.held_out()))
    assert again.toxic == model.toxic and np.array_equal(again.weights, model.weights)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_held_out_toxicity_accuracy(spark, sf):
    docs = "/root/testdata/sf0.01"
    made = queries.QUERIES["op1_toxicity"](spark, docs)
    known = made.join(spark.read.parquet(f"{docs}/labels.parquet"), "doc_id").where("held_out")
    right = known.selectExpr("avg(cast(predicted = toxic as int))").first()[0]
    assert right > 0.9


def test_importance(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["good", "plain", "text"] if i % 2 else ["!!", "ZZZ", "||"]) for _ in range(30))) for i in range(200)]
    docs = frame(spark, rows + [(None, None), (500, "")])
    good = spark.createDataFrame([(i,) for i in range(1, 100, 2)], "doc_id long")
    got = importance.resample(docs, good, 0.5).collect()
    assert len(got) == 202 and sum(r.selected for r in got) == 101
    chosen = [r.doc_id for r in got if r.selected and r.doc_id is not None and r.doc_id < 200]
    assert np.mean([i % 2 for i in chosen]) > 0.95
    assert sorted(map(str, got)) == sorted(map(str, importance.resample(docs, good, 0.5).collect()))
    assert importance.resample(frame(spark, []), good, 0.5).count() == 0
    lowest = min(r.draw for r in got if r.selected)
    assert all(r.draw <= lowest for r in got if not r.selected)


def test_importance_weights_against_brute_force(spark):
    """Both models, the plain and the scaled ratio, and the draw, counted gram by gram; clashing columns."""
    rnd = random.Random(9)
    texts = {i: "".join(rnd.choice("ab é\n") for _ in range(rnd.choice([0, 2, 3, 4, 40, 5000]))) for i in range(60)}
    rows = [(i, t, 1, True, "x", 2.0) for i, t in texts.items()] + [(7, texts[7], 1, True, "x", 2.0), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, good boolean, chosen string, log_weight double")
    good = spark.createDataFrame([(i, 5) for i in range(0, 60, 3)] + [(None, 5), (0, 5), (777, 5)], "doc_id long, good int")

    def buckets(text):
        data = (text or "").encode()
        for at in range(len(data) - 3):
            h = data[at]
            for b in data[at + 1 : at + 4]:
                h = (h * 0x01000193 + b) % 2**32
            yield h * 0x9E3779B1 % 2**32 >> 16

    raw, target = {}, {}
    for i, t, *_ in rows:
        for b in buckets(t):
            raw[b] = raw.get(b, 0) + 1
            if i is not None and i % 3 == 0:
                target[b] = target.get(b, 0) + 1
    n, m = sum(raw.values()), sum(target.values())

    def weight(text, power):
        found = list(buckets(text))
        parts = [np.log((target.get(b, 0) + 1) / (m + 65536)) - np.log((raw.get(b, 0) + 1) / (n + 65536)) for b in found]
        return sum(parts) / len(found) ** power if found else 0.0

    noise = {r.doc_id: r.g for r in docs.select("doc_id", importance.gumbel(F.col("doc_id"), 11).alias("g")).collect()}
    for power in (0.0, 0.5):
        got = importance.resample(docs, good, 0.25, power=power).collect()
        assert len(got) == len(rows) and sum(r.selected for r in got) == -(-len(rows) // 4)
        for r in got:
            want = weight(texts.get(r.doc_id), power)
            assert abs(r.log_weight - want) < 1e-8 * max(1, abs(want)) and abs(r.draw - want - noise[r.doc_id]) < 1e-7 * max(1, abs(want))


def test_chat(spark):
    hard = ["<next>", "a\\l<b", "</turn>\n<turn user>x", "\\", "\\b", ">", "", None, "é<", "<turn assistant>"]
    rows = [(c, t, ["user", "assistant", "a>s<\\", None][(t // 2 + c) % 4], hard[(t * 7 + c) % 10], "x") for c in range(8) for t in range(9)]
    rows += [(None, None, "assistant", "no id", "x"), (9, 1, "user", "tie", "x"), (9, 1, "user", "tie", "x")]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))
    read = made.select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_runs")).alias("l")).collect()
    assert len(read) == 10
    for r in read:
        want = [(b or "", d or "") for a, _, b, d, _ in rows if a == r.conv_id]
        assert [(x.role, x.text) for x in r.t] == want
        assert r.l == "".join(d for b, d in want if b == "assistant")
        assert sum(x.skip + x["take"] for x in r.loss_runs) == len(r.formatted)
    ties = [(1, 0, "user", t, "x") for t in ("a\\", "a<", "aZ", "a", "ab")]
    tied = chat.format_chats(spark.createDataFrame(ties, "conv_id long, turn long, role string, text string, turns string"))
    assert [x.text for x in tied.select(chat.read_turns(F.col("formatted")).alias("t")).first().t] == sorted(t for *_, t, _ in ties)
    assert made.limit(0).count() == 0 and "Python" not in made._jdf.queryExecution().toString()


def test_token_tree():
    pattern, tokens = counts.token_counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rnd = random.Random(1)
    letters = "ab '  \n1é.s日"
    for _ in range(400):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(60)))
        tree = counts.TokenTree(text, pattern, tokens)
        for _ in range(5):
            start, length, insert = rnd.randrange(len(text) + 2), rnd.randrange(6), "".join(rnd.choice(letters) for _ in range(rnd.randrange(6)))
            tree.edit(start, length, insert)
            start = min(start, len(text))
            text = text[:start] + insert + text[start + length :]
            assert tree.text() == text and len(tree) == sum(tokens[x] for x in pattern.findall(text))
    long = counts.TokenTree("some words and more " * 5000, pattern, tokens)
    long.edit(50_000, 3, "new")
    assert long.encoded < 20


def test_kept_leaves_spare_the_next_run(spark):
    """Two batches of edits, the second on the leaves of the first, against counting from scratch."""
    path = P.path("byte_bpe_50k.tiktoken")
    split, tokens = counts.token_counter(path, P.PATTERN)
    rnd = random.Random(5)
    letters = "ab '  \n1é.s日"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(120)] + ["", None, "same words again " * 3000]
    edit = lambda: (rnd.randrange(90), rnd.randrange(5), "".join(rnd.choice(letters) for _ in range(rnd.randrange(8))))
    rows = [(i, t, [edit() for _ in range(rnd.randrange(4))] or None) for i, t in enumerate(texts)]
    kind = "doc_id long, text string, edits array<struct<start:long,length:long,insert:string>>"
    first = counts.count_tokens(spark.createDataFrame(rows, kind), path, P.PATTERN, "edits", keep_leaves=True).collect()
    assert not any(r.reused for r in first)
    again = [(r.doc_id, r.edited, [edit()], r.leaves) for r in first]
    odd = [(900, "other text", None, first[0].leaves), (901, "a b", None, None), (902, "a b", None, (0, [1], [1, 1])), (903, "a b", [None], (0, [None], [1]))]
    second = spark.createDataFrame(again + odd, f"{kind}, leaves {counts.LEAVES}")
    got = {r.doc_id: r for r in counts.count_tokens(second, path, P.PATTERN, "edits", leaves="leaves", keep_leaves=True).collect()}
    for r in first:
        now = got[r.doc_id]
        assert now.reused and now.n_tokens == r.n_tokens_edited
        assert now.n_tokens_edited == sum(tokens[x] for x in split.findall(now.edited))
        for x in (r, now):
            found = split.findall(x.edited)
            assert list(x.leaves.chars) == [len(w) for w in found] and list(x.leaves.tokens) == [tokens[w] for w in found]
    assert got[len(texts) - 1].n_encoded < 30
    for i, *_ in odd:
        assert not got[i].reused and got[i].n_tokens == sum(tokens[x] for x in split.findall(got[i].edited))


def test_query_counts_equal_the_library(spark, sf):
    """Both counts of every document of the registered query, against the tokenizer itself."""
    whole = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)[0]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op8_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        masked = re.sub(r"\d{3,}", "000", texts[r.doc_id])
        assert r.n_tokens == len(whole.encode_ordinary(texts[r.doc_id]))
        assert r.n_tokens_edited == len(whole.encode_ordinary(masked))


def test_token_counts(spark, awkward):
    path = P.path("byte_bpe_50k.tiktoken")
    pattern, tokens = counts.token_counter(path, P.PATTERN)
    made = counts.count_tokens(counts.masking_edits(frame(spark, awkward), r"\d+", "#"), path, P.PATTERN, "edits").collect()
    assert len(made) == len(awkward)
    for r in made:
        assert r.n_tokens_edited == sum(tokens[x] for x in pattern.findall(r.edited))
    assert counts.count_tokens(frame(spark, []), path, P.PATTERN).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(0)
    vectors = {i: rng.normal(size=8).tolist() for i in range(0, 900)}
    for i in range(300, 620):  # a third of all rows are one vector
        vectors[i] = vectors[300]
    rows = [(i, v) for i, v in vectors.items()]
    odd = [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] * 8), (1150, [None] * 8), (1200, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in graph.nearest(table, shard=200).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ids = np.array(list(vectors))
    x = np.array(list(vectors.values()))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    assert sorted(got) == list(range(0, 900, 50))
    for q, found in got.items():
        cosine = np.round(x @ x[q], 12)
        best = [i for i in ids[np.lexsort((ids, -cosine))] if i != q][:5]
        assert sorted(found) == [1, 2, 3, 4, 5]
        for v, s in found.values():
            assert v != q and abs(s - cosine[v]) < 1e-9
        hits += len(set(best) & {v for v, _ in found.values()})
        total += 5
    assert hits / total >= 0.9
    few = graph.nearest(table.where("vec_id in (0, 1, 2)")).collect()
    assert [(r.query_id, r["rank"]) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1), (0, 2)]
    assert graph.nearest(table.where("vec_id = 1000")).count() == 0
    far = [(0, [1e200, 2e200]), (50, [1e-200, 2e-200]), (51, [2.0, 1.0]), (52, [1.0, 2.0]), (53, [5e-324, 1e-323]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 4.0])]
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 12)) for r in graph.nearest(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()}
    assert [got[0, i] for i in (1, 2, 3, 4)] == [(50, 1.0), (52, 1.0), (53, 1.0), (51, 0.8)] and got[50, 1] == (0, 1.0)
    assert [v for (q, _), (v, _) in got.items() if q == 100] == [101]


def test_reading_merged_turns_is_linear(spark):
    """Twice as many turns of one role in a row take about twice as long, not four times."""
    import time

    def seconds(n):
        rows = [(1, i, "user", f"turn {i} of many words") for i in range(n)]
        made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        cut_ = made.select("formatted").first()["formatted"]
        one = spark.createDataFrame([(cut_,)], "f string").select(F.size(chat.read_turns(F.col("f"))).alias("n"))
        start = time.perf_counter()
        assert one.first()["n"] == n
        return time.perf_counter() - start

    seconds(4000)
    assert seconds(32000) < 8 * max(seconds(8000), 0.25)
