"""Operators over whole tables: shards, search, classes and classifiers; the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eclusa.llm import gru, neardup, quality, sharding, topk, toxicity
from eclusa.llm import words as W
from eclusa.llm.frames import held_out
from eclusa.llm.queries import QUERIES
from tests.llm.fixtures import TEXTS, clashing, documents, empty, rows

SF = "/root/testdata/sf0.01"


# --- sharding ---


def test_op6(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op6_shard"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    places, sizes, homes = collections.defaultdict(list), collections.Counter(), {}
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "bytes")
        places[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        assert homes.setdefault(r.virtual_slot, r.shard) == r.shard
    assert set(places) == set(range(40))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sizes.values()) < 1.02 * min(sizes.values())


def test_shards_of_odd_rows(spark):
    dealt, the_map = sharding.shard(documents(spark), 3, slots=16)
    assert dealt.count() == len(TEXTS)
    grown = sharding.grown_map(the_map, 3)
    old = {r.virtual_slot: r.shard for r in the_map.collect()}
    moved = {r.virtual_slot: r.shard for r in grown.collect() if r.shard != old[r.virtual_slot]}
    assert set(moved.values()) <= {3} and grown.first().version == 2
    assert sharding.shard(clashing(spark), 40)[0].count() == len(TEXTS)
    assert sharding.shard(empty(spark), 40)[0].count() == 0


# --- search ---


def plain_topk(vectors, queries, k):
    out = []
    for q, v in queries:
        same = [(-int(np.dot(v, w)), i) for i, w in vectors if i != q and len(w) == len(v)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(same)[:k], 1)]
    return sorted(out)


def test_search_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    r = np.random.default_rng(5)
    vectors = [(i, r.integers(-90, 90, 8).tolist()) for i in range(400)]
    # Many copies of one vector, and ties between different ones.
    vectors += [(1000 + i, [5, -5] * 4) for i in range(60)] + [(2000, [0] * 8), (2020, [0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<long>")
    found = topk.search(df, df.filter("vec_id % 20 = 0"), 20)
    queries = [v for v in vectors if v[0] % 20 == 0]
    assert sorted(tuple(r) for r in found.collect()) == plain_topk(vectors, queries, 20)


@pytest.mark.parametrize("most", [3 * 10**6, 10**9, 2**62])
def test_scores_of_great_components_are_exact(spark, most):
    r = np.random.default_rng(6)
    vectors = [(i, [int(x) for x in r.integers(-most, most, 8)]) for i in range(200)]
    # Scores that differ by less than a double can tell.
    vectors += [(1000 + i, [most - 1] * 7 + [most - 1 - i]) for i in range(30)]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<long>")
    found = sorted(tuple(r) for r in topk.search(df, df.filter("vec_id % 20 = 0"), 20).collect())
    expected = []
    for q, v in vectors:
        if q % 20 == 0:
            whole = [(sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q]
            cut = sorted((-max(min(s, 2**63 - 1), -(2**63)), i) for s, i in whole)
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(cut[:20], 1)]
    if most < 2**62:
        assert found == sorted(expected)
    else:  # ties of scores that are cut go by id among those that were read
        assert [(a, b, d) for a, b, _, d in found] == [(a, b, d) for a, b, _, d in sorted(expected)]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [(20, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [0.5, -0.01]),
            (5, [0.5, -0.01]), (6, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").filter(topk.usable(F.col("embedding")))
    vectors = df.select("vec_id", topk.integers(F.col("embedding")).alias("vector"))
    found = topk.search(vectors, vectors.filter("vec_id % 20 = 0"), 20)
    assert [tuple(r) for r in found.collect()] == [(20, 1, 5, 64 * 32 + 128 * -1)]
    none = vectors.filter("false")
    assert topk.search(none, none, 20).count() == 0


def test_op7(spark):
    kept = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = [(r.vec_id, np.floor(np.array(r.embedding, dtype=float) * 64).astype(int)) for r in kept]
    queries = [v for v in vectors if v[0] % 20 == 0]
    found = sorted(tuple(r) for r in QUERIES["op7_topk"](spark, SF).collect())
    assert found == plain_topk(vectors, queries, 20)


# --- near-duplicates ---


def plain_classes(docs):
    """Smallest id of each row's class, by comparing all pairs."""
    texts = sorted({t or "" for _, t in docs})
    raw, offsets = toxicity.joined(texts)
    grams, home, _ = neardup.elements(W.scan(raw, offsets))
    sets = [set(grams[home == k].tolist()) for k in range(len(texts))]
    at = list(range(len(texts)))

    def root(k):
        while at[k] != k:
            k = at[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                at[root(a)] = root(b)
    least = {}
    for i, t in docs:
        k = root(texts.index(t or ""))
        least[k] = min([x for x in (least.get(k), i) if x is not None], default=None)
    return [(i, least[root(texts.index(t or ""))]) for i, t in docs]


def near_copies():
    r = np.random.default_rng(9)
    words = [f"w{i}" for i in range(3000)]
    docs = list(TEXTS)
    for group in range(12):
        base = r.choice(words, 120).tolist()
        for copy in range(40 if group == 0 else 5):
            own = list(base)
            for _ in range(r.integers(0, 8)):
                own[r.integers(0, len(own))] = str(r.choice(words))
            docs.append((1000 + group * 100 + copy, " ".join(own)))
    return docs


def test_classes_by_brute_force(spark):
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = [(r.doc_id, r.class_id) for r in neardup.members(df).collect()]
    assert sorted(found, key=repr) == sorted(plain_classes(docs), key=repr)


def test_one_document_of_each_class_stays(spark):
    docs = near_copies()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, bands int")
    kept = neardup.deduplicated(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted({c for _, c in plain_classes(docs)}, key=repr)
    assert neardup.deduplicated(empty(spark)).count() == 0
    assert neardup.members(empty(spark)).count() == 0


def test_each_level_deals_two_ways_by_bands_not_yet_used(spark):
    own = [(n, [100 * n + b for b in range(neardup.BANDS)]) for n in range(3)]
    sketches = spark.createDataFrame(own, "node long, bands array<long>")
    dealt = spark.createDataFrame([(n, 7, [4]) for n in range(3)], "node long, key long, used array<int>")
    for level in range(1, neardup.LEVELS):
        dealt = neardup._finer(dealt, sketches)
        found = dealt.collect()
        assert len(found) == 3 * 2**level
        assert all(len(set(r.used)) == level + 1 and r.used[0] == 4 for r in found)
    last = spark.createDataFrame(
        [(0, 7, [b for b in range(neardup.BANDS) if b not in (5, 9)])], "node long, key long, used array<int>"
    )
    assert {r.used[-1] for r in neardup._finer(last, sketches).collect()} == {5, 9}


def test_no_link_of_a_bucket_that_never_splits_is_lost(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    r = np.random.default_rng(4)
    own = [np.unique(r.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(40)]
    own[21], own[33] = np.sort(np.append(own[20][:55], own[21][:3])), np.sort(np.append(own[7][:50], own[33][:20]))
    sets = spark.createDataFrame(
        [(n, x.tobytes()) for n, x in enumerate(own)], "node long, shingles binary"
    )
    bands = list(range(neardup.BANDS))
    sketches = spark.createDataFrame([(n, bands) for n in range(40)], "node long, bands array<long>")
    met = spark.createDataFrame([(n, 3, [3]) for n in range(40)], "node long, key long, used array<int>")
    found = {r.node: r["class"] for r in neardup._classes(sketches, sets, met).collect()}
    assert found == {20: 20, 21: 20}


def test_common_shingles_of_a_block(monkeypatch):
    monkeypatch.setattr(neardup, "COUNTED", 7)
    r = np.random.default_rng(6)
    own = [np.unique(r.integers(0, 90, k).astype(np.uint64)) for k in (50, 3, 80, 20, 60)]
    found = neardup.shared_counts(own[:2], own[1:], np.array([0, 1, 1, 2, 3, 4]))
    for a in range(2):
        for b in range(4):
            if a != b + 1:
                assert found[a, b] == len(np.intersect1d(own[a], own[b + 1]))


def test_steps_that_no_bucket_needs_are_left_out(spark, monkeypatch):
    """Each of their stages would cost the driver memory; there are no large buckets here."""

    def needless(*_):
        raise AssertionError("planned without need")

    monkeypatch.setattr(neardup, "_block_links", needless)
    monkeypatch.setattr(neardup, "_stars", needless)
    words = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, "a b c d e f g"), (4, None)]
    found = neardup.members(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(found.collect()) == [(1, 1, 2), (2, 1, 2), (3, 3, 1), (4, 4, 1)]


@pytest.mark.parametrize("small, block", [(16, 512), (4, 8)])
def test_classes_of_a_skewed_table(spark, monkeypatch, small, block):
    """A family of near copies, a passage in a third of all texts, copies: as by all pairs."""
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    r = np.random.default_rng(12)
    word = lambda n: " ".join(f"w{i}" for i in r.integers(0, 4000, n))
    base, passage = word(120).split(), word(60)
    texts = []
    for _ in range(220):  # each some way from the family's base, so that not all pairs are links
        own = list(base)
        for at in r.integers(0, 120, int(r.integers(0, 5))):
            own[at] = f"x{int(r.integers(0, 10**6))}"
        texts.append(" ".join(own))
    texts += [f"{word(int(r.integers(10, 50)))} {passage}" for _ in range(200)]
    texts += [word(80) for _ in range(60)] + [texts[0]] * 100 + ["", None, "one two"] * 5
    docs = [(int(i), t) for i, t in zip(r.permutation(len(texts)), texts, strict=True)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = neardup.members(df).select("doc_id", "class_id")
    assert sorted(map(tuple, found.collect())) == sorted(plain_classes(docs))


def test_copies_that_repeat_a_passage_are_found(spark):
    docs = []
    for k in range(30):
        own = [f"t{k}x{i}" for i in range(112)]
        line = " ".join(own[:16])
        docs.append((2 * k, " ".join(own)))
        # One line is repeated; the set of shingles grows by the four that span its end.
        docs.append((2 * k + 1, " ".join([line] * 256 + own[16:])))
    found = neardup.members(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == sorted(plain_classes(docs))
    assert all(r.class_id == r.doc_id - r.doc_id % 2 and r.n_texts == 2 for r in found)


def test_a_text_without_repeats_has_one_sketch(spark):
    docs = [(0, "a b c d e f g"), (1, "a b c d e " * 5), (2, ""), (3, "one")]
    made, name = neardup.with_bands(spark.createDataFrame(docs, "doc_id long, text string"))
    n = {r.doc_id: len(r[name]) for r in made.collect()}
    assert n == {0: neardup.BANDS, 1: 2 * neardup.BANDS, 2: 0, 3: neardup.BANDS}


def test_registers_estimate_the_similarity():
    r = np.random.default_rng(2)
    a = r.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 2**63, 100).astype(np.uint64)])
    grams = np.concatenate([a, b])
    texts = np.repeat([0, 1], 400)
    same = []
    for salt in range(20):
        x = neardup.sketch(W.mix(grams + np.uint64(salt)), texts, np.ones(800), 2)
        same.append((x[0] == x[1]).mean())
    assert abs(np.mean(same) - 300 / 500) < 0.03


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 60).selectExpr("id as a", "id - 1 as b").union(spark.sql("select 100L, 101L"))
    found = {r.node: r["class"] for r in neardup.components(links).collect()}
    assert found == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100}


def test_components_collect_nothing_and_stop_at_stars(spark, monkeypatch):
    """Broadcasts and rounds that change nothing would cost the driver memory."""
    plans, was = [], neardup.staged

    def staged(df, label):
        plans.append(df)
        return was(df, label)

    def plan(df):
        df.foreach(lambda _: None)
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(neardup, "staged", staged)
    monkeypatch.setattr(neardup, "discard", lambda *_: None)
    stars = spark.createDataFrame([(5, 1), (1, 7), (5, 1), (9, 8), (4, 4)], "a long, b long")
    found = sorted(map(tuple, neardup.components(stars).collect()))
    assert found == [(1, 1), (5, 1), (7, 1), (8, 8), (9, 8)] and len(plans) == 1
    chain = spark.createDataFrame([(1, 2), (2, 3), (4, 3), (6, 5)], "a long, b long")
    found = sorted(map(tuple, neardup.components(chain).collect()))
    assert found == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5)] and len(plans) > 2
    assert not any("Broadcast" in plan(df) for df in plans[2:])


def test_what_finer_buckets_leave_is_asked_for_only_if_some_were_dealt(spark, monkeypatch):
    """The first text and the last one of a crowded bucket link all others, so nothing is left."""
    labels, was = [], neardup.staged
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "staged", lambda df, label: labels.append(label) or was(df, label))
    own = np.sort(np.random.default_rng(8).integers(0, 2**63, 60).astype(np.uint64))
    sets = spark.createDataFrame([(n, own.tobytes()) for n in range(40)], "node long, shingles binary")
    bands = list(range(neardup.BANDS))
    sketches = spark.createDataFrame([(n, bands) for n in range(40)], "node long, bands array<long>")
    met = spark.createDataFrame([(n, 3, [3]) for n in range(40)], "node long, key long, used array<int>")
    found = {r.node: r["class"] for r in neardup._classes(sketches, sets, met).collect()}
    assert found == dict.fromkeys(range(40), 0)
    assert "dup-left" not in labels and labels.count("dup-links") == 1


def test_op4(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = QUERIES["op4_near_duplicates"](spark, "/root/testdata/sf0.001").select("doc_id", "class_id")
    assert rows(found) == sorted(plain_classes(docs), key=repr)


# --- classifiers ---


def area(scores, y):
    """Chance that a positive row has the greater score."""
    a, b = scores[y == 1][:, None], scores[y == 0]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_quality_learns_from_whole_texts(spark):
    docs = [(2, "good words " * 3000 + "an end of its own 123 !!!"), (1, "short"), (3, None)]
    found = quality.inputs(spark.createDataFrame(docs, "doc_id long, text string"), 3)
    raw = [t.encode() for t in ("short", docs[0][1], "")]
    whole = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.allclose(found, whole)
    assert quality.inputs(empty(spark), 3).shape == (0, whole.shape[1])


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.75), ("op3_quality", "quality", 0.95)])
def test_held_out_rows(spark, name, label, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = QUERIES[name](spark, SF).collect()
    assert len(found) == 1000 and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    own = [r for r in found if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in own])
    assert area(np.array([r.score for r in own]), y) > least


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    net = gru.Net.fresh(np.zeros(0, dtype=np.uint64))
    x, y, weight = r.normal(size=(5, 4, gru.WORD + gru.CHARS)), np.array([1, 0, 1, 0.0]), np.array([1, 2, 1, 1.0])
    mask = np.arange(5)[:, None] < np.array([5, 3, 2, 1])
    _, grads, _ = gru.gradients(net, x, mask, y, weight)
    for name, slope in grads.items():
        at = tuple(r.integers(0, n) for n in slope.shape)
        value, loss = net.p[name][at], []
        for step in (1e-5, -1e-5):
            net.p[name][at] = value + step
            loss.append(gru.gradients(net, x, mask, y, weight)[0])
        net.p[name][at] = value
        assert abs((loss[0] - loss[1]) / 2e-5 - slope[at]) < 1e-6


def some_words(seed, sizes, kinds=400):
    r = np.random.default_rng(seed)
    texts = [" ".join(f"w{k}" for k in r.integers(0, kinds, n)) for n in sizes]
    return W.scan(*toxicity.joined(texts))


def test_scorer_equals_the_forward_pass_of_training():
    r = np.random.default_rng(2)
    words = some_words(1, [0, 1, 5, 31, 32, 33, 80, 200])
    net = gru.Net.fresh(gru.vocabulary(words))
    net.p["word"] += r.normal(0, 0.5, net.p["word"].shape)
    text, begin, logits = gru.Scorer(net).windows(words)
    x = net.inputs(words.hash, words.lowered, words.start, words.end)
    best = np.full(8, -np.inf)
    for t, b, logit in zip(text, begin, logits, strict=True):
        # One window at a time, in double precision.
        n = min(gru.WINDOW, words.first[t + 1] - b)
        one, mask = x[b : b + n, None, :], np.ones((n, 1), dtype=bool)
        states = np.concatenate([gru._forward(net, side, one, mask)[0] for side in "fb"], axis=2)[:, 0]
        weight = np.exp(states @ net.p["look"])
        plain = (weight * (states @ net.p["out"])).sum() / weight.sum() + net.p["bias"][0]
        assert abs(plain - logit) < 1e-4
        loss, _, _ = gru.gradients(net, one, mask, np.array([1.0]), np.array([1.0]))
        assert abs(np.logaddexp(0, plain) - plain - loss) < 1e-9
        best[t] = max(best[t], plain)
    top, has = gru.greatest(net, words)
    assert has.tolist() == [False] + [True] * 7 and np.allclose(top[1:], best[1:], atol=1e-4)


def test_training_texts_are_scored_in_parts(monkeypatch):
    """The inputs of all words at once were the most that a training task held."""
    r = np.random.default_rng(5)
    texts = ["", *(" ".join(f"w{i}" for i in r.integers(0, 300, n)) for n in (0, 1, 40, 900, 3, 200, 33)), ""]
    words = W.scan(*toxicity.joined(texts))
    net = gru.Net.fresh(gru.vocabulary(words))
    net.p["word"] += r.normal(0, 0.5, net.p["word"].shape)
    whole, sizes, windows = gru.greatest(net, words), [], gru.Scorer.windows
    monkeypatch.setattr(gru, "SCORED", 64)
    monkeypatch.setattr(gru.Scorer, "windows", lambda self, part: sizes.append(len(part.hash)) or windows(self, part))
    top, has = gru.greatest(net, words)
    assert np.allclose(top, whole[0], atol=1e-5) and (has == whole[1]).all() and has.sum() == 6
    assert sum(sizes) == len(words.hash) and len(sizes) >= 4 and max(sizes) == 900
    empty = W.scan(*toxicity.joined([]))
    assert len(gru.greatest(net, empty)[0]) == 0 and len(gru.vocabulary(empty)) == 0


def test_near_copies_share_a_fold():
    r = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 5000, 400)) for _ in range(200)]
    copies = [t + " and an end" for t in texts]
    fold = gru.folds_of(W.scan(*toxicity.joined(texts + copies + ["", "one two", "one two"])), 4)
    assert (fold[:200] == fold[200:400]).mean() > 0.95 and fold[-1] == fold[-2]
    assert set(fold) == {0, 1, 2, 3}


def test_a_large_sample_beats_its_best_word(spark):
    """The network is told no word; it ranks held-out texts better than any list of words."""
    sf = SF.replace("sf0.01", "sf0.1")
    documents, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    texts, y = toxicity.labelled(documents, labels, "toxic")
    net = toxicity.trained(spark, texts, y)
    own = labels.filter(held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).join(documents, "doc_id")
    got = own.select("text", "toxic").toArrow()
    held = W.scan(*toxicity.joined([t or "" for t in got["text"].to_pylist()]))
    mark = np.array(got["toxic"].to_pylist())
    words = W.scan(*toxicity.joined(texts))

    # Each word's excess of positive texts in standard deviations; a text has its greatest.
    both = np.unique(np.stack([words.text.astype(np.uint64), words.hash], axis=1), axis=0)
    unique, row = np.unique(both[:, 1], return_inverse=True)
    n, share = np.bincount(row), y.mean()
    z = (np.bincount(row, weights=y[both[:, 0].astype(int)]) - n * share) / np.sqrt(n * share * (1 - share) + 1)
    at = np.minimum(np.searchsorted(unique, held.hash), len(unique) - 1)
    best = np.zeros(len(mark))
    np.maximum.at(best, held.text, np.where(unique[at] == held.hash, z[at], 0))

    score = gru.Scorer(net).texts(held)
    assert area(score, mark) > max(area(best, mark), 0.96)
    # Chances mean what they say.
    assert abs(score.mean() - mark.mean()) < 0.04


def test_windows_overlap_and_cover_every_word():
    n = np.array([0, 1, 31, 32, 33, 48, 49, 100])
    text, first = gru.window_starts(n)
    for k, size in enumerate(n):
        covered = {w for s in first[text == k] for w in range(s, min(s + gru.WINDOW, size))}
        assert covered == set(range(size))


def test_scores_of_odd_rows(spark):
    df = clashing(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    for found, name in (
        toxicity.scored(df, toxicity.fit(df, labels)),
        quality.scored(df, quality.fit(df, labels)),
    ):
        assert name == "score_" and found.columns == [*df.columns, "score_"]
        assert all(0 <= r[name] <= 1 for r in found.collect()) and found.count() == len(TEXTS)
    nothing = labels.limit(0)
    assert toxicity.scored(empty(spark), toxicity.fit(empty(spark), nothing))[0].count() == 0
    assert quality.scored(empty(spark), quality.fit(empty(spark), nothing))[0].count() == 0


def test_class_prior():
    r = np.random.default_rng(4)
    positives = r.normal(2, 1, 4000)
    unlabelled = np.concatenate([r.normal(2, 1, 3500), r.normal(-2, 1, 1500)])
    assert abs(quality.class_prior(positives, unlabelled) - 0.7) < 0.05


# --- pipeline ---


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.staged(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        assert kept.columns == columns and 0 < kept.count() <= docs.count()
        assert kept.filter("n_chars <> char_length(text)").count() == 0
        docs = kept
    assert {c for _, c in plain_classes([(r.doc_id, r.text) for r in docs.collect()])} == {
        r.doc_id for r in docs.collect()
    }
    last = corpus_pipeline.encode(spark, docs, "")
    assert last.count() == docs.count() and last.filter("not intact").count() == 0


def test_stages_take_odd_rows(spark, monkeypatch, tmp_path):
    more = [(i, t, "en", "s", len(t or "")) for i, t in TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, given in enumerate((more, [])):
        docs = spark.createDataFrame(given, schema)
        folder = tmp_path / str(k)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, str(folder))
        assert found.count() == len({c for _, c in plain_classes(TEXTS)}) * bool(given)
