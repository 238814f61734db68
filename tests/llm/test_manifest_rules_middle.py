"""Merkle manifest, quality rules and fill-in-the-middle against plain versions."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eclusa.llm import fim, merkle, rules
from eclusa.llm.queries import ORACLE, QUERIES
from tests.llm.fixtures import TEXTS, clashing, documents, empty, rows

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Merkle manifest ---


def plain_manifest(docs):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row."""

    def h(*values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(digests):
        paths, level = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
        while len(level) > 1:
            runs = [level[i : i + 8] for i in range(0, len(level), 8)]
            for run in runs:
                for k, (_, below) in enumerate(run):
                    for i in below:
                        paths[i].append(([d for d, _ in run[:k]], [d for d, _ in run[k + 1 :]]))
            level = [(sha("".join(d for d, _ in r)), [i for _, below in r for i in below]) for r in runs]
        return level[0][0], paths

    def first(x):
        return (x is not None, x)

    langs = collections.defaultdict(list)
    for i, source, lang, n, text in docs:
        lower = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        used = lower if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else text
        langs[lang].append((i, h(i, source, lang, n, text), h(i, source, lang, n, used)))
    order = sorted(langs, key=first)
    for rows_ in langs.values():
        rows_.sort(key=lambda r: (first(r[0]), r[1]))
    trees = [tree([r[1] for r in langs[lang]]) for lang in order]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for lang, (subroot, paths), top in zip(order, trees, tops, strict=True):
        for (i, leaf, used), path in zip(langs[lang], paths, strict=True):
            at = used
            for left, right in path + top:
                at = sha("".join([*left, at, *right]))
            proof = sha("".join(d for left, right in path + top for d in left + right))
            out.append((i, leaf, subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, docs):
    return rows(merkle.checked(spark.createDataFrame(docs, SCHEMA)))


def test_op11(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*SCHEMA.replace(",", "").split()[::2])
    found = rows(QUERIES["op11_merkle_manifest"](spark, SF))
    assert found == plain_manifest([tuple(r) for r in docs.collect()])
    assert {r[-1] for r in found} == {True, False}


def test_op11_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    found = QUERIES["op11_merkle_manifest"](spark, SF)
    con.execute(ORACLE["op11_merkle_manifest"])
    assert found.columns == [d[0] for d in con.description]
    assert rows(found) == sorted(con.fetchall(), key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 600])
def test_one_group_of_any_size(spark, n):
    docs = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    assert manifest(spark, docs) == plain_manifest(docs)


def test_groups_of_uneven_sizes(spark):
    docs = [(i, None, lang, None, "A") for k, lang in enumerate([None, "", "b", "z", "é", "😀"]) for i in range(3**k)]
    docs += [(i, "s", f"l{i:02}", 1, "X") for i in range(20)]
    assert manifest(spark, docs) == plain_manifest(docs)


def test_ancestors_that_are_not_broadcast(spark):
    docs = [(i, "s", "en" if i % 3 else "de", 1, f"T{i}") for i in range(700)]
    leaves = merkle.document_leaves(spark.createDataFrame(docs, SCHEMA))

    def of(**settings):
        found = merkle.proofs(leaves, "lang", "doc_id", "leaf", **settings)
        return rows(found.select("row.doc_id", F.sha2(merkle.siblings(F.col("path")).cast("binary"), 256)))

    assert of(broadcast_bytes=0) == of() == sorted(((r[0], r[4]) for r in plain_manifest(docs)), key=repr)


def test_manifest_of_odd_rows(spark):
    docs = [(i, "s", "en", 3, t) for i, t in TEXTS] + [(None, None, None, None, None)] * 30
    assert manifest(spark, docs) == plain_manifest(docs)
    assert manifest(spark, []) == []
    extra = clashing(spark).selectExpr("*", "'en' as lang", "'s' as source", "3 as n_chars", "map(1, 2) as row", "1 as path")
    assert rows(merkle.checked(extra)) == plain_manifest([(i, "s", "en", 3, t) for i, t in TEXTS])


# --- quality rules ---


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = list(zip(words, words[1:], words[2:], strict=False))
    times = collections.Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if times[r] > 1 for j in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_op12(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = QUERIES["op12_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        assert tuple(r)[1:7] == plain_measures(texts[r.doc_id])
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1
    # Labels are no input; they show that the verdict is worth something.
    judged = [r for r in found if not r.base_failed and r.doc_id in labels]
    agree = [r.kept == bool(labels[r.doc_id]) for r in judged]
    assert np.mean(agree) > 0.95 and {r.kept for r in judged} == {True, False}


WORDS = st.lists(st.sampled_from(["a", "b", "ab", "é", "x.", "\n", " ", "a b c"]), max_size=60)


def test_measures_of_many_small_texts(spark):
    texts = []

    @settings(max_examples=300, database=None)
    @given(WORDS, st.sampled_from([" ", "\n", "\t", "\x0b "]))
    def collect(words, between):
        texts.append(between.join(words))

    collect()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = rules.scan(df).select("doc_id", *(f"measures.{m}" for m in base), "base_failed")
    assert rows(found) == sorted(((i, *plain_measures(t)) for i, t in enumerate(texts)), key=repr)


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    text = " ".join(f"w{i % 40}" for i in range(90))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for bits in (4, 60):  # every run a candidate for want of room; hashes of four bits
        monkeypatch.setattr(rules, "PLACE_BITS", bits)
        assert rules.scan(df).first()["measures"]["n_repeat_words"] == plain_measures(text)[4]


def test_accuracies_by_plain_expectation_maximisation():
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.7
    # Two telling rules, one that says nothing, one that only ever votes against.
    told = [np.where(rng.random(4000) < p, np.where(good, 1, -1), np.where(good, -1, 1)) for p in (0.95, 0.9)]
    noise = rng.choice([-1, 0, 1], 4000)
    fault = np.where(~good & (rng.random(4000) < 0.6), -1, 0)
    votes = np.stack([*told, noise, fault], axis=1)
    counts = {k: float(v) for k, v in collections.Counter(map(tuple, votes.tolist())).items()}
    model = rules.accuracies(counts, 4)

    z = model.bias + sum(np.vectorize(w.get)(votes[:, j]) for j, w in enumerate(model.weights))
    assert np.mean((z > 0) == good) > 0.95
    assert abs(1 / (1 + np.exp(-model.bias)) - 0.7) < 0.05
    assert model.weights[0][1] > model.weights[1][1] > 1
    assert abs(model.weights[2][1]) < 0.3 and model.weights[3][-1] < -2
    assert all(w[1] >= 0 >= w[-1] for w in model.weights)


def test_rules_of_odd_rows(spark):
    found = rows(rules.scan(documents(spark)).select("doc_id", "measures.n_words", "base_failed", "kept"))
    measures = [(i, plain_measures(t)) for i, t in TEXTS]
    assert [r[:3] for r in found] == sorted(((i, m[0], m[5]) for i, m in measures), key=repr)
    assert not any(r[2] and r[3] for r in found)
    assert rules.scan(clashing(spark)).count() == len(TEXTS)
    assert rules.scan(empty(spark)).count() == 0


# --- fill in the middle ---


def plain_middle(i, text, rate=100, spm=50, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text)
    n = len(units)
    hexes = sha(f"7:{'' if i is None else i}")
    h = [int(hexes[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return i, n, "plain", None, None, text
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if h[3] % 100 < spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return i, n, "spm" if h[3] % 100 < spm else "psm", len(prefix), len(middle), out


COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_op13(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = [(*(r := plain_middle(i, t))[:5], sha(r[5]), sha(t or "")) for i, t in map(tuple, docs)]
    assert rows(QUERIES["op13_fill_in_middle"](spark, SF)) == sorted(expected, key=repr)


PIECES = st.lists(st.sampled_from(["\n", "a", "é😀", "<", "<P", "S>", "<M>", ". ", "\r\n", "x\n"]), max_size=30)


def test_middles_of_many_small_texts(spark):
    texts = ["\n", "\n\n", "a", "a\n", "\na", "<", "<S", "P>"]

    @settings(max_examples=300, database=None)
    @given(PIECES)
    def collect(pieces):
        texts.append("".join(pieces))

    collect()
    docs = list(enumerate(texts))
    made = fim.transformed(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(made.select(COLUMNS)) == sorted((plain_middle(i, t) for i, t in docs), key=repr)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, back.collect())) == docs
    some = fim.transformed(spark.createDataFrame(docs, "doc_id long, text string"), rate=40, spm_rate=0, unit="sentence")
    unit = r"[^\n.!?]*[\n.!?]|[^\n.!?]+"
    assert rows(some.select(COLUMNS)) == sorted((plain_middle(i, t, 40, 0, unit) for i, t in docs), key=repr)


@settings(max_examples=100, database=None)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks_and_selects(classes):
    matrix = fim.WaveletMatrix(np.array(classes, dtype=np.uint8))
    places = np.arange(len(classes) + 1)
    for c in range(8):
        counts = np.concatenate([[0], np.cumsum(np.array(classes) == c)]).astype(int)
        assert matrix.rank(c, places).tolist() == counts.tolist()
    both = np.concatenate([[0], np.cumsum(np.isin(classes, (1, 6)))]).astype(int)
    k = np.arange(both[-1] + 1)
    assert matrix.select((1, 6), k).tolist() == [int(np.argmax(both >= x)) for x in k]


def test_middles_of_odd_rows(spark):
    made = fim.transformed(documents(spark))
    assert rows(made.select(COLUMNS)) == sorted((plain_middle(i, t) for i, t in TEXTS), key=repr)
    taken = spark.createDataFrame([(1, "a\nb", 5, "f", "o", 1)], "doc_id long, text string, N int, form string, output string, h1 int")
    assert fim.transformed(taken).columns == [*taken.columns, "n_", "form_", "prefix_chars", "middle_chars", "output_"]
    assert fim.transformed(clashing(spark)).count() == len(TEXTS)
    assert fim.transformed(empty(spark)).count() == 0
