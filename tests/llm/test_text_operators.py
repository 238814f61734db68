"""Operators over single texts against the plainest way to the same result."""

import collections
import hashlib
import re
import time

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from eclusa.llm import bpe, counts, decontaminate, licences, pii
from eclusa.llm.queries import ORACLE, QUERIES
from tests.llm.fixtures import TEXTS, clashing, documents, empty, rows

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# --- byte-level BPE ---


@pytest.mark.parametrize("chunk, overlap", [(100, 20), (1000, 64), (bpe.CHUNK, bpe.OVERLAP)])
def test_bpe_equals_the_library_and_comes_back(spark, encoding, chunk, overlap):
    df = bpe.encode(documents(spark), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    found = [(r.doc_id, list(r.ids), bytes(r.decoded)) for r in bpe.decode(df, RANKS).collect()]
    expected = [(i, encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in TEXTS]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_bpe_keeps_clashing_columns_and_empty_tables(spark):
    df = bpe.encode(clashing(spark), RANKS, public_tokenizers.PATTERN)
    assert df.columns == ["doc_id", "score", "ids", "bands", "spans", "n_words", "key", "ids_"]
    assert bpe.decode(df, RANKS, "ids_").count() == len(TEXTS)
    assert bpe.encode(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_every_character(encoding):
    coder = bpe.Coder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(signs), 5000):
        for joint in (" ", "", "a"):
            text = joint.join(signs[at : at + 5000])
            packed = np.array(encoding.encode_ordinary(text), dtype=np.int32).tobytes()
            assert coder.encode(text) == packed


def test_long_merges_equal_short_ones():
    ranks = bpe.load_ranks(RANKS)
    r = np.random.default_rng(1)
    for n in (2, 5, 30, 64):
        piece = bytes(r.choice(list(b"thesnd"), n).tolist())
        if piece not in ranks:
            assert bpe._merge_long(piece, ranks) == bpe.merge(piece, ranks)


def test_op2(spark, encoding, texts):
    found = QUERIES["op2_byte_bpe"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        raw = hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest, raw)


# --- token counts ---


def test_counts_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    signs = [" ", " ", "\n", "\t", "▁", "a", "b", "the", "é", "😀", "\r", "<s>", "<0x0A>", "\x00", "  "]
    r = np.random.default_rng(3)
    mixed = [(100 + i, "".join(r.choice(signs, r.integers(0, 30)))) for i in range(500)]
    df = spark.createDataFrame(TEXTS + mixed, "doc_id long, text string")
    expected = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in TEXTS + mixed]
    assert rows(counts.count(df, MODEL)) == sorted(expected, key=repr)


def test_counts_of_clashing_columns_and_empty_tables(spark):
    assert counts.count(clashing(spark), MODEL).count() == len(TEXTS)
    assert counts.count(empty(spark), MODEL).count() == 0


def test_op8(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in QUERIES["op8_token_counts"](spark, SF).collect():
        n = len(model.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)


# --- decontamination ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_hits(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(10, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows[tuple(words[i : i + n])].add("null" if item is None else str(item))
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for j in range(len(words) - n + 1):
                if having := windows.get(tuple(words[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= having
        yield doc, len(words), len(hit), sorted(found), bool(hit)


ITEMS = [(1, "ONE two"), (2, None), (3, ""), (4, "cat sat on the mat and then it ran off to the OLD"),
         (4, "it ran off to the old red barn by the hill"), (None, "word word word word word word word word word word word")]


@pytest.mark.parametrize("slice_text", [1, 60, 10**6])
def test_hits_by_brute_force(spark, slice_text):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found, names = decontaminate.scan(documents(spark), items, slice_text=slice_text)
    found = found.select("doc_id", names[0], decontaminate.n_hit(F.col(names[1])), names[3])
    expected = [x[:4] for x in plain_hits(TEXTS, ITEMS)]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("slice_text", [20_000, 10**8])
def test_items_of_several_pieces_are_hit_across_their_edges(spark, slice_text):
    edge = decontaminate.PIECE
    words = [f"w{i}" for i in range(2 * edge + 50)]
    items = [(1, " ".join(words)), (2, " ".join(words[edge - 4 : edge + 30])), (3, "Same " * (edge + 20))]
    docs = [(k, "; ".join(words[k : k + 12])) for k in range(edge - 12, edge + 3)]
    docs += [(-1, " ".join(words[2 * edge + 30 :])), (-2, "same " * 30), (-3, "w1 w3 " * 9)]
    found, names = decontaminate.scan(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        slice_text=slice_text,
    )
    found = found.select("doc_id", names[0], decontaminate.n_hit(F.col(names[1])), names[3])
    expected = [x[:4] for x in plain_hits(docs, items)]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_op5(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = [
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c)
        for d, n, h, i, c in plain_hits(texts.items(), items)
    ]
    assert rows(QUERIES["op5_decontaminate"](spark, SF)) == sorted(expected, key=repr)
    assert any(x[5] for x in expected)


def test_cleaned_texts_have_no_hits_left(spark):
    items = spark.createDataFrame(ITEMS[3:5], "item_id long, text string")
    df = spark.createDataFrame(
        [(1, "Ünd before. CAT sat on the mat, and then it ran off to the old... after it all we went home and slept there", 7)],
        "doc_id long, text string, n_words int",
    )
    (row,) = decontaminate.cleaned(df, items, most=0.9).collect()
    assert row.text == "Ünd before. ... after it all we went home and slept there"
    assert decontaminate.cleaned(df, items, most=0.1).count() == 0
    assert decontaminate.cleaned(clashing(spark), items.limit(0)).count() == len(TEXTS)
    assert decontaminate.report(empty(spark), items).count() == 0


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def plain_spans(text):
    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {
            "email": lambda: True,
            "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 8 <= len(digits) <= 15,
        }[kind]()

    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


ODD = ["a@b.c_d@e.f x@y.z.%d@e.fg", "é́ 1.2.3.4.5.6.7.8 +1 (555) 222-3333", "999.1.1.1 01.002.0003.255",
       "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 4111-1111-1111-1111", "1" * 50_000, "a" * 50_000,
       "a@" + "b." * 5_000 + "c", "+" + "1 " * 5_000, "1.2" * 3_000, "+1((((((", "😀 a@b.co 😀"]


def test_base_spans_equal_the_plain_patterns(spark):
    all_rows = TEXTS + [(100 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(all_rows, "doc_id long, text string")
    base = pii.listed(F.filter("spans", lambda s: s["base"]))
    found = pii.scan(df).select("doc_id", base)
    expected = [(i, ",".join(":".join(map(str, s)) for s in plain_spans(t))) for i, t in all_rows]
    assert rows(found) == sorted(expected, key=repr)


def test_added_spans_and_masks(spark):
    df = spark.createDataFrame(
        [(1, "call 030 1234 5678 now"), (2, "write bob (at) mail (dot) com"), (3, "nothing 12 here"),
         (4, "tel. +1 (706) 555-3138"), (5, None), (6, "mail ann@mail.com"), (7, "ben@web.org")],
        "doc_id long, text string",
    )
    found = {r[0]: r[1] for r in pii.scan(df).select("doc_id", pii.listed(F.col("spans"))).collect()}
    base = {6: "email:5:17", 7: "email:0:11"}
    assert found == {1: "phone:5:18", 2: "email:6:29", 3: "", 4: "phone:5:22", 5: "", **base}
    masked = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert masked[1] == "call [PHONE] now" and masked[4] == "tel. [PHONE]"
    assert masked[3] == "nothing 12 here" and masked[5] is None


def test_personal_data_of_clashing_columns_and_empty_tables(spark):
    df = clashing(spark)
    assert pii.masked(df).columns == df.columns
    assert pii.masked(df).count() == pii.scan(df).count() == len(TEXTS)
    assert pii.scan(empty(spark)).count() == 0


def test_reliabilities_trust_the_better_labeler():
    good, bad = (0, (0, 1, 1, 0), 1, 90.0), (0, (0, -1, -1, 1), 1, 90.0)
    chance = pii.reliabilities([good, bad])
    assert chance[good] > 0.9 and chance[bad] < 0.1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 257, 16385])
def test_running_totals_across_blocks(spark, n):
    values = [(7 * i) % 11 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    total = pii.running(F.col("v"), 0, lambda a, b: a + b).alias("sum")
    most = pii.running(F.col("v"), -1, lambda a, b: F.greatest(a, b)).alias("max")
    found = df.select(total, most).head()
    assert found["sum"] == [sum(values[:i]) for i in range(n)] if n < 300 else len(found["sum"]) == n
    assert found["max"] == [max(values[:i], default=-1) for i in range(n)] if n < 300 else found["max"][-1] == 10


def test_many_spans_in_one_text(spark):
    """Thousands of spans of two kinds that partly overlap: places and masks as in a plain scan."""
    word = "mail to a{0}@b.org or +1 555 {0:07d} or 10.0.{1}.7, 0{0:09d}\n"
    text = "é" + "".join(word.format(i, i % 256) for i in range(3000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    spans = pii.scan(df).select("spans").head()[0]
    assert time.perf_counter() - start < 60
    base = [s for s in spans if s["base"]]
    assert len(base) >= 9000
    strict = [re.compile(p.replace("(?:\\G|", "(?:")) for p in pii.STRICT.values()]
    assert all(strict[s["kind"]].fullmatch(text[s["start"] : s["end"]]) for s in base)
    for s in spans:
        if not s["base"]:
            assert not any(b["start"] < s["end"] and s["start"] < b["end"] for b in base)
    masked, at = [], 0
    for a, b, k in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if a >= at:
            masked += [text[at:a], f"[{pii.KINDS[k].upper()}]"]
        at = max(at, b)
    assert pii.masked(df).head()["text"] == "".join([*masked, text[at:]])


def test_op10(spark, texts):
    for r in QUERIES["op10_personal_data"](spark, SF).collect():
        spans = plain_spans(texts[r.doc_id])
        n = collections.Counter(kind for kind, *_ in spans)
        listed = ",".join(":".join(map(str, s)) for s in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [n[k] for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))


# --- licences ---


def test_licence_rules_in_order(spark):
    found = {r.doc_id: r for r in licences.scan(documents(spark)).collect()}
    assert found[10].licences == "MIT" and found[10].sentence_ids == "0:mit-name,1:mit-notice"
    assert found[3].n_sentences == 0 and found[4].licence == ""
    apart = spark.createDataFrame(
        [(1, "Released under the MIT License. Else. Licensed under CC BY-NC 4.0.")], "doc_id long, text string"
    )
    assert licences.scan(apart).first().licences == "MIT,CC-BY-NC-4.0"
    assert licences.scan(clashing(spark)).count() == len(TEXTS)
    assert licences.scan(empty(spark)).count() == 0


def test_op9(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    expected = sorted(con.execute(ORACLE["op9_licences"]).fetchall())
    assert rows(QUERIES["op9_licences"](spark, SF)) == sorted(expected, key=repr)
    assert len({x[-1] for x in expected}) > 3


# Notices as their publishers word and wrap them, written apart from the operator's tables.
NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def test_notices_wrapped_or_not_and_in_comments(spark):
    docs = []
    for name, notice in NOTICES.items():
        lines = notice.split("\n")
        paragraphs = [" ".join(p.split()) for p in notice.split("\n\n")]
        for signs in ("", "# ", " * ", "// ", "-- "):
            docs.append((name, "Some file.\n\n" + "\n".join(signs + x for x in lines) + "\n\nint main;\n"))
        docs.append((name, "\n\n".join(paragraphs)))
        docs.append((name, "\n".join(paragraphs)))
    df = spark.createDataFrame(docs, "doc_id string, text string")
    found = [(r.doc_id, r.licence, r.licences) for r in licences.scan(df).collect()]
    assert sorted({f[:2] for f in found if f[0] != f[1]}) == []
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert rows(licences.scan(df)) == sorted(con.execute(ORACLE["op9_licences"]).fetchall(), key=repr)
