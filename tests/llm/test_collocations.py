"""Collocations against counting in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm import collocations as c


def _brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = []
    for (lang, p), a in often.items():
        longer = [v for (g, q), v in often.items() if g == lang and len(q) > len(p) and p in (q[:2], q[1:])]
        if any(100 * v >= 50 * a for v in longer):
            continue
        score, _, left, right = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[-1], -x[2], x[1].encode()))
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(best[:top], start=1)]
    return sorted(ranked)


def _found(docs, **settings):
    return sorted(tuple(r) for r in c.collocations(docs, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("size,least,top", [(c.CHUNK_BYTES, 10, 2000), (3000, 3, 40), (200, 2, 2000)])
def test_same_as_counting(spark, edge_docs, monkeypatch, size, least, top):
    """One bucket and many, on small chunks, with hot pairs that are dealt by three words."""
    monkeypatch.setattr(c, "CHUNK_BYTES", size)
    monkeypatch.setattr(c, "BUCKET_BYTES", size)
    rng = random.Random(8)
    names = [f"w{i}" for i in range(40)]
    more = [(i, " ".join(rng.choices(names, k=50)) + rng.choice([".", "! ", "\n", ""]) + f" Hot  PAIR\tx{i} hot pair y{i % 3}, the; end", rng.choice(["en", "de", None])) for i in range(150)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string, lang string"), allowMissingColumns=True)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    expected = _brute(rows, least, top)
    assert len(expected) > 10 and _found(docs, least=least, top=top) == expected


@pytest.mark.parametrize("narrow,clashes", [(1, 10**12), (2, 10**12), (6, 0)])
def test_words_whose_hashes_meet(spark, edge_docs, monkeypatch, narrow, clashes):
    """Names of one byte and of two, in which most words meet others, and names of eight."""
    monkeypatch.setattr(c, "NARROW", narrow)
    monkeypatch.setattr(c, "MOST_CLASHES", clashes)
    monkeypatch.setattr(c, "CHUNK_BYTES", 4000)
    docs = edge_docs.where("length(text) < 1500")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    # one byte names 127 words at most: fewer words then
    if narrow == 1:
        rng = random.Random(1)
        rows = [(rng.choice(["en", None]), " ".join(rng.choices([f"w{i}" for i in range(40)], k=300))) for _ in range(6)]
        docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    expected = _brute(rows, 3, 2000)
    assert len(expected) > 10 and _found(docs, least=3) == expected


def test_packing_of_suffixes():
    rng = np.random.default_rng(0)
    for width in (2, 6, 8):
        words = rng.integers(0, 1 << 63, (50, 3), dtype=np.uint64) >> np.uint64(65 - 8 * width)
        words[::7, 2] = (1 << 8 * width) - 1
        for n in (np.ones(50, np.int64), rng.integers(1, 1 << 40, 50)):
            back, count = c._unpacked(c._packed(words, n, width), width)
            expected = words.copy()
            expected[::7, 2] = (1 << 64) - 1
            assert (back.view(np.uint64) == expected).all() and (count == n).all()


def test_no_rows_and_no_words(spark, no_docs):
    assert _found(no_docs) == []
    docs = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " .,\n\t ", "en"), (4, "one", "en")], "doc_id bigint, text string, lang string")
    assert _found(docs, least=1) == []


def test_equal_scores_go_by_count_then_bytes(spark):
    docs = spark.createDataFrame([(1, "zz yy. zz yy. é a. é a. b c, b c, B C", "en")], "doc_id bigint, text string, lang string")
    assert [r[2] for r in _found(docs, least=2)] == ["b c", "zz yy", "é a"]
    assert len(_found(docs, least=2, top=1)) == 1


def test_counts_beyond_64_bits(spark):
    """The score's products are exact where they pass 64 bits: here by multiplying what Spark multiplies."""
    row = spark.sql("""SELECT (1000000BD * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS s
        FROM VALUES (123456789012345L, 900000000000001L, 800000000000003L) AS t(a, l, r)""").first()
    assert row.s == 10**6 * 123456789012345**2 // (900000000000001 * 800000000000003)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 3, st.integers(1, 5)), max_size=60), st.integers(1, 12))
def test_partitions_are_counts(entries, least):
    rows = [(a, b, -1 if x == 0 else x, n) for a, b, x, n in entries]
    symbols = np.array([r[:3] for r in rows], np.int64).reshape(-1, 3)
    found = c.frequent(symbols, np.array([r[3] for r in rows], np.int64), (least,) * 3)
    for length, (one, n) in enumerate(found, start=2):
        count = Counter()
        for r in rows:
            if -1 not in r[:length]:
                count[r[:length]] += r[3]
        got = {tuple(symbols[i][:length].tolist()): int(k) for i, k in zip(one, n, strict=True)}
        assert got == {p: k for p, k in count.items() if k >= least} and len(got) == len(one)
