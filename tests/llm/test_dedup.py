"""Removal of repeated words and bytes, and near-duplicates, against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabwright.llm import near_dup, repeats, substring_dedup, suffix_dedup
from tabwright.llm.components import components
from tabwright.llm.near_dup import drop_near_duplicates, near_duplicates
from tabwright.llm.substring_dedup import remove_repeated_runs
from tabwright.llm.suffix_dedup import remove_repeated_bytes

from .test_texts import thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _covered(sequences, length):
    count = Counter(tuple(s[i : i + length]) for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if count[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def _sha(data):
    return hashlib.sha256(data).hexdigest()


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("length,gram", [(35, 12), (8, 3)])
def test_repeated_words(edge_docs, length, gram):
    rows = edge_docs.select("doc_id", "text").collect()
    texts = [WORD.findall(r.text or "") for r in rows]
    expected = []
    for r, w, gone in zip(rows, texts, _covered(texts, length), strict=True):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected.append((r.doc_id, len(w), sum(gone), _sha(kept.encode()), kept))
    found = remove_repeated_runs(edge_docs, length, gram)
    assert _rows(found, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text") == sorted(expected, key=repr)


@pytest.mark.parametrize("shard", [repeats.SHARD_BYTES, 2000, 1])
def test_repeated_bytes(edge_docs, monkeypatch, shard):
    """One shard, several, and all grams too large for a shard (then windows are counted)."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rows = edge_docs.select("doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    expected = []
    for r, b, gone in zip(rows, texts, _covered(texts, 200), strict=True):
        spans = len(re.findall(b"\1+", bytes(gone)))
        expected.append((r.doc_id, len(b), sum(gone), spans, _sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    found = remove_repeated_bytes(edge_docs)
    assert _rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(expected, key=repr)


def _words_expected(rows, length):
    texts = [WORD.findall(t or "") for _, t in rows]
    out = []
    for (i, _), w, gone in zip(rows, texts, _covered(texts, length), strict=True):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), _sha(kept.encode())))
    return sorted(out, key=repr)


def _bytes_expected(rows):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), b, gone in zip(rows, texts, _covered(texts, 200), strict=True):
        out.append((i, len(b), sum(gone), _sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("same", ["a", "b", "n"])
def test_rows_of_one_id_whose_hashes_collide(spark, monkeypatch, same):
    """Where one of the things that tell rows of an id apart is equal, the others still do."""
    real = repeats.keyed

    def colliding(docs, id_col, text_col):
        fixed = F.lit(7).cast("long" if same == "a" else "int")
        return real(docs, id_col, text_col).withColumn("u", F.when(F.col("u").isNotNull(), F.col("u").withField(same, fixed)))

    for module in (substring_dedup, suffix_dedup):
        monkeypatch.setattr(module, "keyed", colliding)
    words = [f"w{i}" for i in range(80)]
    a, b = " ".join(words), " ".join(reversed(words))
    rows = [(1, a), (1, b), (2, a + " tail"), (3, "x y z"), (3, a), (4, None), (4, b[:40])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _rows(remove_repeated_runs(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == _words_expected(rows, 35)
    assert _rows(remove_repeated_bytes(docs), "doc_id", "n_bytes", "n_removed", "kept_sha256") == _bytes_expected(rows)


def test_regular_texts_are_not_taken_for_equal(spark):
    """Words, runs of words and bytes in the order of Thue and Morse, which hashes modulo a power of two confuse."""
    x, y = thue_morse(10)
    p, q = thue_morse(10, "u", "v")
    rows = [(1, f"{x} " * 36), (2, f"{y} " * 36), (3, x), (4, y), (5, " ".join(p)), (6, " ".join(q)), (7, x + "-" + y), (8, y + "-" + x)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _rows(remove_repeated_runs(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == _words_expected(rows, 35)
    assert _rows(remove_repeated_bytes(docs), "doc_id", "n_bytes", "n_removed", "kept_sha256") == _bytes_expected(rows)
    found = _rows(near_duplicates(docs, 4), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(_brute(rows, 4), key=repr)


def test_nothing_repeats_in_no_rows(no_docs):
    assert remove_repeated_runs(no_docs).count() == 0
    assert remove_repeated_bytes(no_docs).count() == 0
    assert near_duplicates(no_docs).count() == 0
    assert drop_near_duplicates(no_docs).columns == no_docs.columns


def _shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def _brute(rows, size, percent=80):
    """Sets by row, and the smallest id reachable; rows of one id are one node."""
    sets = [_shingles(t, size) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(rows):
        for m in range(k):
            j = rows[m][0]
            if i is None or j is None or not sets[k] or not sets[m]:
                continue
            common = len(sets[k] & sets[m])
            if 100 * common >= percent * (len(sets[k]) + len(sets[m]) - common):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [(i, len(s), None if i is None else top(i), i is None or top(i) == i) for (i, _), s in zip(rows, sets, strict=True)]


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(edge_docs, size):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    found = _rows(near_duplicates(edge_docs, size), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(_brute(rows, size), key=repr)


def test_one_of_each_group_stays(edge_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    kept = {i for i, _, _, keep in _brute(rows, 5) if keep}
    out = drop_near_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted((r for r in rows if r[0] in kept), key=repr)


def test_chains_inside_one_bucket(spark, monkeypatch):
    """Members that neither hub is similar to are still linked: a long chain of texts, each like its neighbours only."""
    monkeypatch.setattr(near_dup, "TILE", 4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[6 * k : 6 * k + 100]) for k in range(40)]
    rows = [((7 * k) % 40, t) for k, t in enumerate(texts)] + [(100 + k, f"filler {k} " * 3) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = _rows(near_duplicates(docs, 4), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(_brute(rows, 4), key=repr)


def test_bounds_keep_similar_pairs():
    least = near_dup.least_matches(0.8, 1e-9)
    assert all(m < 0.8 * n for m, n in zip(least, range(32, 129, 32), strict=True)) and least == sorted(least)


def test_string_ids(spark, prose):
    docs = spark.createDataFrame([(f"id{i}", t) for i, t in enumerate(prose)], "doc_id string, text string")
    assert remove_repeated_runs(docs).where("n_removed > 0").count() > 0
    rows = [(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()]
    assert all(a >= b for a, b in rows) and any(a > b for a, b in rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(200, 300), (5, 5), (300, 200)]
    found = components(spark.createDataFrame(links, "l bigint, r bigint"))
    expected = {i: i // 20 * 20 for i in range(60)} | {200: 200, 300: 200}
    assert {r.node: r.component for r in found.collect()} == expected
    assert components(spark.createDataFrame([], "l bigint, r bigint")).count() == 0
    assert found.select(F.countDistinct("node") == F.count("*")).first()[0]


def test_near_duplicates_hand_over_few_rows(spark, monkeypatch):
    """Jobs of this step hand Python few texts at once, and the session's own setting holds again after them."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    write = near_dup.materialise
    monkeypatch.setattr(near_dup, "materialise", lambda df: (seen.append(int(spark.conf.get(name))), write(df))[1])
    before = spark.conf.get(name)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:39], "x"])), (3, "other words")], "doc_id long, text string")
    assert _rows(near_duplicates(docs), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3)]
    assert seen and max(seen) <= near_dup.LEAN_ROWS
    assert spark.conf.get(name) == before
