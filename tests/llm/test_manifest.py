"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabwright.llm import manifest

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return _hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def _climb(levels, i, node):
    proof = ""
    for below in levels[:-1]:
        left, right = "".join(below[i - i % 3 : i]), "".join(below[i + 1 : i - i % 3 + 3])
        proof, node, i = proof + left + right, _hash(left + node + right), i // 3
    return proof, node


def _brute(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted((r for r in rows if r.source == s), key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text))) for s in sources}
    trees = {s: _tree([_leaf(r, r.text) for r in members[s]]) for s in sources}
    upper = _tree([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, r in enumerate(members[s]):
            leaf = new = _leaf(r, r.text)
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None:
                new = _leaf(r, r.text.replace("\n", ""))
            low, node = _climb(trees[s], i, new)
            high, root = _climb(upper, at, node)
            out.append((r.doc_id, leaf, trees[s][-1][0], upper[-1][0], _hash(low + high), root, root == upper[-1][0]))
    return out


def _found(docs, levels):
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    cut = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return sorted((tuple(r) for r in manifest.manifest(docs, cut, chosen, levels=levels).select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, manifest.LEVELS])
def test_same_as_one_tree(spark, edge_docs, levels):
    """Blocks of 3, of 9 and of all leaves; null sources and ids, repeated rows and ids, and one source with a single row."""
    more = edge_docs.withColumn("source", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") == 11, F.lit("ß alone")).otherwise(F.col("source")))
    rows = more.select("doc_id", "source", "lang", "n_chars", "text").collect()
    expected = sorted(_brute(rows), key=repr)
    assert _found(more, levels) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_trees_of_every_small_size(spark):
    rows = [(i, "s%03d" % n, "line\nline", None) for n in range(1, 14) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id int, source string, text string, n_chars int").withColumn("lang", F.lit(""))
    assert _found(docs, 1) == sorted(_brute(docs.select("doc_id", "source", "lang", "n_chars", "text").collect()), key=repr)


def test_no_rows_and_no_tampering(no_docs, edge_docs):
    assert manifest.manifest(no_docs).columns == list(COLUMNS) and manifest.manifest(no_docs).count() == 0
    assert manifest.manifest(edge_docs).where("not verified").count() == 0


def test_a_version_shares_what_it_does_not_copy():
    leaves = [_hash(str(i)) for i in range(27)]
    tree = manifest.Tree.over(leaves, 3)
    version = tree.version(13, _hash("new"))
    assert len(version.copied) == 4 and version.base is tree
    whole = manifest.Tree.over([*leaves[:13], _hash("new"), *leaves[14:]], 3)
    assert [[version.node(k, i) for i in range(len(level))] for k, level in enumerate(tree.levels)] == whole.levels
    assert manifest.folded(_hash("new"), tree.path(13)) == whole.top != tree.top
