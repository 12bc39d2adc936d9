"""Quality classifier, quality rules, language model scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import lm_scores, pu_quality, quality_rules

from .conftest import words


@pytest.fixture(scope="module")
def labelled(spark):
    """Good and bad texts, three quarters labelled."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.8
        w = words(rng, rng.randint(20, 120))
        text = " ".join(w).capitalize() + "." if good else " ".join(f"{x.upper()}!!" if rng.random() < 0.8 else x for x in w)
        rows.append((i, text, "en", f"s{i % 3}"))
        if rng.random() < 0.75:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_classifier_on_held_out_rows(labelled):
    docs, labels = labelled
    found = pu_quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(found) > 50 and found.score.between(0, 1).all()
    assert (found.predicted == found.quality).mean() > 0.97
    assert found[found.quality == 1].score.min() > found[found.quality == 0].score.median()


def test_held_out_labels_are_not_learnt(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (pu_quality.classify(docs, x).orderBy("doc_id").toPandas().score for x in (labels, turned))
    assert np.allclose(a, b)


def test_classifier_of_edge_rows(edge_docs, no_docs, labelled, spark):
    docs, labels = labelled
    found = pu_quality.classify(edge_docs, labels)
    assert found.count() == edge_docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    assert pu_quality.classify(no_docs, labels).count() == 0
    none = labels.where("doc_id < 0")
    assert pu_quality.classify(docs, none).select(F.countDistinct("score")).first()[0] == 1
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0)], "doc_id bigint, quality int, toxic int")
    assert pu_quality.classify(docs, odd).count() == docs.count()
    kept = pu_quality.keep_good(edge_docs.withColumn("score", F.lit("x")), labels)
    assert kept.columns == [*edge_docs.columns, "score"] and kept.count() <= edge_docs.count()


def test_correction_keeps_the_risk_from_going_negative():
    rng = np.random.default_rng(0)
    width = pu_quality.N_FEATURES
    good, bad = rng.normal(1, 1, (400, width)), rng.normal(-1, 1, (200, width))
    model = pu_quality.fit(good[:200], np.vstack([good[200:], bad]), 0.5)
    assert (model.scores(good) > 0.5).mean() > 0.95 and (model.scores(bad) < 0.5).mean() > 0.95


def _counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(edge_docs, spark, no_docs):
    extra = spark.createDataFrame([(900, "a#b | <c> & $%* \n\n a#b |\n a#b |\n" * 3, "en", "s0"), (901, " a b c d e f g h a b c d e f g h z", None, None)], "doc_id bigint, text string, lang string, source string")
    docs = edge_docs.select("doc_id", "text", "lang", "source").unionByName(extra)
    found = quality_rules.judge(docs)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = sorted(((r.doc_id, *_counts(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted((tuple(r) for r in found.select("doc_id", *columns).collect()), key=repr) == expected
    assert found.where("kept and base_failed").count() == 0
    assert quality_rules.judge(no_docs).count() == 0
    assert quality_rules.judge(docs.select("doc_id", "text")).count() == docs.count()


def test_fences_follow_the_group(labelled, spark):
    docs, _ = labelled
    odd = spark.createDataFrame([(5000, " ".join(f"w{i}|" for i in range(60)), "en", "s0")], docs.schema)
    pipes = spark.createDataFrame([(6000 + k, " ".join(f"w{i * k}|" for i in range(60)), "en", "tables") for k in range(1, 300)], docs.schema)
    found = {r.doc_id: r for r in quality_rules.judge(docs.unionByName(odd).unionByName(pipes)).collect()}
    assert not found[5000].kept  # what no other text of its source does
    assert all(found[6000 + k].kept for k in range(1, 300))  # what is usual in its source


def test_limits_are_near_exact_quantiles(labelled):
    docs, _ = labelled
    measured = quality_rules._with_ratios(quality_rules.measures(docs)).cache()
    limits = {r.source: r for r in quality_rules.fences(quality_rules.sketches(measured)).collect()}
    pdf = measured.select("source", "chars_per_word").toPandas()
    for source, x in pdf.groupby("source").chars_per_word:
        low, middle, high = (np.quantile(x, q, method="inverted_cdf") for q in (quality_rules.LOW, 0.5, quality_rules.HIGH))
        assert limits[source].chars_per_word_most == pytest.approx(high + 2 * (high - middle) + 100, rel=0.03)
        assert limits[source].chars_per_word_least == pytest.approx(low - 2 * (middle - low) - 100, rel=0.03)


def _lined(i, source, repeated, lines=20):
    """A text of 20 lines of which a number repeats one short line, between the others as long as there are enough."""
    own = [" ".join(f"w{i}x{k}x{j}" for j in range(9)) for k in range(lines - repeated - 1)]
    short = ["again"] * (repeated + 1)
    mixed = [x for pair in zip(own, short, strict=False) for x in pair] + own[len(short) :] + short[len(own) :]
    return i, "\n".join(mixed), "en", source


def test_limits_differ_between_sources(spark):
    """Four lines in ten that repeat fail where hardly any do, and pass where that is common; symbols likewise."""
    plain = [_lined(i, "plain", i % 25 == 0) for i in range(400)] + [_lined(5000, "plain", 8)]
    lists = [_lined(1000 + i, "lists", 2 + i % 7) for i in range(400)] + [_lined(5001, "lists", 8), _lined(5003, "lists", 19)]
    marked = [(2000 + i, " ".join(f"w{i}x{j}" + "|" * (j % 5 == 0) for j in range(60)), "en", "tables") for i in range(300)]
    odd = [(5002, " ".join(f"v{j}y" + "|" * (j % 5 == 0) for j in range(60)), "en", "plain")]
    docs = spark.createDataFrame(plain + lists + marked + odd, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert not kept[5000] and kept[5001] and not kept[5002] and not kept[5003]
    assert all(kept[i] for i in kept if i < 5000)
    measured = quality_rules._with_ratios(quality_rules.measures(docs))
    limits = {r.source: r for r in quality_rules.fences(quality_rules.sketches(measured)).collect()}
    assert limits["plain"].dup_line_share_most < 400 < limits["lists"].dup_line_share_most <= 950
    assert limits["plain"].symbols_per_word_most < limits["tables"].symbols_per_word_most
    # counts in bins: the same for any partitioning and in every run
    again = [sorted(tuple(r) for r in quality_rules.fences(quality_rules.sketches(measured.repartition(n))).collect()) for n in (1, 7)]
    assert again[0] == again[1]


def test_bins_hold_their_quantiles(spark):
    values = spark.range(1, 30_000, 7).select(F.col("id").alias("v"))
    rows = values.select("v", quality_rules._top(quality_rules._bin(F.col("v"))).alias("top"), quality_rules._bin(F.col("v")).alias("bin")).orderBy("v").collect()
    assert all(r.v <= r.top <= 1.01 * r.v + 1 for r in rows) and [r.bin for r in rows] == sorted(r.bin for r in rows)
    assert spark.range(1).select(quality_rules._top(quality_rules._bin(F.lit(0)))).first()[0] == 0


def _brute_losses(texts, chosen):
    """The same smoothed models with dictionaries in place of slots."""
    pad = "\0" * (lm_scores.ORDER - 1)
    counts = [[Counter() for _ in range(lm_scores.ORDER)] for _ in range(2)]
    for t, trusted in zip(texts, chosen, strict=True):
        s = pad + (t or "")
        for m in range(2):
            if m == 1 or trusted:
                for k in range(lm_scores.ORDER):
                    for i in range(len(s)):
                        if i - k >= 0:
                            counts[m][k][s[i - k : i + 1]] += 1
    vocabulary = len(counts[1][0])
    out = []
    for t in texts:
        s, row = pad + (t or ""), []
        for m in range(2):
            loss = 0.0
            for i in range(len(pad), len(s)):
                p, context = 1 / vocabulary, sum(counts[m][0].values())
                for k in range(lm_scores.ORDER):
                    p = (counts[m][k][s[i - k : i + 1]] + lm_scores.PULL * p) / (context + lm_scores.PULL)
                    context = counts[m][k][s[i - 1 - k : i]]
                loss -= math.log(min(p, 1))
            row.append(loss / max(len(t or ""), 1))
        out.append(row)
    return out


def test_losses(edge_docs, no_docs, spark, prose):
    few = edge_docs.where("length(text) < 3000 or text is null")
    rows = few.select("doc_id", "text").collect()
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 2)] + [(None,), (2,)], "doc_id bigint")
    chosen = [r.doc_id is not None and r.doc_id < 40 and r.doc_id % 2 == 0 for r in rows]
    expected = {}
    for r, (a, b) in zip(rows, _brute_losses([r.text for r in rows], chosen), strict=True):
        expected.setdefault((r.doc_id, len(r.text or "")), []).append((a, b))
    for r in lm_scores.cross_entropy_difference(few, trusted).collect():
        pairs = expected[r.doc_id, r.n_tokens]
        assert min(abs(a - r.target_loss) + abs(b - r.background_loss) for a, b in pairs) < 1e-9
        assert r.difference == pytest.approx(r.target_loss - r.background_loss)
    assert lm_scores.cross_entropy_difference(no_docs, trusted).count() == 0
    assert lm_scores.cross_entropy_difference(few, trusted.where("doc_id < 0")).count() == len(rows)


def test_difference_tells_trusted_texts(labelled):
    docs, labels = labelled
    found = lm_scores.cross_entropy_difference(docs, labels.where("quality = 1 and doc_id % 2 = 0")).join(labels, "doc_id").where("doc_id % 2 = 1").toPandas()
    assert found[found.quality == 1].difference.max() < found[found.quality == 0].difference.median()


def test_losses_are_exact_for_many_characters(spark):
    rng = random.Random(5)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000)) for _ in range(40)] + ["", None, "a\0b", "\0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(0, 44, 3)], "doc_id bigint")
    found = {r.doc_id: r for r in lm_scores.cross_entropy_difference(docs, trusted).collect()}
    assert len(found) == len(texts)
    for i, (a, b) in enumerate(_brute_losses(texts, [i % 3 == 0 for i in range(len(texts))])):
        assert found[i].target_loss == pytest.approx(a, abs=1e-9) and found[i].background_loss == pytest.approx(b, abs=1e-9)


def test_runs_are_the_same_by_characters_and_by_pairs(prose):
    import pyarrow as pa

    from tabwright.llm.blocks import blocks

    block = next(blocks(pa.array(prose)))
    one, other = lm_scores.runs(block), lm_scores.runs(block, 2)
    assert all((a == b).all() for a, b in zip(one, other, strict=True))


def test_a_chunk_takes_little_memory_beyond_its_keys(prose):
    import tracemalloc

    import pyarrow as pa

    texts = [f"{t} {i}" for i in range(40) for t in prose if t]
    size = sum(map(len, texts))
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([i % 3 == 0 for i in range(len(texts))])], names=["doc_id", "text", "trusted"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    chunk = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([sink.getvalue().to_pybytes()])], names=["chunk", "docs"])
    tracemalloc.start()
    try:
        counted = pa.Table.from_batches(list(lm_scores._count(iter([chunk]))))
        loss = pa.array([1.0 + i % 2 for i in range(len(counted))])
        scored = lm_scores._score(pa.Table.from_batches([chunk]), pa.table({"run": counted["run"], "loss_t": loss, "loss_b": loss}))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(counted["b"].to_pylist()) == sum(scored["n_tokens"].to_pylist()) == size
    assert peak < 45 * size  # keys, a sorted copy and the places of pieces; positions of all characters took over 80
