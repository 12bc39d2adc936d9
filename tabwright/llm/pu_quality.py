"""Quality classifier from positive and unlabelled texts: a logistic model that minimises the non-negative unbiased risk.

Features are shares of bytes, of neighbouring character classes, and measures of repetition, from whole texts. The model
is fitted on a bounded sample of trusted positives and of unlabelled texts; the class prior comes from all training labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.blocks import LEAN_BYTES, LEAN_ROWS, WORD_BASE, Block, Rolling, batches_of, blocks, mix, words_of
from tabwright.llm.sampling import first_by_hash

#: Most positives, and most unlabelled texts, that the model is fitted on.
SAMPLE = 10_000
#: Every fifth id (by crc32 of its text) is held out.
FOLDS = 5
THRESHOLD = 0.3
_CLASSES = np.full(256, 7, np.uint8)
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"?-()")):
    _CLASSES[list(_bytes)] = _k
_CLASSES[[b for b in range(33, 127) if _CLASSES[b] == 7]] = 6
N_FEATURES = 256 + 64 + 8


def _distinct(row: np.ndarray, prints: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct fingerprints of each row."""
    owner = row[np.unique(prints ^ mix(row.astype(np.uint64) + np.uint64(1)), return_index=True)[1]]
    return np.bincount(owner, minlength=rows)


def features(block: Block) -> np.ndarray:
    """A row of features for each document of a block; all 0 for an empty text."""
    rows = block.last - block.first
    sizes = np.diff(block.bounds)
    out = np.zeros((rows, N_FEATURES), np.float32)
    row = np.repeat(np.arange(rows), sizes)
    data = block.data
    by_byte = np.bincount(row * 256 + data, minlength=rows * 256).reshape(rows, 256)
    classes = _CLASSES[data]
    pairs = (row[1:] * 64 + classes[:-1] * np.int64(8) + classes[1:])[row[1:] == row[:-1]]
    by_pair = np.bincount(pairs, minlength=rows * 64).reshape(rows, 64)
    total = np.maximum(sizes, 1)[:, None]
    out[:, :256] = np.sqrt(by_byte / total)
    out[:, 256:320] = np.sqrt(by_pair / total)
    words = words_of(block)
    n = np.diff(words.bounds)
    of_word = np.repeat(np.arange(rows), n)
    some = np.maximum(n, 1)
    repeats = np.bincount(of_word[1:][(words.ids[1:] == words.ids[:-1]) & (of_word[1:] == of_word[:-1])], minlength=rows)
    triples = Rolling(words.ids, WORD_BASE).windows(3)
    inside = of_word[: len(triples)] == of_word[2:]
    n_triples = np.bincount(of_word[: len(triples)][inside], minlength=rows)
    length = np.bincount(of_word, words.ends - words.starts, minlength=rows)
    single = np.bincount(of_word[words.ends - words.starts == 1], minlength=rows)
    stats = (
        np.log1p(n), _distinct(of_word, words.ids, rows) / some, repeats / some,
        _distinct(of_word[: len(triples)][inside], triples[inside], rows) / np.maximum(n_triples, 1),
        length / some, single / some, by_byte[:, 10] / some, np.log1p(sizes),
    )
    for i, x in enumerate(stats):
        out[:, 320 + i] = x
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-z.astype(np.float64).clip(-60, 60)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.02, decay: float = 1e-3) -> Model:
    """Minimise prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]) for the logistic loss l, by Adam.

    Where the second part is negative its gradient is turned round, which undoes the overfit that made it so. Without
    positives or unlabelled texts the model scores every text with the prior.
    """
    width = N_FEATURES
    if not len(positive) or not len(unlabelled):
        odds = np.log(prior / (1 - prior))
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(odds), prior)
    mean = unlabelled.mean(axis=0)
    scale = unlabelled.std(axis=0) + 1e-2
    p, u = (((x - mean) / scale).clip(-8, 8).astype(np.float64) for x in (positive, unlabelled))
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        fp, fu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-fp.clip(-60, 60))), 1 / (1 + np.exp(-fu.clip(-60, 60)))
        below = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gp, gu = -prior * (1 - sp) / len(p), su / len(u)  # of the two parts, by f
        gn = -prior * sp / len(p)
        if below >= 0:
            by_p, by_u = gp + gn, gu
        else:
            by_p, by_u = -gn, -gu
        g = np.append(by_p @ p + by_u @ u + decay * w, by_p.sum() + by_u.sum())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Model(mean, scale, w, b, prior)


def held_out(column):
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % FOLDS == 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1), LEAN_BYTES):
            x = features(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, len(x)), pa.array([r.tobytes() for r in x], pa.binary())], names=["trusted", "x"]
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the training ids: at most ``sample`` rows with label 1 and ``sample`` of any rows of ``docs``, by hash of the id.

    Labels other than 0 and 1 and labels without an id are not used. The prior is the share of label 1 among all
    training labels, moved one row away from 0 and 1.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    n, ones = usable.agg(F.count("*"), F.coalesce(F.sum(F.col("quality").cast("long")), F.lit(0))).first()
    prior = (ones + 1) / (n + 2)
    trusted = usable.where("quality = 1")
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = [
        first_by_hash(frame.select("doc_id", F.xxhash64("doc_id", F.lit(seed)).alias("h")), sample, size).select(
            "doc_id", F.lit(seed == 1).alias("trusted")
        )
        for seed, frame, size in ((1, trusted, ones), (2, ids, docs.count()))
    ]
    pick = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * sample ids
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(pick, "doc_id").select("trusted", "text")
    with batches_of(docs.sparkSession, LEAN_ROWS):
        table = rows.mapInArrow(_features, "trusted boolean, x binary").toPandas()
    x = np.frombuffer(b"".join(table["x"]), np.float32).reshape(-1, N_FEATURES)
    mine = table["trusted"].to_numpy(bool)
    return fit(x[mine], x[~mine], prior)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), LEAN_BYTES):
                scores = model.scores(features(block))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(scores)), pa.array(scores)], names=["doc_id", "score"])

    return run


def _filter(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(batch.schema.get_field_index("text")), LEAN_BYTES):
                keep = model.scores(features(block)) >= threshold
                yield batch.slice(block.first, len(keep)).filter(pa.array(keep))

    return run


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts are scored by the model as texts without features. Rows with a null or repeated id are scored
    each; a null id counts as empty text for the fold. Other columns are not read.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = train(docs, labels, sample)
    kind = texts.schema["doc_id"].dataType.simpleString()

    rows = texts.mapInArrow(_score(model), f"doc_id {kind}, score double")
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with their columns as they were."""
    return docs.mapInArrow(_filter(train(docs, labels, sample), threshold), docs.schema)
