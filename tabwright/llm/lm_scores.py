"""Cross-entropy difference of two matched n-gram models: one of trusted texts, one of all texts.

Tokens are characters; the shared vocabulary is every character that occurs in any text. Both models count runs of 1 to
4 characters over all their texts and smooth each order with the one below by the same rule.

Counts are exact and stay in Spark, in written tables that grow with the corpus. Texts are packed into chunks. A place's
loss follows from the four characters that end there, so each chunk sends its distinct runs of four, once, and gets their
losses back; shorter runs are counted from the longer ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.llm.blocks import Block, blocks

ORDER = 4
#: Weight of the order below, in counts.
PULL = 4.0
#: Bytes of text in a chunk (one longer document is a chunk of its own).
CHUNK_BYTES = 4 << 20
#: Bits of a code point, and of a character's number where a chunk has few enough distinct ones.
POINT, CODE = 21, 16
#: Characters whose positions are held at once; a chunk holds its keys only.
PIECE = 1 << 18


def characters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block, each document after ``ORDER - 1`` zeros, and where each document's characters start (and end).

    Returns the sequence and a (rows, 2) array of ranges in it.
    """
    points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.append(0, np.cumsum((block.data & 0xC0) != 0x80, dtype=np.int32))[block.bounds]
    rows = len(heads) - 1
    out = np.insert(points, np.repeat(heads[:-1], ORDER - 1), 0)
    starts = heads[:-1] + (ORDER - 1) * np.arange(1, rows + 1)
    return out, np.stack([starts, starts + np.diff(heads)], axis=1)


def _inside(ranges: np.ndarray, size: int) -> np.ndarray:
    edges = np.zeros(size + 1, np.int8)
    np.add.at(edges, ranges[:, 0], 1)
    np.add.at(edges, ranges[:, 1], -1)
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


def _places(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value is in the sorted ``known``, in pieces: positions take eight bytes each."""
    out = np.empty(len(values), np.int32)
    for at in range(0, len(values), PIECE):
        out[at : at + PIECE] = np.searchsorted(known, values[at : at + PIECE])
    return out


@dataclass
class Keys:
    """The run of four that ends at each character of a block, as a number that orders and tells runs apart in the block.

    ``symbols`` are the code points (or pairs of them) that ``bits`` bits of a key stand for; ``sizes`` the characters of each row.
    """

    keys: np.ndarray
    symbols: np.ndarray
    bits: int
    sizes: np.ndarray

    def ends(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys as two pairs of code points."""
        code, least = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        if self.bits == 32:
            return self.symbols[distinct >> code], self.symbols[distinct & least]
        a, b, c, d = (self.symbols[(distinct >> (code * np.uint64(k))) & least] for k in (3, 2, 1, 0))
        return (a << np.uint64(POINT)) | b, (c << np.uint64(POINT)) | d

    def rows(self) -> np.ndarray:
        """The row of each character."""
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)


def keys_of(block: Block, code_bits: int = CODE) -> Keys:
    """Runs are compared exactly: by the numbers of their characters, or where these are too many, of their pairs."""
    points, ranges = characters(block)
    inside, sizes = _inside(ranges, len(points))[ORDER - 1 :], ranges[:, 1] - ranges[:, 0]
    present = np.zeros(1 << POINT, bool)
    present[points] = True
    alphabet = np.flatnonzero(present).astype(np.uint64)
    if len(alphabet) <= 1 << code_bits:
        points = (np.cumsum(present, dtype=np.int32) - 1).astype(np.uint16)[points]
        keys = points[: len(inside)].astype(np.uint64)
        for k in range(1, ORDER):
            keys <<= np.uint64(code_bits)
            keys |= points[k : k + len(inside)]
        return Keys(keys[inside], alphabet, code_bits, sizes)
    both = points[:-1].astype(np.uint64) << np.uint64(POINT)
    both |= points[1:]
    pairs = np.unique(both)
    number = _places(pairs, both)
    del both
    keys = number[: len(inside)].astype(np.uint64) << np.uint64(32)
    keys |= number[2 : 2 + len(inside)].astype(np.uint64)
    return Keys(keys[inside], pairs, 32, sizes)


def runs(block: Block, code_bits: int = CODE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of four characters, in order, as two pairs of code points; each character's run; each one's document."""
    found = keys_of(block, code_bits)
    distinct = np.unique(found.keys)
    return *found.ends(distinct), _places(distinct, found.keys), found.rows()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: its number, its rows and how many of them are trusted, and the rows as a compressed stream."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        trusted = batch.column(2).fill_null(False)
        texts = batch.column(1).fill_null("")
        rows = pa.RecordBatch.from_arrays([batch.column(0), texts, trusted], names=["doc_id", "text", "trusted"])
        for block in blocks(texts, CHUNK_BYTES):
            some = rows.slice(block.first, block.last - block.first)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(some)
            n = [number, some.num_rows, int(np.count_nonzero(some.column(2).to_numpy(zero_copy_only=False)))]
            yield pa.RecordBatch.from_arrays([*(pa.array([x]) for x in n), pa.array([sink.getvalue().to_pybytes()])], names=["chunk", "n", "n_trusted", "docs"])
            number += 1


def _unpack(docs: pa.Scalar) -> tuple[pa.RecordBatch, Block]:
    rows = pa.ipc.open_stream(docs.as_buffer()).read_next_batch()
    return rows, next(blocks(rows.column(1), 1 << 62))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct run of a chunk, with its number there and its counts in trusted and in all texts."""
    for batch in batches:
        for chunk, docs in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, block = _unpack(docs)
            run = keys_of(block)
            chosen = np.repeat(rows.column(2).to_numpy(zero_copy_only=False), run.sizes)
            some, n_some = np.unique(run.keys[chosen], return_counts=True)
            distinct, background = np.unique(run.keys, return_counts=True)
            target = np.zeros(len(distinct), np.int64)
            target[np.searchsorted(distinct, some)] = n_some
            head, tail = run.ends(distinct)
            for at in range(0, len(head), 50_000):
                cut = slice(at, at + 50_000)
                n = len(head[cut])
                out = [np.full(n, chunk), np.arange(at, at + n, dtype=np.int32), head[cut].astype(np.int64), tail[cut].astype(np.int64), target[cut], background[cut]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["chunk", "run", "head", "tail", "t", "b"])


def _last(run: Column, n: int) -> Column:
    """The last n characters of a run of up to three."""
    return run.bitwiseAND(F.lit((1 << POINT * n) - 1))


def _sums(counts: DataFrame, *key: Column) -> DataFrame:
    return counts.groupBy(*key).agg(F.sum("t").alias("t"), F.sum("b").alias("b"))


def _above(counts: DataFrame, below: DataFrame, last: Column, first: Column) -> DataFrame:
    """``counts`` with both models' probability of each run's last character after those before it, smoothed with ``below``."""
    smooth = below.select(F.col("run").alias("last"), F.col("p_t").alias("q_t"), F.col("p_b").alias("q_b"))
    context = below.select(F.col("run").alias("first"), F.col("t").alias("c_t"), F.col("b").alias("c_b"))
    joined = counts.withColumns({"last": last, "first": first}).join(smooth, "last").join(context, "first")
    p = [((F.col(m) + PULL * F.col(f"q_{m}")) / (F.col(f"c_{m}") + PULL)).alias(f"p_{m}") for m in ("t", "b")]
    return joined.select(*counts.columns, *p)


def losses(counts: DataFrame, n_trusted: int, n_docs: int) -> DataFrame:
    """Loss under both models of the last character of each run of four (head, tail, counts t and b).

    Each text starts after three zeros, which count as contexts: each shorter order has one more of its run of zeros a text.
    """
    zeros = counts.sparkSession.range(1).select(F.lit(0).cast("long").alias("run"), F.lit(n_trusted).cast("long").alias("t"), F.lit(n_docs).cast("long").alias("b"))

    def shorter(counts: DataFrame, run: Column) -> DataFrame:
        return materialise(_sums(counts.select(run.alias("run"), "t", "b").unionByName(zeros), F.col("run")))

    head, tail, run = F.col("head"), F.col("tail"), F.col("run")
    three = shorter(counts, F.shiftleft(_last(head, 1), 2 * POINT).bitwiseOR(tail))
    two = shorter(three, _last(run, 2))
    one = shorter(two, _last(run, 1))
    whole = one.agg(F.count("*").alias("v"), F.sum("t").alias("t"), F.sum("b").alias("b")).first()
    p = [((F.col(m) + PULL / whole.v) / (whole[m] + PULL)).alias(f"p_{m}") for m in ("t", "b")]
    p_two = materialise(_above(two, one.select("*", *p), _last(run, 1), F.shiftright(run, POINT)))
    p_three = materialise(_above(three, p_two, _last(run, 2), F.shiftright(run, POINT)))
    last = F.shiftleft(_last(head, 1), 2 * POINT).bitwiseOR(tail)
    first = F.shiftleft(head, POINT).bitwiseOR(F.shiftright(tail, POINT))
    p_four = _above(counts, p_three, last, first)
    return p_four.select("head", "tail", *((-F.log(F.least(F.col(f"p_{m}"), F.lit(1.0)))).alias(f"loss_{m}") for m in ("t", "b")))


def _score(chunks: pa.Table, found: pa.Table) -> pa.Table:
    """Mean loss per token under both models, in nats (0 for an empty text), and the number of tokens, per row of a chunk."""
    rows, block = _unpack(chunks.column("docs")[0])
    run = keys_of(block)
    n, row, distinct = run.sizes, run.rows(), np.unique(run.keys)
    losses = np.full((2, len(distinct)), np.nan)
    losses[:, found.column("run").to_numpy()] = [found.column(m).to_numpy() for m in ("loss_t", "loss_b")]
    sums = np.zeros((2, rows.num_rows))
    for at in range(0, len(row), PIECE):
        place = np.searchsorted(distinct, run.keys[at : at + PIECE])
        for total, loss in zip(sums, losses, strict=True):
            np.add.at(total, row[at : at + PIECE], loss[place])
    means = sums / np.maximum(n, 1)
    out = [rows.column(0), pa.array(n), pa.array(means[0]), pa.array(means[1]), pa.array(means[0] - means[1])]
    return pa.Table.from_arrays(out, names=["doc_id", "n_tokens", "target_loss", "background_loss", "difference"])


def cross_entropy_difference(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, mean loss under both models, and their difference (lower: like trusted).

    ``trusted`` has the doc_ids of the target texts. Null and empty texts have no tokens and losses 0. Rows that repeat
    an id are counted and scored each; a null id is never trusted; other columns are not read. Without trusted texts the
    target model is uniform over the vocabulary.
    """
    # texts are always shuffled to their marks: a list of trusted ids has no bound that would let it be broadcast
    marked = trusted.select("doc_id", F.lit(True).alias("trusted")).distinct().hint("merge")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(marked, "doc_id", "left").select("doc_id", "text", "trusted")
    chunks = materialise(rows.mapInArrow(_pack, "chunk long, n long, n_trusted long, docs binary"))
    size = chunks.agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted")).first()
    found = materialise(chunks.select("chunk", "docs").mapInArrow(_count, "chunk long, run int, head long, tail long, t long, b long"))
    counts = materialise(_sums(found, F.col("head"), F.col("tail")))
    # a run has one row per chunk, however often it occurs
    known = found.select("chunk", "run", "head", "tail").join(materialise(losses(counts, size.n_trusted or 0, size.n or 0)), ["head", "tail"])
    known = known.select("chunk", "run", "loss_t", "loss_b")
    kind = docs.schema["doc_id"].dataType.simpleString()
    both = chunks.select("chunk", "docs").groupBy("chunk").cogroup(known.groupBy("chunk"))
    return both.applyInArrow(_score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, difference double")
