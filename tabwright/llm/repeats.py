"""Windows of a fixed length that start more than once in a corpus, found without shuffling every window.

A window of ``length`` symbols holds ``length - gram + 1`` short grams; the leftmost one with the smallest fingerprint is
its anchor. Equal windows have equal anchors, so a window whose anchor gram is nobody else's cannot repeat. Neighbouring
windows mostly share their anchor; together they are a span. Per corpus symbol only about 2 / (length - gram) spans are
shuffled:

1. count the spans of each anchor gram, with partial counts before the shuffle;
2. keep the spans of grams that occur twice or more. Where all spans of a gram are equal, all their windows repeat;
3. otherwise take one span of each kind and settle its windows: by an exact count of window fingerprints, or by a suffix
   array of the spans that share grams. The caller chooses; both are exact and split by gram or window, not by document;
4. bring the marks back to each document and merge them there.

Anchors are chosen by hashes of which no more is asked than that equal grams have equal ones. Equality of spans and windows
is decided by XXH3 of their bytes or by hashes modulo the prime 2**61 - 1 of their words, inside one gram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.llm.blocks import BYTE_BASE, WORD_BASE, Block, Rolling, blocks, loose_windows, sliding_min, words_of

#: Bytes of distinct spans that go into one suffix array.
SHARD_BYTES = 1 << 20
#: So many ids that repeat may be broadcast.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Unit:
    """What a window is made of: its number of symbols, the length of its grams, and whether symbols are words or bytes."""

    length: int
    gram: int
    words: bool

    def symbols(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a block and where each document's begin (and the end)."""
        if not self.words:
            return block.data, block.bounds
        found = words_of(block)
        return found.ids, found.bounds

    @property
    def base(self) -> int:
        return WORD_BASE if self.words else BYTE_BASE

    def prints(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of ranges that decide whether they are equal."""
        if self.words:
            return Rolling(values, self.base).ranges(starts, ends)
        raw = values.tobytes()
        ranges = zip(starts.tolist(), ends.tolist(), strict=True)
        return np.fromiter((xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in ranges), np.uint64, len(starts))


#: What tells rows of one id apart.
MARK = "struct<a: bigint, b: int, n: int>"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ``u``, which tells rows of one id apart (null where an id has one row), and the text (null: empty).

    ``u`` holds two hashes of the text and its length. Rows that repeat id and text share their marks, which are the same
    for both.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    again = materialise(texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again"), F.lit(True).alias("is")))
    n = again.count()
    if not n:
        return texts.select("doc_id", F.lit(None).cast(MARK).alias("u"), "text")
    mark = F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b"), F.octet_length("text").alias("n"))
    joined = texts.join(F.broadcast(again) if n <= BROADCAST_IDS else again, F.col("doc_id").eqNullSafe(F.col("again")), "left")
    return joined.select("doc_id", F.when(F.col("is"), mark).alias("u"), "text")


def _runs(unit: Unit, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of a block: gram and span fingerprints, document row, first window in the document, number of windows."""
    none = np.zeros(0, np.int64)
    if len(values) < unit.length:
        return none, none, none, none, none
    grams = loose_windows(values, unit.gram)
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(keys, unit.length - unit.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
    place = np.flatnonzero(np.arange(unit.length, len(anchor) + unit.length) <= bounds[row + 1])
    if not len(place):
        return none, none, none, none, none
    owner = anchor[place]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    begin = place[first]
    prints = unit.prints(values, begin, begin + count - 1 + unit.length)
    return grams[owner[first]].view(np.int64), prints.view(np.int64), row[begin], begin - bounds[row[begin]], count


def _spans(unit: Unit) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                gram, span, row, start, n = _runs(unit, *unit.symbols(block))
                if len(gram):
                    rows = pa.array(row + block.first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram), pa.array(span), batch.column(0).take(rows), batch.column(1).take(rows),
                         pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=["gram", "span", "doc_id", "u", "start", "n"],
                    )

    return run


def spans(texts: DataFrame, unit: Unit) -> DataFrame:
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_spans(unit), f"gram long, span long, doc_id {kind}, u {MARK}, start int, n int")


def shared_spans(texts: DataFrame, unit: Unit) -> DataFrame:
    """Spans whose gram occurs in another span as well; ``mixed`` where not all spans of the gram are equal."""
    grams = (
        spans(texts, unit)
        .groupBy("gram")
        .agg(F.count("*").alias("times"), (F.min("span") != F.max("span")).alias("mixed"))
        .where("times > 1")
        .select("gram", "mixed")
    )
    # written, so that the join has a shuffle of its own, whose hot grams adaptive execution can split
    return materialise(spans(texts, unit).join(materialise(grams), "gram"))


def _contents(unit: Unit, windows: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of wanted spans: a row for each window with its fingerprint, or one row with the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            for block in blocks(batch.column(0)):
                values, bounds = unit.symbols(block)
                mine = wanted.slice(block.first, block.last - block.first)
                flat = mine.flatten()
                row = np.repeat(np.arange(len(mine)), np.diff(mine.offsets.to_numpy()))
                gram, span, copies, start, n = (flat.field(i).to_numpy() for i in range(5))
                begin = bounds[row] + start
                if not windows:
                    data = [values[b : b + k - 1 + unit.length].tobytes() for b, k in zip(begin, n, strict=True)]
                    out = [pa.array(gram), pa.array(span), pa.array(copies), pa.array(data, pa.binary())]
                    yield pa.RecordBatch.from_arrays(out, names=["gram", "span", "copies", "data"])
                    continue
                own = np.repeat(np.arange(len(n)), n)
                shift = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                at = begin[own] + shift
                prints = Rolling(values, unit.base).ranges(at, at + unit.length).view(np.int64)
                out = [pa.array(gram[own]), pa.array(span[own]), pa.array(copies[own]), pa.array(shift.astype(np.int32)), pa.array(prints)]
                yield pa.RecordBatch.from_arrays(out, names=["gram", "span", "copies", "shift", "window"])

    return run


def contents(kinds: DataFrame, texts: DataFrame, unit: Unit, windows: bool) -> DataFrame:
    """Windows or bytes of one span of each kind, read from the document it stands for."""
    wanted = kinds.groupBy(F.col("one.doc_id").alias("w_id"), F.col("one.u").alias("w_u")).agg(
        F.collect_list(F.struct("gram", "span", "copies", F.col("one.start"), F.col("one.n"))).alias("wanted")
    )
    joined = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & F.col("u").eqNullSafe(F.col("w_u"))).select("text", "wanted")
    tail = "shift int, window long" if windows else "data binary"
    return joined.mapInArrow(_contents(unit, windows), f"gram long, span long, copies long, {tail}")


def by_counts(kinds: DataFrame, texts: DataFrame, unit: Unit) -> DataFrame:
    """(gram, span, shifts): the windows of single spans that also start in another span, by counts of fingerprints."""
    found = materialise(contents(kinds, texts, unit, True))
    often = found.groupBy("gram", "window").agg(F.sum("copies").alias("times")).where("times > 1").select("gram", "window")
    hits = found.where("copies = 1").join(often, ["gram", "window"])
    return hits.groupBy("gram", "span").agg(F.collect_list("shift").alias("shifts"))


def marked_windows(texts: DataFrame, unit: Unit, settle: Callable[[DataFrame, DataFrame, Unit], DataFrame]) -> DataFrame:
    """(doc_id, u, marks): marks are (start, n, shifts): windows from ``start`` on, all n where ``shifts`` is null."""
    shared = shared_spans(texts, unit)
    mixed = shared.where("mixed")
    kinds = materialise(
        mixed.groupBy("gram", "span").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "u", "start", "n")).alias("one"))
    )
    settled = settle(kinds, texts, unit)
    whole = kinds.where("copies > 1").select("gram", "span", F.lit(None).cast("array<int>").alias("shifts"))
    marks = shared.where("not mixed").withColumn("shifts", F.lit(None).cast("array<int>"))
    marks = marks.unionByName(mixed.join(whole.unionByName(settled), ["gram", "span"]))
    return marks.groupBy("doc_id", "u").agg(F.collect_list(F.struct("start", "n", "shifts")).alias("marks"))


def covered(size: int, marks, length: int) -> np.ndarray:
    """Which of ``size`` symbols lie under a marked window."""
    edges = np.zeros(size + 1, np.int64)
    for start, n, shifts in marks:
        if shifts is None:
            edges[start] += 1
            edges[start + n - 1 + length] -= 1
        else:
            at = start + np.asarray(shifts, np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + length, -1)
    return np.cumsum(edges[:-1]) > 0


def with_marks(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """All texts with their marks (null: none)."""
    marks = marks.withColumnsRenamed({"doc_id": "m_id", "u": "m_u"})
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("u").eqNullSafe(F.col("m_u"))
    return texts.join(marks, same, "left").select("doc_id", "text", "marks")


def mark_rows(column: pa.Array) -> list:
    """Marks of each row of a batch as (start, n, shifts) tuples."""
    return [[(m["start"], m["n"], m["shifts"]) for m in row] if row else [] for row in column.to_pylist()]
