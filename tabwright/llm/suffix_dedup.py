"""Removal of repeated byte strings by suffix arrays.

Spans of bytes whose anchor gram repeats (see ``repeats``) are brought together by gram into shards of bounded size.
Each shard's suffix array is induced and its permuted common prefixes tell which places start a string of ``length``
bytes that starts elsewhere, too. A gram with more distinct spans than fit in a shard is settled by counts of window
fingerprints, which Spark splits by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.llm.blocks import blocks
from tabwright.llm.repeats import SHARD_BYTES, Unit, by_counts, contents, covered, keyed, mark_rows, marked_windows, with_marks
from tabwright.llm.suffix import repeated_places


def _settle_shard(length: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        data = [np.frombuffer(x, np.uint8) for x in shard["data"]]
        sizes = np.array([len(x) for x in data])
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        text = np.full(int(sizes.sum()) + len(data), 256, np.uint16)  # 256 parts the spans
        for at, x in zip(starts, data, strict=True):
            text[at : at + len(x)] = x
        hit = np.flatnonzero(repeated_places(text, length))
        owner = np.searchsorted(starts, hit, side="right") - 1
        shift = hit - starts[owner]
        inside = shift + length <= sizes[owner]
        owner, shift = owner[inside], shift[inside]
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
        shifts = [x.tolist() for x in np.split(shift, cuts[1:])] if len(owner) else []
        out = shard.iloc[owner[cuts]][["gram", "span", "copies"]].assign(shifts=pd.array(shifts, object))
        return out[out["copies"] == 1][["gram", "span", "shifts"]]

    return run


def by_suffix_arrays(kinds: DataFrame, texts: DataFrame, unit: Unit) -> DataFrame:
    """(gram, span, shifts) of the single spans, from one suffix array for each shard of grams."""
    sizes = kinds.groupBy("gram").agg(F.sum(F.col("one.n") + unit.length).alias("bytes"))
    crowded = sizes.where(F.col("bytes") > SHARD_BYTES).select("gram")
    total = kinds.agg(F.sum(F.col("one.n") + unit.length)).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    few = contents(kinds.join(crowded, "gram", "left_anti"), texts, unit, False)
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards)).alias("shard")
    settled = few.groupBy(shard).applyInPandas(_settle_shard(unit.length), "gram long, span long, shifts array<int>")
    if crowded.isEmpty():
        return materialise(settled)
    many = by_counts(kinds.join(crowded, "gram", "left_semi"), texts, unit)
    return materialise(settled.unionByName(many))


def _apply(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = mark_rows(batch.column(2))
            rows = []
            for block in blocks(batch.column(1)):
                for i in range(block.last - block.first):
                    data = block.data[block.bounds[i] : block.bounds[i + 1]]
                    n, gone, spans, kept = len(data), 0, 0, data
                    if marks[block.first + i]:
                        drop = covered(n, marks[block.first + i], length)
                        gone, kept = int(drop.sum()), data[~drop]
                        spans = int(np.count_nonzero(drop[1:] & ~drop[:-1])) + int(drop[0])
                    rows.append((n, gone, spans, hashlib.sha256(kept.tobytes()).hexdigest(), kept.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
            )

    return run


def remove_repeated_bytes(
    docs: DataFrame, length: int = 200, gram: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: bytes, bytes removed, maximal removed runs, and the bytes kept.

    A byte goes if it lies under a ``length``-byte string (of the UTF-8 text) that also starts anywhere else in the
    input, the same document included; matches never cross documents. Null or empty texts have no bytes; rows that
    repeat an id are told apart by their texts, rows that repeat both are copies; other columns are not read.
    """
    unit = Unit(length, gram, False)
    texts = keyed(docs, id_col, text_col)
    marks = marked_windows(texts, unit, by_suffix_arrays)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    return with_marks(texts, marks).mapInArrow(_apply(length), schema)
