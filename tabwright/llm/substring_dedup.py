"""Removal of repeated runs of words: Rabin-Karp hashes of fixed-length windows, counted in Spark, merged to intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.blocks import blocks, words_of
from tabwright.llm.repeats import Unit, by_counts, covered, keyed, mark_rows, marked_windows, with_marks


def _apply(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = mark_rows(batch.column(2))
            n_words, n_removed, kept = [], [], []
            for block in blocks(batch.column(1)):
                words = words_of(block)
                raw = block.data.tobytes()
                for i in range(block.last - block.first):
                    a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                    keep = np.arange(a, b)
                    if marks[block.first + i]:
                        keep = keep[~covered(b - a, marks[block.first + i], length)]
                    n_words.append(b - a)
                    n_removed.append(b - a - len(keep))
                    starts, ends = words.starts[keep].tolist(), words.ends[keep].tolist()
                    kept.append(b" ".join([raw[s:e] for s, e in zip(starts, ends, strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def remove_repeated_runs(
    docs: DataFrame, length: int = 35, gram: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: words, words removed, and the words kept, joined by one space.

    A word goes if it lies under a window of ``length`` words that also starts anywhere else in the input, the same
    document included. Null or empty texts have no words; rows that repeat an id are told apart by their texts, rows
    that repeat both are copies of each other; other columns are not read.
    """
    unit = Unit(length, gram, True)
    texts = keyed(docs, id_col, text_col)
    marks = marked_windows(texts, unit, by_counts)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return with_marks(texts, marks).mapInArrow(_apply(length), schema)
