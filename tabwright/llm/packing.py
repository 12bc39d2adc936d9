"""Packing by concatenating and cutting: token ids of all documents end to end, cut into windows of one length.

Pass 1 tokenizes each text once and writes its ids with the task that made them and their place among that task's ids.
The totals of the tasks, summed up, give each document's place in the whole. Pass 2 cuts documents at the windows' ends.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.stage import scratch_path
from tabwright.llm.blocks import LEAN_ROWS, Block, blocks, content_ids, words_of

#: Kinds of bytes: letters, punctuation, and all else; the letters of two bytes that begin with 0xC3 are added in ``units``.
LETTER, MARK, OTHER = 1, 2, 3
KIND = np.full(256, OTHER, np.uint8)
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[[*range(33, 48), *range(58, 65), *range(91, 95), 96, *range(123, 127)]] = MARK
#: Distinct units whose ids a worker keeps; beyond it starts anew.
KEPT_UNITS = 600_000
#: Totals of so many tasks may be broadcast (16 bytes each).
BROADCAST_TASKS = 1_000_000


@dataclass
class Units:
    """Byte ranges of units in (partly lower-cased) bytes, whether they are plain, their fingerprints, each document's first."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    plain: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray


def units(block: Block) -> Units:
    """Words of a block; letters followed by punctuation are two units, both plain, as is either alone.

    Plain units are in lower case. Letters are A to Z and those of U+00C0 to U+00FF; the vocabulary's splitting rule
    parts letters from punctuation, and nothing in a plain unit changes under its normal form.
    """
    words, data = words_of(block), block.data
    n = len(data)
    kind = KIND[data]
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # but the signs of times and division
    kind[wide] = kind[wide + 1] = LETTER
    change = np.zeros((2, n + 2), np.int32)
    change[0, 2 : n + 1] = np.cumsum((kind[:-1] == LETTER) & (kind[1:] == MARK))
    change[1, 2 : n + 1] = np.cumsum((kind[:-1] == MARK) & (kind[1:] == LETTER))
    others = np.append(0, np.cumsum(kind == OTHER))
    s, e = words.starts, words.ends
    plain = (others[e] == others[s]) & (change[1, e] == change[1, s + 1])
    cuts = np.flatnonzero((kind[:-1] == LETTER) & (kind[1:] == MARK)) + 1
    cuts = cuts[plain[np.searchsorted(s, cuts, side="right") - 1]] if len(s) else cuts[:0]
    edges = np.zeros(n + 1, np.int8)
    edges[s[plain]] += 1
    edges[e[plain]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    low = data.copy()
    low[inside & (data >= 65) & (data <= 90)] += 32
    upper = wide[inside[wide] & (data[wide + 1] <= 0x9E)] + 1
    low[upper] += 32
    starts, ends = np.sort(np.append(s, cuts)), np.sort(np.append(e, cuts))
    owner = np.searchsorted(s, starts, side="right") - 1
    return Units(low, starts, ends, plain[owner], content_ids(low, starts, ends), np.searchsorted(starts, block.bounds))


class WordTokenizer:
    """Ids of texts under a vocabulary that drops white space and lower-cases, each distinct unit encoded once.

    The vocabulary splits texts at white space and between letters and punctuation, so the ids of a text are those of its
    units. Many new plain units are encoded as one text: each ends with a token that is marked as a word's end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        with open(path) as f:
            rules = json.load(f)
        if rules["model"].get("end_of_word_suffix") != "</w>" or "Lowercase" not in json.dumps(rules.get("normalizer")):
            raise ValueError(f"{path} does not split and lower-case words as this operator relies on")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.pool, self.used = np.zeros(1 << 20, self.kind), 0
        self.offsets, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, fingerprints: list[int], texts: list[str], plain: np.ndarray) -> None:
        order = np.argsort(~plain, kind="stable").tolist()  # plain ones first
        n = int(plain.sum())
        for at in range(0, n, 1000):
            some = order[at : min(at + 1000, n)]
            ids = self.encode([" ".join([texts[i] for i in some])])[0]
            stops = np.flatnonzero(self.last[ids]) + 1
            if len(stops) == len(some):
                self._store([fingerprints[i] for i in some], ids, np.diff(stops, prepend=0))
            else:
                self._store_each([fingerprints[i] for i in some], [texts[i] for i in some])
        self._store_each([fingerprints[i] for i in order[n:]], [texts[i] for i in order[n:]])

    def _store_each(self, fingerprints: list[int], texts: list[str]) -> None:
        if texts:
            pieces = self.encode(texts)
            self._store(fingerprints, np.concatenate(pieces), np.array([len(p) for p in pieces]))

    def _store(self, fingerprints: list[int], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, n = len(self.known), len(fingerprints)
        while first + n > len(self.offsets):
            self.offsets, self.sizes = (np.append(x, np.zeros(len(x), np.int64)) for x in (self.offsets, self.sizes))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros(len(self.pool), self.kind))
        self.known.update(zip(fingerprints, range(first, first + n), strict=True))
        self.offsets[first : first + n], self.sizes[first : first + n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def ids(self, block: Block, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, ``end`` after each document, and the number of ids of each document."""
        found = units(block)
        unique, first, which = np.unique(found.ids, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > KEPT_UNITS:
            self._forget()
        fingerprints = unique.tolist()
        new = [i for i, f in enumerate(fingerprints) if f not in self.known]
        if new:
            raw, at = found.data.tobytes(), first[new]
            texts = [raw[s:e].decode() for s, e in zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)]
            self._learn([fingerprints[i] for i in new], texts, found.plain[at])
        place = np.fromiter(map(self.known.__getitem__, fingerprints), np.int64, len(fingerprints))
        offsets, sizes = self.offsets[place][which], self.sizes[place][which]
        upto = np.append(0, np.cumsum(sizes))
        ends = upto[found.bounds[1:]]
        spots = np.repeat(offsets - upto[:-1], sizes) + np.arange(upto[-1])
        return np.insert(self.pool[spots], ends, end), np.diff(ends, prepend=0) + 1


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def _tokenize(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        words = tokenizer(path)
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, n = words.ids(block, end)
                bounds = np.append(0, np.cumsum(n))
                blobs = [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array(place + bounds[:-1]), batch.column(0).slice(block.first, len(n)),
                     pa.array(n), pa.array(blobs, pa.binary())],
                    names=["part", "place", "doc_id", "n", "ids"],
                )
                place += int(bounds[-1])

    return run


def _cut(length: int, width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint16 if width == 2 else np.uint32
        for batch in (whole.slice(at, LEAN_ROWS) for whole in batches for at in range(0, whole.num_rows, LEAN_ROWS)):
            begin, n = (batch.column(i).to_numpy() for i in (1, 2))
            pieces = (begin + n - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begin[row] // length + nth
            a = np.maximum(begin[row], sequence * length)
            b = np.minimum(begin[row] + n[row], (sequence + 1) * length)
            start = a - begin[row]
            blobs, crcs, parts = batch.column(3), [], []
            last, ids = -1, None
            for r, s, size in zip(row.tolist(), start.tolist(), (b - a).tolist(), strict=True):
                if r != last:
                    last, ids = r, np.frombuffer(blobs[r].as_buffer(), kind)
                piece = ids[s : s + size].astype("<u4").tobytes()
                crcs.append(zlib.crc32(piece))
                if with_ids:
                    parts.append(piece)
            out = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(b - a), pa.array(crcs, pa.int64()),
                   pa.array(n[row]), pa.array(sequence), pa.array(a - sequence * length)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out, names = [*out, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def pack(
    docs: DataFrame, path: str, length: int = 2048, end: int = 1, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, unsigned 32-bit).

    ``path`` is the vocabulary's file, readable on every executor. Every row of ``docs`` is a document, rows with a null
    or repeated id included; its ids are those of its text and then ``end``, so a null or empty text is one id. All
    sequences but the last are full, so at most ``length - 1`` places are padding. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"part int, place long, doc_id {kind}, n long, ids binary"
    at = scratch_path(spark)
    texts.mapInArrow(_tokenize(path, end), schema).write.option("compression", "zstd").parquet(at)
    tokens = spark.read.schema(schema).parquet(at)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of pass 1
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0).cast("long")).alias("base"))
    if bases.count() <= BROADCAST_TASKS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, "part").select("doc_id", (F.col("base") + F.col("place")).alias("begin"), "n", "ids")
    out = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    width = 2 if tokenizer(path).kind is np.uint16 else 4
    return placed.mapInArrow(_cut(length, width, with_ids), out + (", ids binary" if with_ids else ""))
