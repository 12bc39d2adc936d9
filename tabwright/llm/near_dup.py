"""Near-duplicates: banded MinHash candidates, pruned by sequential Bayesian verification, confirmed on full sets.

1. One pass gives each text its set of word shingles as a count, a 128-bit digest of the set and a MinHash signature.
   Texts with equal sets are one class; only classes are compared.
2. Classes that agree in a band of the signature share a bucket. A bucket's members are paired with its hub, never with
   each other; classes already in one component are not paired again.
3. A pair is compared signature batch by batch and dropped once the posterior probability that its similarity reaches
   the threshold is below the chosen miss probability. Survivors are confirmed by the overlap of their full sets.
4. Buckets whose members are not all connected after two rounds of hubs are settled within tasks, in tiles of bounded
   size: members of their smaller components against members of other components, by the same bounds and the same full
   sets. Only confirmed links leave a task, and of buckets with the same members only one is looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.llm.blocks import LEAN_BYTES, LEAN_ROWS, WORD_BASE, Block, Rolling, batches_of, blocks, lower_ascii, mix, words_of
from tabwright.llm.components import components

#: 128 hashes in 32 bands of 4: two sets of similarity 0.8 share no band with probability 5e-8.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Hashes that are compared before each check of the posterior.
BATCH = 32
#: Members of a bucket that one tile holds on either side.
TILE = 512

_MULTIPLY = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_sets(block: Block, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each document; a document with fewer words is one shingle."""
    words = words_of(block, lower_ascii(block.data))
    roll = Rolling(words.ids, WORD_BASE)
    every = roll.windows(size)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        else:
            out.append(roll.ranges(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each MinHash; a row for each (not empty) set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint16)
    for i in range(HASHES):
        out[:, i] = mix(np.minimum.reduceat(flat * _MULTIPLY[i] + _ADD[i], starts)) >> np.uint64(48)
    return out


def _digest(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), LEAN_BYTES):
                sets = shingle_sets(block, size)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                a, b, sig = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), [None] * len(n)
                if len(full):
                    some = [sets[i] for i in full]
                    flat, starts = np.concatenate(some), np.cumsum([0] + [len(s) for s in some[:-1]])
                    a[full] = np.add.reduceat(mix(flat), starts).view(np.int64)
                    b[full] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), starts).view(np.int64)
                    for i, s in zip(full.tolist(), signatures(some), strict=True):
                        sig[i] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(n)), pa.array(n), pa.array(a), pa.array(b), pa.array(sig, pa.binary())],
                    names=["doc_id", "n", "a", "b", "sig"],
                )

    return run


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """The bucket of each band of each signature; its last 5 bits are the band."""
    band = np.arange(BANDS, dtype=np.uint64)
    keys = np.ascontiguousarray(sig).view(np.uint64) + (band + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mix(keys) & np.uint64(2**64 - BANDS)) | band).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES)
        rep = batch.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS)))
        yield pa.RecordBatch.from_arrays([pa.array(bucket_keys(sig).ravel()), rep], names=["bucket", "rep"])


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each batch, the smallest number of equal hashes so far at which the pair is still alive.

    With a uniform prior, m of n equal hashes leave the posterior Beta(m + 1, n - m + 1); its mass above the threshold
    is the probability of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def alive(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows of signature pairs that no batch rules out."""
    rows, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for i, m in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + np.count_nonzero(left[rows, part] == right[rows, part], axis=1)
        rows, matches = rows[matches >= m], matches[matches >= m]
    return rows


def _prune(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in (2, 3))
            yield batch.select([0, 1]).take(pa.array(alive(left, right, least)))

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sides = [[s for block in blocks(batch.column(c), LEAN_BYTES) for s in shingle_sets(block, size)] for c in (2, 3)]
                keep = []
                for x, y in zip(*sides, strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _tile(least: list[int], size: int, percent: int):
    """Links of a tile: its minor members against its members of other components."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, HASHES)
        sets = [x for block in blocks(pa.array(rows["text"]), LEAN_BYTES) for x in shingle_sets(block, size)]
        n = np.array([len(x) for x in sets])
        component = pd.factorize(rows["component"])[0]
        rep, minor = rows["rep"].to_numpy(), rows["minor"].to_numpy(bool)
        band = int(rows["bucket"].iloc[0]) % BANDS
        other = np.flatnonzero(~minor)
        found = []
        for i in np.flatnonzero(minor).tolist():
            j = other[(component[other] != component[i]) & (rep[other] != rep[i])]
            j = j[alive(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j], least)]
            # a pair is left to the first band that it shares
            same = (sig[j].reshape(-1, BANDS, ROWS) == sig[i].reshape(BANDS, ROWS)).all(axis=2)
            j = j[same.argmax(axis=1) == band]
            if not len(j):
                continue
            flat = np.concatenate([sets[k] for k in j.tolist()])
            place = np.minimum(np.searchsorted(sets[i], flat), n[i] - 1)
            common = np.add.reduceat(sets[i][place] == flat, np.cumsum(n[j]) - n[j])
            j = j[100 * common >= percent * (n[i] + n[j] - common)]
            found += [(min(rep[i], rep[k]), max(rep[i], rep[k])) for k in j.tolist()]
        return pd.DataFrame(found, columns=["l", "r"])

    return run


class _Candidates:
    """Classes that share buckets, with signatures and texts, and what is known to be linked."""

    def __init__(self, texts: DataFrame, classes: DataFrame, size: int, percent: int, miss: float):
        self.size, self.percent, self.least = size, percent, least_matches(percent / 100, miss)
        self.kind = texts.schema["doc_id"].dataType.simpleString()
        bands = classes.select("rep", "sig").mapInArrow(_bands, f"bucket long, rep {self.kind}")
        shared = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).where("n > 1")
        #: Members of buckets with their hub, the smallest of them.
        self.members = materialise(bands.join(shared.select("bucket", "hub"), "bucket"))
        several = self.members.select("rep").distinct()
        self.sigs = materialise(classes.select("rep", "sig").join(several, "rep"))
        # a document that stands for a class may repeat its id with another text; its class is told by the digest
        self.texts = materialise(texts.join(several, texts["doc_id"] == several["rep"]).select("rep", "text").distinct())
        self.nodes: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> None:
        """Find those of the pairs (l, r) that are similar."""
        sig, text = self.sigs, self.texts
        both = pairs.join(sig.toDF("l", "ls"), "l").join(sig.toDF("r", "rs"), "r").select("l", "r", "ls", "rs")
        alive_pairs = materialise(both.mapInArrow(_prune(self.least), f"l {self.kind}, r {self.kind}"))
        full = alive_pairs.join(text.toDF("l", "lt"), "l").join(text.toDF("r", "rt"), "r").select("l", "r", "lt", "rt")
        self.link(full.mapInArrow(_confirm(self.size, self.percent), f"l {self.kind}, r {self.kind}"))

    def link(self, links: DataFrame) -> None:
        """Add links and place their nodes in components; the components so far stand for the links that made them."""
        found = materialise(links)
        if self.nodes is None:
            self.nodes = materialise(components(found))
        elif not found.isEmpty():
            self.nodes = materialise(components(self.nodes.toDF("l", "r").unionByName(found)))

    def open_buckets(self) -> DataFrame:
        """Members, with components, of the buckets that hold several components."""
        placed = self.members.join(self.nodes.withColumnRenamed("node", "rep"), "rep", "left")
        placed = placed.select("bucket", "rep", "hub", F.coalesce("component", "rep").alias("component"))
        several = placed.groupBy("bucket").agg((F.min("component") != F.max("component")).alias("open")).where("open")
        return materialise(placed.join(several.select("bucket"), "bucket"))

    def settle(self, open_rows: DataFrame) -> None:
        """Find all links between members of a bucket that lie in different components."""
        one = F.struct(F.pmod("bucket", F.lit(BANDS)).alias("band"), F.col("bucket").alias("bucket"))
        sums = open_rows.groupBy("bucket").agg(
            F.count("*").alias("size"), *(F.bit_xor(F.xxhash64(F.lit(k), F.col("rep"))).alias(f"x{k}") for k in range(2))
        )
        twins = sums.groupBy("size", "x0", "x1").agg(F.min(one)["bucket"].alias("bucket")).select("bucket", "size")
        by_part = open_rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        largest = by_part.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"))
        minors = F.col("size") - F.col("top.n")
        slices, cuts = (F.ceil(x / TILE).cast("int") for x in (F.col("size"), minors))
        spot = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).cast("int")
        rows = open_rows.join(twins, "bucket").join(largest, "bucket").select(
            "bucket", "rep", "component", (F.col("component") != F.col("top.component")).alias("small"),
            (spot % slices).alias("slice"), (spot % cuts).alias("cut"), slices.alias("slices"), cuts.alias("cuts"),
        )
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        others = rows.select("bucket", "rep", "component", every("cuts").alias("cut"), "slice", F.lit(False).alias("minor"))
        small = rows.where("small").select("bucket", "rep", "component", "cut", every("slices").alias("slice"), F.lit(True).alias("minor"))
        full = others.unionByName(small).join(self.sigs.join(self.texts, "rep"), "rep")
        found = full.groupBy("bucket", "cut", "slice").applyInPandas(
            _tile(self.least, self.size, self.percent), f"l {self.kind}, r {self.kind}"
        )
        self.link(found.distinct())


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, miss: float = 1e-9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable) and kept (it is the smallest).

    Texts are linked if ``percent`` or more of the union of their sets of ``size``-word shingles is common (letters A-Z
    in lower case; a text with fewer words is one shingle). Null and empty texts have empty sets and no links. Rows that
    repeat an id are one document. A row without an id is linked with nothing: its component is null and it is kept.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    with batches_of(docs.sparkSession, LEAN_ROWS):
        digests = materialise(texts.mapInArrow(_digest(size), f"doc_id {kind}, n long, a long, b long, sig binary"))
        known = digests.where("n > 0 and doc_id is not null")
        classes = materialise(known.groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig")))
        found = _Candidates(texts, classes, size, percent, miss)
        hubs = found.members.where("rep <> hub").select(F.col("hub").alias("l"), F.col("rep").alias("r")).distinct()
        found.confirm(hubs)
        rest = found.open_buckets()
        if not rest.isEmpty():
            # another hub: the first by hash of the largest component's members; it is compared with the other components
            parts = rest.where("rep <> hub").groupBy("bucket", "component").agg(
                F.count("*").alias("n"), F.min(F.struct(F.xxhash64("rep"), F.col("rep").alias("id")))["id"].alias("l")
            )
            top = parts.groupBy("bucket").agg(F.max(F.struct("n", "component", "l")).alias("top"))
            again = top.select("bucket", F.col("top.l").alias("l"), F.col("top.component").alias("c"))
            pairs = rest.join(again, "bucket").where("component <> c and hub <> l and hub <> rep")
            found.confirm(pairs.select(F.least("l", "rep").alias("l"), F.greatest("l", "rep").alias("r")).distinct())
            rest = found.open_buckets()
            if not rest.isEmpty():
                found.settle(rest)
    placed = classes.select("n", "a", "b", "rep").join(found.nodes.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.select("n", "a", "b", F.coalesce("component", "rep").alias("component"))
    rows = digests.select("doc_id", "n", "a", "b").join(placed, ["n", "a", "b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and those without an id, with all columns."""
    kept = near_duplicates(docs, size, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))
