"""Training texts that contain test items: BM25 search of an index of the items, then overlap of question and answer.

The index is inverted: for each term its items, in blocks, with each item's share of its own full score. Every passage of
every training text is a query, and all items at or above the threshold are wanted, so the bounds of block-max WAND need
no heap and are taken for many passages at once: the sum of the terms' largest shares rules out passages, the sums of
their largest shares within a block rule out blocks, and only the postings of blocks that are left are read and added up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.llm.blocks import LEAN_BYTES, WORD_BASE, Block, Rolling, blocks, lower_ascii, words_of

K1, B = 1.2, 0.75
#: Share of an item's own score from which a passage is looked at, and share of its 5-grams that confirms it.
THRESHOLD, OVERLAP, GRAM = 0.5, 0.8, 5
#: Items per block of a posting list.
ITEM_BLOCK = 16
#: Bytes of items in one index, which is sent to every executor; more items are searched in several passes.
INDEX_BYTES = 32 << 20
#: Cells of the largest matrix of passages by blocks of items.
MATRIX_CELLS = 4_000_000


def parts(text: str) -> tuple[str, str]:
    """Question and answer of an item: all but the last sentence, and the last; a part with under 5 words joins the other."""
    cut = max((m.end() for m in re.finditer(r"[.!?]\s+(?=\S)", text)), default=0)
    halves = text[:cut], text[cut:]
    if min(len(re.findall(r"\w+", h)) for h in halves) < GRAM:
        return text, ""
    return halves


def _plain(text: str) -> np.ndarray:
    block = next(blocks(pa.array([text])))
    return words_of(block, lower_ascii(block.data), plain=True).ids


def _grams(ids: np.ndarray) -> np.ndarray:
    """Distinct 5-grams; fewer words are one gram."""
    if not len(ids):
        return np.zeros(0, np.uint64)
    return np.unique(Rolling(ids, WORD_BASE).windows(min(GRAM, len(ids))))


@dataclass
class Index:
    """Terms in order; per term a range of postings (item, share) and of block maxima (block, share), and its largest share."""

    items: list
    terms: np.ndarray
    bounds: np.ndarray
    posting_item: np.ndarray
    posting_share: np.ndarray
    block_bounds: np.ndarray
    block_id: np.ndarray
    block_share: np.ndarray
    largest: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray, int]]
    longest: int
    #: Each item's terms and shares, and the questions of items with two parts as entries of their own (items are places).
    own: list[tuple[np.ndarray, np.ndarray]]
    questions: Index | None = None


def _index(items: list, words: list[np.ndarray], known: np.ndarray, idf: np.ndarray, mean: float, grams: list, longest: int) -> Index:
    """The index of items of these words; ``idf`` belongs to the terms ``known``."""
    n = len(words)
    length = np.array([len(ids) for ids in words])
    item = np.repeat(np.arange(n), length)
    terms, term = np.unique(np.concatenate(words), return_inverse=True)
    pair, tf = np.unique(term.astype(np.int64) * n + item, return_counts=True)
    term, item = pair // n, pair % n
    df = np.bincount(term)
    weight = idf[np.searchsorted(known, terms)][term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / mean))
    share = weight / np.bincount(item, weight, minlength=n)[item]
    of_block = pair // n * (n // ITEM_BLOCK + 1) + item // ITEM_BLOCK
    first = np.flatnonzero(np.concatenate(([True], of_block[1:] != of_block[:-1])))
    by_item = np.argsort(item, kind="stable")
    cuts = np.cumsum(np.bincount(item, minlength=n))[:-1]
    return Index(
        items, terms, np.append(0, np.cumsum(df)), item, share,
        np.searchsorted(term[first], np.arange(len(terms) + 1)), item[first] // ITEM_BLOCK, np.maximum.reduceat(share, first),
        np.maximum.reduceat(share, np.append(0, np.cumsum(df))[:-1]), grams, longest,
        list(zip(np.split(terms[term[by_item]], cuts), np.split(share[by_item], cuts), strict=True)),
    )


@dataclass(frozen=True)
class Statistics:
    """Of a whole benchmark: items with a word, their mean and greatest number of words, and items by term."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


def statistics_of(words: list[np.ndarray]) -> Statistics:
    terms, df = np.unique(np.concatenate([np.unique(ids) for ids in words]), return_counts=True)
    sizes = [len(ids) for ids in words]
    return Statistics(len(words), float(np.mean(sizes)), max(sizes), terms, df)


def build_index(rows: list[tuple[object, str]], whole: Statistics | None = None) -> Index | None:
    """The index of (item_id, text) rows; items without a word are left out. None if there is no item.

    ``whole`` describes the benchmark that the rows are a part of, and knows all their terms; by default they are all of it.
    """
    rows = [(i, t, ids) for i, t, ids in ((i, t or "", _plain(t or "")) for i, t in rows) if len(ids)]
    if not rows:
        return None
    words = [ids for _, _, ids in rows]
    whole = whole or statistics_of(words)
    known, mean, longest = whole.terms, whole.mean, whole.longest
    idf = np.log1p((whole.items - whole.df + 0.5) / (whole.df + 0.5))
    halves = [tuple(_plain(h) for h in parts(t)) for _, t, _ in rows]
    grams = [(_grams(q), _grams(a), min(GRAM, len(ids))) for (q, a), ids in zip(halves, words, strict=True)]
    index = _index([i for i, _, _ in rows], words, known, idf, mean, grams, longest)
    two = [k for k, (_, a) in enumerate(halves) if len(a)]
    if two:
        index.questions = _index(two, [halves[k][0] for k in two], known, idf, mean, [grams[k] for k in two], longest)
    return index


def _expand(bounds: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the terms, and for each the row of ``term`` that it comes from."""
    size = bounds[term + 1] - bounds[term]
    row = np.repeat(np.arange(len(term)), size)
    return np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + bounds[term][row], row


def search(index: Index, ids: np.ndarray, bounds: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, int, int, float]]:
    """(document row, first word, last word + 1, item, score) of all passages at or above the threshold.

    Passages are twice as long as the longest item and overlap by half, so each stretch of an item's length is whole in one.
    """
    step = index.longest
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(-(-n // step) - 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = bounds[doc] + nth * step
    end = np.minimum(begin + 2 * step, bounds[doc + 1])
    place = np.searchsorted(index.terms, ids)
    place[place == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[place] == ids)
    if not len(hit):
        return []
    low, high = np.searchsorted(hit, begin), np.searchsorted(hit, end)
    row = np.repeat(np.arange(len(doc)), high - low)
    spot = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[row]
    pair = np.unique(row * len(index.terms) + place[hit[spot]])
    row, term = pair // len(index.terms), pair % len(index.terms)
    slack = threshold - 1e-9
    bound = np.bincount(row, index.largest[term], minlength=len(doc))
    left = bound[row] >= slack
    row, term = row[left], term[left]
    if not len(row):
        return []
    names, row = np.unique(row, return_inverse=True)  # passages that are left
    n_blocks = len(index.items) // ITEM_BLOCK + 1
    found = []
    at_once = max(1, MATRIX_CELLS // n_blocks)
    for first in range(0, len(names), at_once):
        lo, hi = np.searchsorted(row, (first, first + at_once))
        for passage, item, score in _best_items(index, row[lo:hi] - first, term[lo:hi], min(at_once, len(names) - first), n_blocks, slack):
            at = names[first + passage]
            found.append((int(doc[at]), int(begin[at]), int(end[at]), item, score))
    return found


def _best_items(index: Index, row: np.ndarray, term: np.ndarray, rows: int, n_blocks: int, slack: float) -> Iterator[tuple[int, int, float]]:
    """(passage, item, score) at or above the threshold; only blocks of items whose bound reaches it are scored."""
    at, of = _expand(index.block_bounds, term)
    bound = np.bincount(row[of] * n_blocks + index.block_id[at], index.block_share[at], minlength=rows * n_blocks)
    opened = bound >= slack
    some = opened.reshape(-1, n_blocks).any(axis=1)[row]
    row, term = row[some], term[some]
    at, of = _expand(index.bounds, term)
    item = index.posting_item[at]
    inside = opened[row[of] * n_blocks + item // ITEM_BLOCK]
    key, where = np.unique(row[of][inside] * len(index.items) + item[inside], return_inverse=True)
    score = np.bincount(where, index.posting_share[at][inside], minlength=len(key))
    best = np.flatnonzero(score >= slack)
    yield from zip((key[best] // len(index.items)).tolist(), (key[best] % len(index.items)).tolist(), score[best].tolist(), strict=True)


def _overlap(part: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(part, there).mean()) if len(part) else 0.0


def _candidates(index: Index, ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Passages that hold enough of an item, or of its question alone, each with the whole item's score."""
    found = search(index, ids, bounds)
    if index.questions is not None:
        have = {x[:4] for x in found}
        for doc, a, b, k, _ in search(index.questions, ids, bounds):
            item = index.questions.items[k]
            if (doc, a, b, item) not in have:
                terms, share = index.own[item]
                found.append((doc, a, b, item, float(share[np.isin(terms, ids[a:b])].sum())))
    return found


def leaks(index: Index, block: Block) -> list[tuple[int, int, float, float, float]]:
    """(document row, item, score, question overlap, answer overlap) of confirmed items, the best passage for each."""
    words = words_of(block, lower_ascii(block.data), plain=True)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    roll = Rolling(words.ids, WORD_BASE)
    windows: dict[int, np.ndarray] = {}
    for doc, a, b, item, score in _candidates(index, words.ids, words.bounds):
        question, answer, size = index.grams[item]
        if size not in windows:
            windows[size] = roll.windows(size)
        there = windows[size][a : max(a, b - size + 1)]
        q, r = _overlap(question, there), _overlap(answer, there)
        whole = (q * len(question) + r * len(answer)) / (len(question) + len(answer))
        if max(q, whole) >= OVERLAP:
            best[doc, item] = max(best.get((doc, item), (0.0, 0.0, 0.0)), (score, q, r))
    return [(d, i, *found) for (d, i), found in sorted(best.items())]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each item with a word, its number of words and its distinct terms."""
    for batch in batches:
        ids = [_plain(t or "") for t in batch.column(0).to_pylist()]
        ids = [x for x in ids if len(x)]
        terms = pa.array([np.unique(x).view(np.int64) for x in ids], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in ids], pa.int64()), terms], names=["n", "terms"])


def indexes(benchmark: DataFrame, limit: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of at most about ``limit`` bytes of items each; items are dealt by a hash of their id and text.

    Weights follow from the whole benchmark, so the number of indexes changes no score. Items with a null id or text are
    passed over.
    """
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // limit))
    if groups == 1:
        index = build_index([tuple(r) for r in items.orderBy("item_id", "text").collect()])  # bounded by ``limit``
        if index is not None:
            yield index
        return
    described = materialise(items.select("text").mapInArrow(_described, "n bigint, terms array<bigint>"))
    whole = described.agg(F.count("*").alias("items"), F.avg("n").alias("mean"), F.max("n").alias("longest")).first()
    terms = materialise(described.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")))
    for g in range(groups):
        mine = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).orderBy("item_id", "text").collect()]
        used = [ids for ids in (_plain(t) for _, t in mine) if len(ids)]
        if not used:
            continue
        here = items.sparkSession.createDataFrame([(int(x),) for x in np.unique(np.concatenate(used)).view(np.int64)], "term bigint")
        known = terms.join(here, "term").toArrow()  # the terms of ``limit`` bytes of items
        term, df = known.column("term").to_numpy().view(np.uint64), known.column("df").to_numpy()
        order = np.argsort(term)
        yield build_index(mine, Statistics(whole["items"], whole["mean"], whole["longest"], term[order], df[order]))


def _report(index: Index, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), LEAN_BYTES):
                found = leaks(index, block)
                if found:
                    d, i, s, q, a = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([block.first + x for x in d])), pa.array([index.items[x] for x in i], kind),
                         pa.array(s), pa.array(q), pa.array(a)],
                        names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                    )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """One row per text and test item in it: doc_id, item_id, score (of the item's own), question and answer overlap.

    A text contains an item if one of its passages scores ``THRESHOLD`` or more, of the item or of its question alone, and
    holds ``OVERLAP`` or more of the 5-grams of the item's question, or of question and answer together (letters A-Z in
    lower case, punctuation aside).
    Null and empty texts and items contain nothing; each row is searched on its own, rows without an id included. More
    than ``index_bytes`` of items are searched in several passes, with the same result.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind, item = docs.schema[id_col].dataType.simpleString(), benchmark.schema["item_id"].dataType
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {kind}, item_id {item.simpleString()}, score double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark, index_bytes):
        found = texts.mapInArrow(_report(index, to_arrow_type(item)), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _without(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for block in blocks(batch.column(batch.schema.get_field_index("text")), LEAN_BYTES):
                keep[[block.first + d for d, *_ in leaks(index, block)]] = False
            yield batch.filter(pa.array(keep))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with their columns as they were; null and empty texts stay."""
    for index in indexes(benchmark):
        docs = docs.mapInArrow(_without(index), docs.schema)
    return docs
