"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort, where a partition's size is a count.

1. One pass counts words and, per routing cell, suffixes. Words that are too rare for any
   phrase end a suffix from here on; a map of bits, by hash, tells them (a rare word that shares a bit stays: no harm).
2. A second pass cuts every suffix at the greatest depth (three words), adds up equal ones inside a chunk, and sends them by
   their first two words to buckets of bounded size. A cell that holds more than its share (a hot pair of words) is dealt
   by three words instead.
3. In a bucket, pointers to suffixes are partitioned by one word at a time: smaller, equal, larger. An equal partition goes
   on with the next word; its size is the count of the phrase so far. Partitions with fewer occurrences than a phrase
   needs are abandoned: all suffixes that begin with the phrase are there.
4. Counts of a phrase and of its parts meet in joins; what a longer phrase explains is dropped; the best of each language
   are ranked.

Suffixes travel as short hashes of their words. These name words exactly: the first pass knows all words, and those whose
hash is also that of a frequent word get numbers of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted
from tabwright.functions.stage import materialise
from tabwright.llm.blocks import Block, batches_of, blocks, content_ids, lower_ascii, mix

#: Words of the longest phrase.
DEPTH = 3
#: Bytes of text that are counted at once, and whose suffixes a bucket holds on average.
CHUNK_BYTES, BUCKET_BYTES = 3 << 20, 6 << 20
#: Rows of texts that Spark hands over at once.
BATCH_ROWS = 1000
#: More buckets than this share partitions, one after the other.
MOST_PARTITIONS = 20_000
#: Rows of counted words that a task adds up before it hands them on.
HELD_WORDS = 1_000_000
#: Routing cells for each bucket; a cell with more suffixes than a whole bucket's share is split by the third word.
CELLS = 16
#: log2 of the bits of the map of frequent words (2 MB).
MAP_BITS = 24
#: Bytes of a word in a suffix, the first of which is above 127 in numbers that stand for no hash, and the wide form for
#: vocabularies in which too many short hashes would meet.
NARROW, WIDE = 6, 8
MOST_CLASHES = 10_000
#: What ends a piece, and what parts words inside it.
BREAKS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

_SOLID = np.ones(256, np.uint8)
_SOLID[list(GAPS)] = 0
_SOLID[list(BREAKS)] = 2  # not part of a word, and ends the piece


class Chunk:
    """Words of some documents as numbers: equal numbers are equal words of one language."""

    def __init__(self, block: Block, langs: pa.Array):
        data = lower_ascii(block.data)
        kind = _SOLID[data]
        solid = kind == 1
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        heads = block.bounds[:-1][block.bounds[:-1] < len(data)]
        begin[heads] = solid[heads]
        starts = np.flatnonzero(begin)
        n = len(starts)
        last = np.append(~solid[1:] | begin[1:], True) & solid if len(data) else solid
        offsets = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - starts))
        every = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[solid].tobytes())])
        forms = every.dictionary_encode()
        lang = langs.dictionary_encode()
        doc = np.searchsorted(block.bounds, starts, side="right") - 1
        of_word = lang.indices.to_numpy(zero_copy_only=False)[doc].astype(np.int64)
        size = max(len(forms.dictionary), 1)
        both = pa.array(of_word * size + forms.indices.to_numpy(zero_copy_only=False)).dictionary_encode()
        keys = both.dictionary.to_numpy(zero_copy_only=False)
        #: For each distinct word: its language, its text, and a hash of both that is the same in all chunks.
        self.langs = lang.dictionary.take(pa.array(keys // size))
        self.forms = forms.dictionary.take(pa.array(keys % size)).cast(pa.binary()).cast(pa.string())
        self.marks = mix(_marks(forms.dictionary)[keys % size] + _marks(lang.dictionary.cast(pa.large_binary()))[keys // size] * np.uint64(3))
        self.words = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # the piece that a word belongs to: pieces end at break characters and with the document
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + doc
        self.follows = np.append(piece[1:] == piece[:-1], False) if n else np.zeros(0, bool)

    def counts(self) -> np.ndarray:
        return np.bincount(self.words, minlength=len(self.forms))

    def cells(self, cells: int) -> np.ndarray:
        """The routing cell of every suffix of two words or more."""
        first = np.flatnonzero(self.follows)
        return _cells(self.marks, np.stack([self.words[first], self.words[np.minimum(first + 1, max(len(self.words) - 1, 0))]], axis=1), cells)

    def suffixes(self, often: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct suffixes of two words or three (rows of three numbers, the third -1 where there is none), and counts.

        With a map of frequent words, a suffix ends before a word that is not in it.
        """
        w = self.words
        if not len(w):
            return np.zeros((0, DEPTH), np.int64), np.zeros(0, np.int64)
        known = np.ones(len(w), bool) if often is None else _is_set(often, self.marks)[w]
        joined = self.follows & known & np.append(known[1:], False)
        first = np.flatnonzero(joined)
        third = np.where(joined[np.minimum(first + 1, len(w) - 1)], w[np.minimum(first + 2, len(w) - 1)], -1)
        size = len(self.forms) + 1
        pairs = pa.array(w[first] * size + w[np.minimum(first + 1, len(w) - 1)]).dictionary_encode()
        triples = pa.array(pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * size + third + 1).dictionary_encode()
        keys = triples.dictionary.to_numpy(zero_copy_only=False)
        n = np.bincount(triples.indices.to_numpy(zero_copy_only=False), minlength=len(keys))
        lead = pairs.dictionary.to_numpy(zero_copy_only=False)[keys // size]
        return np.stack([lead // size, lead % size, keys % size - 1], axis=1), n


def _marks(values: pa.Array) -> np.ndarray:
    """Hashes of binary values."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    raw = values.buffers()[2] if len(values) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return content_ids(data, offsets[:-1], offsets[1:])


def _is_set(bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _cells(marks: np.ndarray, suffixes: np.ndarray, cells: int) -> np.ndarray:
    """The routing cell of each suffix's first two words."""
    if not len(suffixes):
        return np.zeros(0, np.int64)
    lead = mix(marks[suffixes[:, 0]] * np.uint64(0x9E3779B97F4A7C15) + marks[suffixes[:, 1]])
    return (lead % np.uint64(cells)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    for batch in batches:
        for block in blocks(batch.column(1), size):
            yield Chunk(block, batch.column(0).slice(block.first, block.last - block.first))


def _count(cells: int, size: int):
    """Counts of words with their hash, and numbers of suffixes per cell (language and word null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for chunk in _chunks(batches, size):
            held.append(pa.table([chunk.langs, chunk.forms, pa.array(chunk.marks.view(np.int64)), pa.array(chunk.counts())], names=["lang", "word", "mark", "n"]))
            rows += len(chunk.forms)
            cell = pa.array(chunk.cells(cells)).dictionary_encode()
            used, n = cell.dictionary, np.bincount(cell.indices.to_numpy(zero_copy_only=False), minlength=len(cell.dictionary))
            none = pa.nulls(len(used), pa.string())
            yield pa.RecordBatch.from_arrays([none, none, used, pa.array(n.astype(np.int64))], names=["lang", "word", "mark", "n"])
            if rows > HELD_WORDS:
                yield from _added_up(held)
                held, rows = [], 0
        if held:
            yield from _added_up(held)

    return run


def _added_up(tables: list[pa.Table]) -> list[pa.RecordBatch]:
    sums = pa.concat_tables(tables).group_by(["lang", "word", "mark"], use_threads=False).aggregate([("n", "sum")])
    return sums.rename_columns(["lang", "word", "mark", "n"]).to_batches(max_chunksize=100_000)


@dataclass(frozen=True)
class Names:
    """How words are named in suffixes: the first bits of their hash, or a number where that is not theirs alone."""

    width: int
    own: dict[tuple[str, str], int]
    clashing: np.ndarray

    def of(self, chunk: Chunk) -> np.ndarray:
        out = chunk.marks >> np.uint64(65 - 8 * self.width)
        for i in np.flatnonzero(np.isin(out, self.clashing)).tolist() if len(self.clashing) else ():
            number = self.own.get((chunk.langs[i].as_py(), chunk.forms[i].as_py()))
            out[i] = out[i] if number is None else number
        return out

    @property
    def column(self) -> Column:
        """The same of a table with a column ``mark``, but for words with a number."""
        return F.shiftrightunsigned("mark", 65 - 8 * self.width)

    def numbered(self, nth: int) -> int:
        return (1 << 8 * self.width - 1) + nth


def _names(words: DataFrame, least: int) -> tuple[Names, DataFrame]:
    """Names of all words, and a table (name, lang, word) of the frequent ones."""
    often = words.where(F.col("n") >= least)
    size = words.agg(F.count("*"), F.count_if(F.col("n") >= least)).first()
    names = Names(NARROW if size[0] * size[1] < MOST_CLASHES << 8 * NARROW - 1 else WIDE, {}, np.zeros(0, np.uint64))
    every = words.withColumn("name", names.column)
    shared = every.groupBy("name").agg(F.count("*").alias("k"), F.max("n").alias("most")).where((F.col("k") > 1) & (F.col("most") >= least))
    clashes = every.join(shared.select("name"), "name").select("lang", "word", "name").collect()  # about MOST_CLASHES at most
    own = {(r.lang, r.word): names.numbered(i) for i, r in enumerate(sorted(clashes))}
    names = Names(names.width, own, np.unique(np.array([r.name for r in clashes], np.int64)).view(np.uint64))
    table = often.select(names.column.alias("name"), "lang", "word")
    if own:
        kind = "lang string, word string, number long"
        numbers = words.sparkSession.createDataFrame([(*w, n - (1 << 64) if n >> 63 else n) for w, n in own.items()], kind)
        table = table.join(numbers, ["lang", "word"], "left").select(F.coalesce("number", "name").alias("name"), "lang", "word")
    return names, materialise(table)


def _route(cells: int, split: np.ndarray, often: np.ndarray, names: Names, size: int):
    """Suffixes of a chunk packed by bucket."""
    buckets = cells // CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, size):
            suffixes, n = chunk.suffixes(often)
            if not len(n):
                continue
            cell = _cells(chunk.marks, suffixes, cells)
            third = mix(np.append(chunk.marks, np.uint64(7))[suffixes[:, 2]] + cell.astype(np.uint64))
            partial = np.isin(cell, split)
            bucket = np.where(partial, (third % np.uint64(buckets)).astype(np.int64), cell // CELLS) * 2 + partial
            order = np.lexsort((suffixes[:, 1], suffixes[:, 0], bucket))  # equal words side by side, which compresses
            words = np.append(names.of(chunk), np.uint64((1 << 8 * names.width) - 1))[suffixes[order]]
            n, bucket = n[order], bucket[order]
            kinds, first = np.unique(bucket, return_index=True)
            bounds = np.append(first, len(bucket))
            packed = [_packed(words[a:b], n[a:b], names.width) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds // 2), pa.array((kinds % 2).astype(bool)), pa.array(packed, pa.binary())], names=["bucket", "partial", "rows"]
            )

    return run


def _packed(words: np.ndarray, n: np.ndarray, width: int) -> bytes:
    """Names column by column in ``width`` bytes, then counts in as few bytes as the largest needs; that number comes first."""
    kind = np.min_scalar_type(int(n.max()))
    names = np.ascontiguousarray(words.T, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([kind.itemsize]) + names.tobytes() + n.astype(kind).tobytes()


def _unpacked(raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    size = (len(raw) - 1) // (DEPTH * width + raw[0])
    names = np.zeros((DEPTH * size, 8), np.uint8)
    names[:, :width] = np.frombuffer(raw, np.uint8, DEPTH * width * size, 1).reshape(-1, width)
    words = names.view("<u8").reshape(DEPTH, size).T.astype(np.uint64)
    words[words == np.uint64((1 << 8 * width) - 1)] = np.uint64((1 << 64) - 1)  # none: -1 as a signed number
    return words.view(np.int64), np.frombuffer(raw, f"<u{raw[0]}", size, 1 + DEPTH * width * size).astype(np.int64)


def frequent(symbols: np.ndarray, weight: np.ndarray, least: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Multikey quicksort of all suffixes at once: for each length from two words, a suffix of each kept phrase and its count.

    ``symbols`` has a row per suffix (-1: ended); ``least[d]`` is the weight below which a partition that is to be parted
    by word d is abandoned. Every round parts all open partitions by the median of three of their symbols at that word.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(1, symbols.shape[1])]
    pointers = np.arange(len(symbols))
    part = np.zeros(len(symbols), np.int64)  # partitions are numbered from 0 and each is one run of pointers
    depth = np.zeros(1, np.int64)
    flat, width = np.ascontiguousarray(symbols).ravel(), symbols.shape[1]
    floor = np.array([*least, 0], np.int64)
    while len(pointers):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        last = np.append(first[1:], len(part)) - 1
        key = flat[pointers * width + depth[part]]
        probes = np.sort(np.stack([key[first], key[(first + last) // 2], key[last]]), axis=0)
        pivot = probes[1][part]
        kept_pointers, kept_parts, kept_depths, begun = [], [], [], 0
        for side, chosen in enumerate((key < pivot, key == pivot, key > pivot)):
            at = np.flatnonzero(chosen)
            if not len(at):
                continue
            mine = part[at]
            size = np.bincount(mine, weight[pointers[at]], minlength=len(depth)).astype(np.int64)
            deep = depth + (side == 1)
            if side == 1:
                ended = np.zeros(len(depth), bool)
                ended[part[first]] = probes[1] < 0
                for words in range(2, width + 1):
                    found = np.flatnonzero((deep == words) & ~ended & (size >= floor[words - 1]) & (size > 0))
                    if len(found):
                        one = np.zeros(len(depth), np.int64)
                        one[mine] = pointers[at]
                        out[words - 2] = tuple(np.append(a, b) for a, b in zip(out[words - 2], (one[found], size[found]), strict=True))
                size[ended | (deep >= width)] = 0
            go = (size > 0) & (size >= floor[deep])
            at = at[go[mine]]
            if not len(at):
                continue
            numbers = np.cumsum(go) - 1 + begun
            kept_pointers.append(pointers[at])
            kept_parts.append(numbers[part[at]])
            kept_depths.append(deep[go])
            begun += int(go.sum())
        if not kept_pointers:
            break
        pointers, part, depth = np.concatenate(kept_pointers), np.concatenate(kept_parts), np.concatenate(kept_depths)
    return out


def _sort(least: int, width: int):
    """Frequent phrases of a bucket, by the names of their words; of a partial one all pairs, whose counts are added up later."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = [_unpacked(r.as_py(), width) for r in table.column("rows")]
        symbols, weight = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
        del rows
        # equal numbers for equal names, and -1 for none
        codes = pa.array(symbols.ravel()).dictionary_encode()
        known = codes.dictionary.to_numpy(zero_copy_only=False)
        number = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, DEPTH)
        number[symbols == -1] = -1
        floors = (1, 1, least) if key[1].as_py() else (least,) * DEPTH
        columns: list[list] = [[] for _ in range(DEPTH + 1)]
        for length, (one, n) in enumerate(frequent(number, weight, floors), start=2):
            chosen = number[one]
            for i in range(DEPTH):
                columns[i].append(pa.array(known[chosen[:, i]]) if i < length else pa.nulls(len(one), pa.int64()))
            columns[-1].append(pa.array(n))
        return pa.table([pa.chunked_array(c, pa.int64()) for c in columns], names=["m1", "m2", "m3", "n"])

    return run


def phrase_counts(docs: DataFrame, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, n), all of them, and phrases (lang, w1, w2, w3, n) of two or three words with ``least`` or more."""
    texts = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"), quoted(text_col).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = CELLS * max(1, -(-total // BUCKET_BYTES))
    counted = texts.mapInArrow(_count(cells, CHUNK_BYTES), "lang string, word string, mark long, n long")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        counted = materialise(counted.groupBy("lang", "word", "mark").agg(F.sum("n").alias("n")))
    words = counted.where("word is not null")
    # a cell's share is a sixteenth of a bucket; a bucket's suffixes are fewer than half its bytes
    crowded = counted.where(F.col("word").isNull() & (F.col("n") > BUCKET_BYTES // 8)).select("mark")
    split = np.array([r.mark for r in crowded.collect()], np.int64)  # at most four for each bucket
    names, table = _names(words, least)
    routed = _route(cells, split, _map_of(words.where(F.col("n") >= least)), names, CHUNK_BYTES)
    packed = texts.mapInArrow(routed, "bucket long, partial boolean, rows binary")
    packed = packed.repartition(min(cells // CELLS, MOST_PARTITIONS), "bucket", "partial")
    found = packed.groupBy("bucket", "partial").applyInArrow(_sort(least, names.width), "m1 long, m2 long, m3 long, n long")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        found = materialise(found)
    pairs = found.where("m3 is null").groupBy("m1", "m2").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    every = pairs.select("m1", "m2", F.lit(None).cast("long").alias("m3"), "n").unionByName(found.where("m3 is not null"))
    word = lambda i: table.select(F.col("name").alias(f"m{i}"), F.col("word").alias(f"w{i}"), *(["lang"] if i == 1 else []))
    phrases = every.join(word(1), "m1").join(word(2), "m2").join(word(3), "m3", "left").select("lang", "w1", "w2", "w3", "n")
    return words.select("lang", "word", "n"), phrases


def _map_of(words: DataFrame) -> np.ndarray:
    """Bits at the hashes of the given words, in numbers of 64 bits."""
    at = F.shiftrightunsigned("mark", 64 - MAP_BITS)
    held = words.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(mark, {64 - MAP_BITS}) & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    rows = held.toArrow()  # at most as many rows as the map has numbers
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def collocations(
    docs: DataFrame, least: int = 10, top: int = 2000, explained: int = 50, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Phrases have two or three words and ``least`` or more occurrences inside pieces of text. The score is that of the
    lowest cut, 1000000 * a * a / (l * r) rounded down. A phrase goes if a longer one that holds it has ``explained``
    percent or more of its occurrences. A null language is ``und``, null and empty texts have no words, repeated rows
    count each, other columns are not read, an empty table gives no rows. Equal scores and counts go by phrase.
    """
    words, phrases = phrase_counts(docs, least, lang_col, text_col)
    often = words.where(F.col("n") >= least)
    phrases = materialise(phrases)
    longer = phrases.where("w3 is not null").select(
        "lang", "n", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p")
    )
    most = longer.groupBy("lang", "p.w1", "p.w2").agg(F.max("n").alias("within"))
    pairs = phrases.where("w3 is null").join(most, ["lang", "w1", "w2"], "left")
    free = pairs.where(F.col("within").isNull() | (F.col("within") * 100 < F.col("n") * explained))
    kept = phrases.where("w3 is not null").unionByName(free.select("lang", "w1", "w2", "w3", "n"))
    name = lambda *parts: F.concat_ws(" ", *parts)
    cuts = kept.select(
        "lang", name("w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
        F.explode(F.when(F.col("w3").isNull(), F.array(_cut(1, "w1", "w2"))).otherwise(
            F.array(_cut(1, "w1", name("w2", "w3")), _cut(2, name("w1", "w2"), "w3")))).alias("cut"),
    )
    parts = often.select("lang", F.col("word").alias("part"), "n").unionByName(phrases.where("w3 is null").select("lang", name("w1", "w2").alias("part"), "n"))
    parts = materialise(parts)
    left = parts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"))
    scored = cuts.select("lang", "phrase", "a", "cut.*").join(left, ["lang", "left"]).join(right, ["lang", "right"])
    # a, l and r below 10**15: the products have at most 36 digits
    score = F.expr("(1000000BD * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _cut(k: int, left, right):
    left, right = (F.col(x) if isinstance(x, str) else x for x in (left, right))
    return F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
