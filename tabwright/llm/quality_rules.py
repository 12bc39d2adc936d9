"""Quality rules whose limits come from the data: quantile sketches per language and source, joined back as fences.

A sketch counts values in bins that grow by a hundredth; sketches of groups are merged by adding their counts, and every run
gives the same ones. Only DataFrame functions: arrays of words inside each row give the measures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise

#: What parts words, which characters count as symbols, and the base limits.
SPACE, SYMBOLS = r"[ \x09-\x0D]+", "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30


@dataclass(frozen=True)
class Fence:
    """A measure in thousandths is out of bounds above its group's HIGH quantile + ``reach`` * (HIGH - median) + ``slack``.

    ``below``: also as far below the LOW quantile. ``slack`` is what a document may have where nearly all others have
    nothing; ``most`` keeps the limit of a share below the whole.
    """

    name: str
    reach: float
    slack: int
    below: bool = False
    most: int | None = None


#: Quantiles of a group's own sketch; up to a twelfth of a source may be junk without moving its limits.
LOW, MIDDLE, HIGH = 0.08, 0.5, 0.92
FENCES = (
    Fence("symbols_per_word", 2.0, 20),
    Fence("shouts_per_word", 2.0, 20),
    Fence("dup_line_share", 2.0, 300, most=950),
    Fence("chars_per_word", 2.0, 100, below=True),
)
#: Growth of the bins of a sketch.
GROWTH = 1.01
#: Groups with fewer documents use the merged sketch of their language, and if that has fewer too, the one of all.
LEAST_GROUP = 200


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body is evaluated for each element of an array."""
    return F.transform(F.array(value), body)[0]


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _count(text: Column, characters: str) -> Column:
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c))
    return (F.length(text) - F.length(rest)).cast("long")


def _covered(windows: Column) -> Column:
    """Words under windows whose hash occurs twice or more: sort (hash, place), keep equal neighbours, join the ranges."""

    def repeated(ordered: Column) -> Column:
        hashes = lambda i: F.element_at(ordered, i)["hash"]
        last = F.size(ordered) - 1
        same = lambda x, i: ((i > 0) & (hashes(F.greatest(i, F.lit(1))) == x["hash"])) | (
            (i < last) & (hashes(F.least(i + 2, last + 1)) == x["hash"])
        )
        places = F.transform(ordered, lambda x, i: F.when(same(x, i), x["place"]))
        return F.sort_array(F.filter(places, lambda p: p.isNotNull()))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        let(ordered, repeated),
        start,
        lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n")
        ),
        lambda a: a["n"],
    )


def _windows(hashes: Column) -> Column:
    """Hash of each run of eight words: of two runs of four, each of two pairs."""

    def doubled(h: Column, step: int) -> Column:
        n = F.size(h) - step
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))

    return let(let(let(hashes, lambda h: doubled(h, 1)), lambda h: doubled(h, 2)), lambda h: doubled(h, 4))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts of every whole text, with its language and source (null where there is no such column)."""
    extra = [(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")]
    texts = docs.select(F.col(id_col).alias("doc_id"), *extra, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words = texts.withColumn("words", _split(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    hashed = words.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).alias("n_symbols"),
        _count(F.col("text"), "!").alias("n_shouts"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        F.when(
            F.size("words") >= WINDOW,
            let(
                _windows(F.transform("words", lambda w: F.xxhash64(w))),
                lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w)),
            ),
        )
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
    )
    return hashed


def _with_ratios(counts: DataFrame) -> DataFrame:
    """Measures in thousandths; all 0 where there is no word."""
    over = lambda top, below: F.coalesce((F.col(top) * 1000 / F.nullif(F.col(below), F.lit(0))).cast("long"), F.lit(0).cast("long"))
    return counts.select(
        "*",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
        over("n_symbols", "n_words").alias("symbols_per_word"),
        over("n_shouts", "n_words").alias("shouts_per_word"),
        over("n_dup_lines", "n_lines").alias("dup_line_share"),
        over("word_chars", "n_words").alias("chars_per_word"),
    )


def _bin(value: Column) -> Column:
    return F.when(value <= 0, F.lit(0)).otherwise(F.ceil(F.log(value) / F.log(F.lit(GROWTH))) + 1).cast("int")


def _top(bin_: Column) -> Column:
    """The largest whole number of a bin."""
    return F.when(bin_ <= 0, F.lit(0.0)).otherwise(F.floor(F.pow(F.lit(GROWTH), bin_ - 1) + 1e-9).cast("double"))


def sketches(measured: DataFrame) -> DataFrame:
    """One mergeable sketch of each measure per language and source: rows (lang, source, measure, bin, n)."""
    values = F.explode(F.array(*[F.struct(F.lit(f.name).alias("measure"), _bin(F.col(f.name)).alias("bin")) for f in FENCES]))
    return measured.select("lang", "source", values.alias("v")).groupBy("lang", "source", "v.measure", "v.bin").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, measure, n, low, middle, high) of the sketches merged by the keys."""
    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*keys, "measure")  # about a thousand bins
    upto, total = F.sum("n").over(own.orderBy("bin")), F.sum("n").over(own)
    ranked = merged.select(*keys, "measure", "bin", upto.alias("upto"), total.alias("total"))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bin"))) for q in (LOW, MIDDLE, HIGH)]
    return ranked.groupBy(*keys, "measure").agg(F.max("total").alias("n"), *[_top(b).alias(c) for b, c in zip(at, ("low", "middle", "high"), strict=True)])


def fences(sketch: DataFrame) -> DataFrame:
    """Limits per language and source: small groups take the merged sketch of their language or of all."""
    group, lang, every = (_quantiles(sketch, *keys).alias(a) for a, keys in (("g", ("lang", "source")), ("l", ("lang",)), ("e", ())))
    same = (F.col("g.measure") == F.col("l.measure")) & F.col("g.lang").eqNullSafe(F.col("l.lang"))
    wide = group.join(lang, same).join(F.broadcast(every), F.col("g.measure") == F.col("e.measure"))  # one row per measure
    large = [F.col(f"{a}.n") >= LEAST_GROUP for a in "gl"]
    of = lambda c: F.when(large[0], F.col(f"g.{c}")).when(large[1], F.col(f"l.{c}")).otherwise(F.col(f"e.{c}")).alias(c)
    chosen = wide.select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("g.measure").alias("measure"), *map(of, ("low", "middle", "high")))
    out = []
    for f in FENCES:
        mine = F.col("measure") == f.name
        most = F.col("high") + f.reach * (F.col("high") - F.col("middle")) + f.slack
        if f.most is not None:
            most = F.least(most, F.lit(float(f.most)))
        out.append(F.max(F.when(mine, most)).alias(f"{f.name}_most"))
        if f.below:
            out.append(F.max(F.when(mine, F.col("low") - f.reach * (F.col("middle") - F.col("low")) - f.slack)).alias(f"{f.name}_least"))
    return chosen.groupBy("lang", "source").agg(*out)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, ``base_failed``, and ``kept``: base passed and every measure within its fence.

    A null or empty text has counts 0 and fails the base rule. A null language or source is a group of its own; repeated
    rows are judged each; other columns are not read. Counts are written once, so texts are read once. Every run and every
    partitioning gives the same rows.
    """
    measured = materialise(_with_ratios(measures(docs, id_col, text_col)))
    limits = fences(materialise(sketches(measured))).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    within = F.lit(True)
    for f in FENCES:
        within &= F.col(f.name) <= F.coalesce(F.col(f"{f.name}_most"), F.lit(float("inf")))
        if f.below:
            within &= F.col(f.name) >= F.coalesce(F.col(f"{f.name}_least"), F.lit(float("-inf")))
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left"
    )
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & within).alias("kept"),
        *(f.name for f in FENCES),
    )
