import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.operators import balance, neighbours, ranks, split
from tabwright.operators.balance import balanced_weights, smote
from tabwright.operators.ranks import range_edges, running_totals, with_range
from tabwright.operators.split import assign_folds, split_parts, stratified_split, train_quotas
from tabwright.operators.target import code_text, to_severity, unmapped_codes


def _classes(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows, key = [], 0
    for c, n in sizes.items():
        for _ in range(n):
            rows.append((key, int(c), *[float(x) for x in rng.normal(c, 1, 3)]))
            key += 1
    return spark.createDataFrame(rows, "id bigint, label int, a double, b double, c double")


def test_codes(spark):
    words = spark.createDataFrame([(c,) for c in ["MINOR", "MODERATE", "SEVERE", "UNKNOWN", "INVALID", None]], "code string")
    mapping = {"MINOR": 0, "MODERATE": 1, "SEVERE": 2, "UNKNOWN": 0}
    assert [r.code for r in to_severity(words, "code", mapping).collect()] == [0, 1, 2, 0, 0, 0]
    assert [r.code for r in to_severity(words, "code", mapping, -1).collect()] == [0, 1, 2, 0, -1, -1]
    assert {r.code: r.n for r in unmapped_codes(words, "code", mapping).collect()} == {"INVALID": 1, None: 1}
    numbers = spark.createDataFrame([(210.0,), (701.0,), (705.5,), (float("nan"),)], "code double")
    assert [r[0] for r in numbers.select(code_text(numbers, "code")).collect()] == ["210", "701", "705.5", None]
    assert [r.code for r in to_severity(numbers, "code").collect()] == [0, 1, 0, 0]


@pytest.mark.parametrize("gather,bits,cells", [(2000, 10, 100_000), (3, 2, 100_000), (2000, 10, 0), (3, 2, 0)])
def test_split_is_exact_and_stable(spark, monkeypatch, gather, bits, cells):
    monkeypatch.setattr(split, "GATHER_ROWS", gather)
    monkeypatch.setattr(split, "HELD_CELLS", cells)
    monkeypatch.setattr(split, "PREFIX_BITS", bits)
    df = _classes(spark, {0: 61, 1: 28, 2: 11})
    train, test = split_parts(df, "label", ["id"], 0.2)
    assert Counter(r.label for r in test.collect()) == {0: 12, 1: 6, 2: 2}
    ids = [r.id for r in train.collect()] + [r.id for r in test.collect()]
    assert sorted(ids) == list(range(100))
    shuffled = stratified_split(df.repartition(7), "label", ["id"], 0.2)
    assert {r.id for r in shuffled.where("is_test").collect()} == {r.id for r in test.collect()}
    other = stratified_split(df, "label", ["id"], 0.2, seed=1)
    assert {r.id for r in other.where("is_test").collect()} != {r.id for r in test.collect()}


def test_split_errors(spark):
    with pytest.raises(ValueError, match="at least 2 rows"):
        stratified_split(_classes(spark, {0: 9, 1: 1}), "label", ["id"])
    with pytest.raises(ValueError, match="one row per class"):
        stratified_split(_classes(spark, {0: 3, 1: 2, 2: 2}), "label", ["id"], 0.2)
    with pytest.raises(ValueError, match="between 0 and 1"):
        stratified_split(_classes(spark, {0: 3, 1: 2}), "label", ["id"], 1.0)


def test_quotas_sum_up(spark):
    for sizes in ({0: 33, 1: 33, 2: 34}, {0: 997, 1: 2, 2: 51}, {0: 5, 1: 5}):
        n = sum(sizes.values())
        table = spark.createDataFrame(list(sizes.items()), "c int, n bigint")
        quotas = {r.c: r.wanted[0] for r in train_quotas(table, 0.2).collect()}
        assert sum(quotas.values()) == n - math.ceil(n * 0.2)
        assert all(abs(quotas[c] - (n - math.ceil(n * 0.2)) * k / n) < 1 for c, k in sizes.items())


@pytest.mark.parametrize("broadcast,cells", [(100_000, 100_000), (100_000, 50), (3, 50)])
def test_many_classes(spark, monkeypatch, broadcast, cells):
    """Ends looked for by the driver, and in tables that are broadcast or not."""
    monkeypatch.setattr(split, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(split, "HELD_CELLS", cells)
    df = spark.range(3000).select("id", (F.col("id") % 600).alias("label"))
    test = Counter(r.label for r in stratified_split(df, "label", ["id"], 0.2).where("is_test").collect())
    assert test == {c: 1 for c in range(600)}
    with pytest.raises(ValueError, match="missing values"):
        stratified_split(df.withColumn("label", F.expr("nullif(label, 5)")), "label", ["id"])


def test_driver_and_tables_split_alike(spark, monkeypatch):
    df = spark.range(4000).select("id", (F.col("id") % 37 % 11).cast("string").alias("label"))
    made = []
    for cells in (100_000, 0):
        monkeypatch.setattr(split, "HELD_CELLS", cells)
        made.append((stratified_split(df, "label", ["id"], 0.27).where("is_test").select("id"), assign_folds(df, "label", ["id"], 6)))
    (one, folds), (two, other) = made
    assert {r.id for r in one.collect()} == {r.id for r in two.collect()}
    assert {tuple(r) for r in folds.collect()} == {tuple(r) for r in other.collect()}
    sizes = {f"{c}": sum(i % 37 % 11 == c for i in range(4000)) for c in range(11)}
    wanted = {r.c: list(r.wanted) for r in train_quotas(spark.createDataFrame(list(sizes.items()), "c string, n bigint"), 0.27).collect()}
    assert split.shared_quotas(sizes, 0.27) == wanted


@pytest.mark.parametrize("cells", [100_000, 0])
def test_a_key_that_repeats_is_an_error(spark, monkeypatch, cells):
    monkeypatch.setattr(split, "HELD_CELLS", cells)
    df = spark.range(5000).select((F.col("id") % 7).alias("id"), F.lit(1).alias("label"))
    with pytest.raises(ValueError, match="does not identify"):
        stratified_split(df, "label", ["id"], 0.2)
    monkeypatch.setattr(split, "GATHER_ROWS", 10)
    with pytest.raises(ValueError, match="does not identify"):
        stratified_split(df, "label", ["id"], 0.2)


@pytest.mark.parametrize("gather", [2000, 2])
def test_folds(spark, monkeypatch, gather):
    monkeypatch.setattr(split, "GATHER_ROWS", gather)
    df = _classes(spark, {0: 53, 1: 20, 2: 4})
    rows = assign_folds(df, "label", ["id"], 5).collect()
    for c, n in {0: 53, 1: 20, 2: 4}.items():
        sizes = Counter(r.fold for r in rows if r.label == c)
        assert sum(sizes.values()) == n and max(sizes.values()) - min([*sizes.values(), *([0] if n < 5 else [])]) <= 1
    assert {r.fold for r in rows} == set(range(5))
    with pytest.raises(ValueError):
        assign_folds(df, "label", ["id"], 1)


def test_text_keys_and_text_classes(spark):
    df = spark.range(100).select(F.concat(F.lit("k"), "id").alias("id"), F.when(F.col("id") < 30, "x").otherwise("y").alias("c"))
    test = stratified_split(df, "c", ["id"], 0.1).where("is_test")
    assert Counter(r.c for r in test.collect()) == {"x": 3, "y": 7}


def test_running_totals_equal_a_plain_window(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = sorted({(int(g), float(v)) for g, v in zip(rng.choice([0, 0, 0, 1, 2], 3000), rng.integers(0, 900, 3000))})
    df = spark.createDataFrame(rows, "g int, v double").withColumn("one", F.lit(1))
    edges = range_edges(df, "v", 100)
    assert len(edges) > 5
    ranges = {}
    for size in (64, 4):
        monkeypatch.setattr(ranks, "TREE_EDGES", size)
        ranges[size] = [(r.v, r.x) for r in with_range(df, "v", edges, "x").orderBy("v", "g").collect()]
    assert ranges[64] == ranges[4] == [(v, float(sum(e <= v for e in edges))) for v, _ in ranges[64]]
    for down in (False, True):
        holed = df.unionByName(df.limit(1).select("g", F.lit(None).cast("double").alias("v"), "one"))
        got = running_totals(holed.unionByName(df.limit(1).select("g", F.lit(float("nan")).alias("v"), "one")), ["g"], "v", ["one"], edges, down)
        order = F.col("v").desc() if down else F.col("v")
        want = df.withColumn("w", F.row_number().over(W.partitionBy("g").orderBy(order)))
        assert got.join(want, ["g", "v"]).where("cum_one <> w").count() == 0
        assert got.count() == len(rows)


def test_weights(spark):
    assert balanced_weights({0: 80, 1: 15, 2: 5}) == {0: 100 / 240, 1: 100 / 45, 2: 100 / 15}
    df = _classes(spark, {0: 80, 1: 15, 2: 5})
    total = balance.with_class_weights(df, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert all(abs(r.w - 100 / 3) < 1e-9 for r in total)


def _brute_neighbours(points, k):
    out = {}
    for i, v in points.items():
        others = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in points.items() if j != i)
        out[i] = others[:k]
    return out


@pytest.mark.parametrize("width,box,block", [(3, 40, 4000), (2, 25, 30), (8, 50, 64), (64, 60, 64)])
def test_nearest_points_equal_brute_force(spark, monkeypatch, width, box, block):
    """Many boxes, boxes of several blocks, and blocks copied for their visitors."""
    monkeypatch.setattr(neighbours, "BOX_POINTS", box)
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", min(block, 500))
    monkeypatch.setattr(neighbours, "VISITS_PER_COPY", 50)
    rng = np.random.default_rng(width)
    groups = {}
    rows = []
    for g, n in ((0, 700), (1, 60)):
        spots = np.unique(np.round(rng.normal(size=(n, width)) * 8) / 8, axis=0)  # exact sums, so ties are ties
        groups[g] = {g * 10_000 + i: tuple(map(float, v)) for i, v in enumerate(spots)}
        rows += [(g, i, list(v), [i], True) for i, v in groups[g].items()]
    schema = "grp int, point bigint, vector array<double>, ids array<bigint>, asked boolean"
    points = spark.createDataFrame(rows, schema).repartition(5)
    if width == 64:  # text ids, which order like the numbers here
        monkeypatch.setattr(neighbours, "TOUCH_CELLS", 5000)
        points = points.withColumn("point", F.lpad(F.col("point").cast("string"), 8, "0"))
    found = neighbours.nearest_points(points, 5).collect()
    got = {}
    for r in found:
        got.setdefault(int(r.point), []).append((r.dist, int(r.near)))
    want = {**_brute_neighbours(groups[0], 5), **_brute_neighbours(groups[1], 5)}
    assert set(got) == set(want)
    for i, near in want.items():
        assert [j for _, j in sorted(got[i])] == [j for _, j in near]


def _checked(spark, df, features, sizes):
    made = smote(df, features, "label", ["id"]).collect()
    top = max(sizes.values())
    assert Counter(r.label for r in made) == {c: top for c in sizes}
    assert len({r.row_key for r in made}) == len(made)
    real = {c: np.array([[r[f] for f in features] for r in made if r.label == c and not r.is_synthetic]) for c in sizes}
    for r in made:
        if r.is_synthetic:
            p = np.array([r[f] for f in features])
            assert _between_two(p, real[r.label])
    return made


def _between_two(p, rows):
    """Whether p lies on a segment between two rows (or on one)."""
    d = rows - p
    n = np.linalg.norm(d, axis=1)
    if n.min() < 1e-9:
        return True
    cosine = (d @ d.T) / np.outer(n, n)
    return cosine.min() < -1 + 1e-7


def test_smote_levels_the_classes(spark):
    sizes = {0: 50, 1: 20, 2: 7}
    _checked(spark, _classes(spark, sizes), ["a", "b", "c"], sizes)


def test_smote_with_crowded_places(spark):
    """One place holds most rows of a class; its new rows equal it and nothing is lost."""
    rows = [(i, 1, 1.0, 2.0) for i in range(40)] + [(40 + i, 1, float(i), float(i % 3)) for i in range(10)]
    rows += [(50 + i, 0, float(i), 0.5) for i in range(173)]
    df = spark.createDataFrame(rows, "id bigint, label int, a double, b double").repartition(5)
    made = _checked(spark, df, ["a", "b"], {0: 173, 1: 50})
    assert sum(r.is_synthetic and (r.a, r.b) == (1.0, 2.0) for r in made) >= 40 * (123 // 50)


def test_smote_copies_in_steps(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES_PER_STEP", 7)
    sizes = {0: 600, 1: 8}
    _checked(spark, _classes(spark, sizes), ["a", "b", "c"], sizes)


def test_smote_does_not_depend_on_partitions(spark):
    df = _classes(spark, {0: 40, 1: 13})
    one = {tuple(r) for r in smote(df.coalesce(1), ["a", "b"], "label", ["id"]).collect()}
    many = {tuple(r) for r in smote(df.repartition(9), ["a", "b"], "label", ["id"]).collect()}
    assert one == many


def test_smote_of_many_classes(spark, monkeypatch):
    """Classes as a table: named by text, some large enough for boxes, packed into several tasks."""
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", 60)
    monkeypatch.setattr(neighbours, "BOX_POINTS", 20)
    monkeypatch.setattr(neighbours, "PACKED_POINTS", 500)
    df = spark.range(6000).select("id", F.when(F.col("id") < 300, F.lit("largest")).when(F.col("id") < 500, F.lit("large")).otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("label"))
    for i, c in enumerate("ab"):
        df = df.withColumn(c, (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100_000)) / 7).cast("double"))
    made = smote(df, ["a", "b"], "label", ["id"])
    sizes = {r.label: r["count"] for r in made.groupBy("label").count().collect()}
    assert len(sizes) == 502 and set(sizes.values()) == {300}
    assert made.where("not is_synthetic").count() == 6000 and made.select("row_key").distinct().count() == 502 * 300
    one = made.where("label = 'c77' and is_synthetic").collect()
    real = np.array([[r.a, r.b] for r in df.where("label = 'c77'").collect()])
    assert all(_between_two(np.array([r.a, r.b]), real) for r in one)


def test_weights_of_many_classes(spark, monkeypatch):
    df = spark.range(9000).select("id", (F.col("id") % 4000).alias("label"))
    for rows in (100_000, 10):
        monkeypatch.setattr(balance, "BROADCAST_ROWS", rows)
        out = balance.with_class_weights(df, "label")
        assert out.columns == ["id", "label", "weight"]
        assert {round(r.weight, 9) for r in out.collect()} == {round(9000 / 4000 / n, 9) for n in (2, 3)}
    given = balance.with_class_weights(df, "label", {1: 5.0, 2: 0.5})
    assert {r.label: r.weight for r in given.where("label < 4").collect()} == {0: 1.0, 1: 5.0, 2: 0.5, 3: 1.0}


def test_smote_falls_back(spark):
    for df in (_classes(spark, {0: 80, 1: 15, 2: 5}), _classes(spark, {0: 20, 1: 20})):
        assert not smote(df, ["a", "b", "c"], "label", ["id"]).where("is_synthetic").count()
    holed = _classes(spark, {0: 30, 1: 10}).withColumn("a", F.when(F.col("id") != 3, F.col("a")))
    assert smote(holed, ["a", "b"], "label", ["id"]).count() == 40
    with pytest.raises(ValueError, match="strategy"):
        smote(_classes(spark, {0: 30, 1: 10}), ["a"], "label", ["id"], strategy="none such")


@pytest.mark.parametrize("width", [2, 12])
def test_only_copied_rows_ask_and_rough_distances_change_nothing(spark, monkeypatch, width):
    """Two classes, the smaller of which lacks two rows: two places ask, whether or not a matrix product picks candidates."""
    rng = np.random.default_rng(width)
    rows = [(i, int(i >= 20), *map(float, 1e6 + np.round(rng.normal(size=width), 2))) for i in range(38)]
    names = [f"x{j}" for j in range(width)]
    df = spark.createDataFrame(rows, "id bigint, label int, " + ", ".join(f"{n} double" for n in names))
    asked, found = [], []
    real = balance.nearest_points

    def seen(points, k):
        asked.append(points.where("asked").count())
        return real(points, k)

    monkeypatch.setattr(balance, "nearest_points", seen)
    for limit in (1, 1000):
        monkeypatch.setattr(neighbours, "ROUGH_FEATURES", limit)
        found.append(sorted(tuple(r) for r in balance.smote(df, names, "label", ["id"]).where("is_synthetic").collect()))
    assert asked == [2, 2] and found[0] == found[1] and len(found[0]) == 2


def test_parts_are_written_in_one_pass(spark, monkeypatch):
    df = spark.range(60).select(F.col("id"), (F.col("id") % 3).cast("int").alias("label"))
    want = [sorted(r.id for r in part.collect()) for part in split_parts(df, "label", ["id"])]
    written = []
    real = split.materialise
    monkeypatch.setattr(split, "materialise", lambda t, **how: written.append(t.columns) or real(t, **how))
    train, test = split.written_parts(df, "label", ["id"])
    assert [sorted(r.id for r in part.collect()) for part in (train, test)] == want
    assert train.dtypes == test.dtypes == df.dtypes
    # the table of hashes and one table of both parts, of which each is read alone
    assert written == [["c", "row"], ["id", "label", "is_test"]]
    assert all("/is_test=" in f for f in train.inputFiles())
