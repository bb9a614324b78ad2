import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovekit.functions.hashing import draw, md5_heads, spread_keys
from grovekit.operators import (
    forest as fo,
    growth,
    histograms,
    kernels,
    linear,
    metrics,
    moments,
    neighbors,
    oblique,
    ranking,
    sampling,
    scan,
    splits,
    stats,
)
from grovekit.session import local_table
from workloads.inputs import cents

SCHEMA = "row_key string, features array<double>, label int"

# The twenty points of the worked tree example.
CLASS_0 = [(-12, -10), (-14, -6), (-15, 0), (-13, 3), (9, 0), (14, -2), (11, -5), (-2, 14), (5, 12), (8, 10)]
CLASS_1 = [(0, 0), (1, 6), (5, 4), (3, 0), (-4, 2), (-7, 3), (-8, -6), (2, -6), (1, -8), (4, -8)]


def twenty(spark):
    rows = [(f"a{i}", [float(x), float(y)], 0) for i, (x, y) in enumerate(CLASS_0)]
    rows += [(f"b{i}", [float(x), float(y)], 1) for i, (x, y) in enumerate(CLASS_1)]
    return spark.createDataFrame(rows, SCHEMA)


def blobs(spark, n=300, m=4, k=3, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(scale=3, size=(k, m))
    labels = np.arange(n) % k
    x = centers[labels] + spread * rng.normal(size=(n, m))
    rows = [(f"r{i:05d}", x[i].tolist(), int(labels[i])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), x, labels


def entropy(labels):
    _, c = np.unique(labels, return_counts=True)
    p = c / c.sum()
    return -(p * np.log2(p)).sum()


def gain(y, left):
    nu = left.mean()
    return entropy(y) - nu * entropy(y[left]) - (1 - nu) * entropy(y[~left])


def test_gain_of_every_threshold(spark):
    long = twenty(spark).select("label", F.posexplode("features").alias("feature", "value"))
    table = splits.class_table(long, ["feature"], [0, 1])
    got = splits.threshold_gains(table, ["feature"], 2, "entropy", "value").collect()
    x = np.array(CLASS_0 + CLASS_1, float)
    y = np.array([0] * 10 + [1] * 10)
    assert len(got) == sum(len(np.unique(x[:, f])) - 1 for f in (0, 1))
    for r in got:
        assert r["gain"] == pytest.approx(gain(y, x[:, r["feature"]] <= r["th"]), abs=1e-12)
    at = [r for r in got if r["feature"] == 0 and r["th"] == -12]
    assert (at[0]["l0"], at[0]["l1"]) == (4, 0)


def test_spread_totals_equal_window(spark):
    rows = [(g, float(v % 37) + v / 1000, v % 5) for g in ("hot", "cold") for v in range(400 if g == "hot" else 7)]
    df = spark.createDataFrame(rows, "g string, value double, c int")
    args = (["g"], "value", {"s": F.col("c")}, "nxt", "all_")
    near = ranking.running_totals(df, *args).select("g", "value", "s", "nxt", "all_s")
    far = ranking.running_totals(df, *args, spread=True).select("g", "value", "s", "nxt", "all_s")
    assert sorted(map(tuple, near.collect()), key=str) == sorted(map(tuple, far.collect()), key=str)


def plain_split(x, y, w, k, method, midpoint):
    """Best (axis, threshold, left counts): greatest gain, then lowest axis, then lowest threshold."""
    best = None
    whole = np.bincount(y, w, k)
    for a in range(x.shape[1]):
        values = np.unique(x[:, a])
        for v, after in zip(values, values[1:]):
            left = np.bincount(y[x[:, a] <= v], w[x[:, a] <= v], k)
            g = histograms.units(histograms.gains(left, whole, method))
            if best is None or g > best[0]:
                best = (g, a, (v + after) / 2 if midpoint else v, left.astype(int).tolist())
    return best and best[1:]


@pytest.mark.parametrize("k, ranges", [(2, 16), (3, 2), (10, 16)])
def test_ranges_and_narrowing_find_the_plain_split(spark, monkeypatch, k, ranges):
    monkeypatch.setattr(histograms, "RANGES", ranges)
    monkeypatch.setattr(histograms, "PASS_COUNTERS", 2000)
    rng = np.random.default_rng(k)
    n, y = 300, rng.integers(0, k, 300)
    x = np.column_stack([rng.normal(size=n) + y * 0.4, rng.integers(-3, 3, n), np.zeros(n), np.exp(5 * rng.normal(size=n))])
    x[:5, 0] = -0.0
    bags = [[(0, 1 + i % 3)] + ([(1, 2)] if i % 2 else []) for i in range(n)]
    rows = spark.createDataFrame(
        [(x[i].tolist(), int(y[i]), bags[i]) for i in range(n)],
        "features array<double>, label int, bag array<struct<tree_id: int, weight: bigint>>",
    ).repartition(3)
    weights = {0: np.array([1 + i % 3 for i in range(n)]), 1: np.array([2 * (i % 2) for i in range(n)])}
    sample = scan.sampled(rows, n, 100, np.arange(k), ())
    problems, want = [], []
    for bag, method, candidates in ((0, "gini", "midpoint"), (1, "entropy", "value"), (1, "gini", "midpoint")):
        problems.append(histograms.Problem(0, 1, np.bincount(y, weights[bag], k).astype(int), method, candidates, [0, 1, 2, 3]))
        at = weights[bag] > 0
        want.append(plain_split(x[at], y[at], weights[bag][at], k, method, candidates == "midpoint"))

    def walked(numbers):
        return [scan.WalkedTree((0, 1, 1)[i], None, [], {1: slot}) for slot, i in enumerate(numbers)]

    for exact_rows in (40, 10_000):
        found = histograms.best_splits(rows, problems, walked, np.arange(k), (), sample, exact_rows)
        got = [(s.axis, s.th, s.left) for s in found]
        assert [(a, pytest.approx(t), c) for a, t, c in want] == got


def test_finder_is_searchsorted():
    rng = np.random.default_rng(1)
    even, lopsided = np.linspace(0, 1, 300), np.exp(20 * rng.normal(size=300))
    far = np.append([-1.7e308, -1e300], np.append(even, 1e308))
    for cuts in (even, np.unique(lopsided), far, np.array([1.0, 2.0]), np.full(20, 3.0), np.empty(0)):
        near = np.concatenate([cuts, np.nextafter(cuts, -np.inf), np.nextafter(cuts, np.inf)])
        values = np.concatenate([near, rng.normal(size=1000), [np.inf, -np.inf, -0.0]])
        for v in (values, np.append(values, np.nan)):
            assert (histograms.Finder(cuts)(v) == np.searchsorted(cuts, v, "left")).all()


def test_large_nodes_start_with_fine_ranges():
    rng = np.random.default_rng(2)
    block = scan.Block.__new__(scan.Block)
    block.views, block.mapped, block.labels = (), {}, np.zeros(2000, int)
    block.raw = np.column_stack([rng.normal(size=2000), rng.integers(0, 4, 2000)])
    block.bags = {0: (np.arange(2000), np.ones(2000))}
    for rows, fewest in ((2000, 255), (10**8, 4000)):
        problem = histograms.Problem(0, 1, np.array([rows // 2, rows // 2]), "gini", "midpoint", [0, 1])
        histograms.sample_cuts([problem], [scan.WalkedTree(0, None, [], {1: 0})], block)
        assert len(problem.cuts[0]) >= fewest and len(problem.cuts[1]) <= 4


def test_bounds_hold_for_every_threshold():
    rng = np.random.default_rng(0)
    for method in ("gini", "entropy"):
        for k in (2, 3, 9):
            whole = rng.integers(1, 30, k)
            before = rng.integers(0, whole + 1)
            inside = rng.integers(0, whole - before + 1)
            top = histograms.bounds(before[None], inside[None], whole, method)[0]
            for _ in range(200):
                left = before + rng.integers(0, inside + 1)
                if 0 < left.sum() < whole.sum():
                    assert histograms.gains(left, whole, method) <= top + 1e-12


def test_no_split_where_all_values_are_equal(spark):
    rows = spark.createDataFrame([(str(i), [1.0, 2.0], i % 2) for i in range(9)], SCHEMA)
    assert splits.root_split(rows, [0, 1]).count() == 0
    model = fo.fit_forest(rows, "row_key", 2, fo.ForestParams(max_depth=3, bagging=False))
    assert [n[2] for n in model.rows] == ["leaf"]


def test_hash_rank_is_a_global_row_number(spark):
    df = spark.range(500).select("id", (F.col("id") % 3 == 0).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    df = df.withColumn("g", F.when(F.col("id") % 7 > 0, F.col("g")))  # a NULL group keeps its rows
    got = ranking.hash_rank(df, "h", ["g"], prefix=2).collect()
    assert len(got) == 500
    for g in (True, False, None):
        part = sorted((r["h"], r["rank"]) for r in got if r["g"] == g)
        assert [p[1] for p in part] == list(range(1, len(part) + 1))


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(7)
    got = ranking.positions(df, ["v"]).collect()
    assert all(r["position"] == r["v"] + 1 for r in got)


def test_tree_fits_and_predicts_training_rows(spark):
    rows = twenty(spark)
    model = fo.fit_forest(rows, "row_key", 2, fo.ForestParams(max_depth=10, gain="entropy", bagging=False))
    joined = rows.withColumnRenamed("label", "actual").join(fo.predict_tree(model, rows, "row_key"), "row_key")
    assert metrics.accuracy(joined).first()["accuracy"] == 1.0
    leaves = [n for n in model.rows if n[2] == "leaf"]
    assert sum(sum(n[8]) for n in leaves) == 20


def test_depth_zero_is_the_majority_with_smallest_tie(spark):
    model = fo.fit_forest(twenty(spark), "row_key", 2, fo.ForestParams(max_depth=0, bagging=False))
    assert [n[7] for n in model.rows] == [0]


def test_splits_at_zero_gain(spark):
    xor = [(0.0, 0.0, 0), (1.0, 1.0, 0), (0.0, 1.0, 1), (1.0, 0.0, 1)]
    rows = spark.createDataFrame([(str(i), [a, b], c) for i, (a, b, c) in enumerate(xor)], SCHEMA)
    model = fo.fit_forest(rows, "row_key", 2, fo.ForestParams(max_depth=2, bagging=False))
    assert {n[2] for n in model.rows if n[1] == 1} == {"axis"}
    assert sum(n[2] == "leaf" for n in model.rows) == 4


@pytest.mark.parametrize(
    "params",
    [
        dict(split="PCA", c=3, max_depth=3),
        dict(split="SVM", max_depth=2),
        dict(split="orthogonal", lda=2, max_depth=3),
        dict(split="SVM", lda=1, max_depth=2),
        dict(split="SVM", kernel="rbf", max_depth=1, landmarks=12),
        dict(split="PCA", c=2, max_depth=3, candidates="value"),
    ],
)
def test_training_partition_is_reproduced(spark, params):
    rows, _, _ = blobs(spark, n=120)
    model = fo.fit_forest(rows, "row_key", 4, fo.ForestParams(trees=2, features_per_tree=3, bagging=False, **params))
    at = fo.tree_predictions(model, rows, "row_key")
    counts = {(r["tree_id"], r["node_id"]): r["n"] for r in at.groupBy("tree_id", "node_id").agg(F.count("*").alias("n")).collect()}
    leaves = {(n[0], n[1]): sum(n[8]) for n in model.rows if n[2] == "leaf"}
    assert counts == leaves
    quick = fo.predict_forest(model, rows, "row_key")
    joined = fo.vote(at, "row_key", model.classes)
    assert sorted(quick.collect()) == sorted(joined.collect())
    voted = rows.withColumnRenamed("label", "actual").join(quick, "row_key")
    assert metrics.accuracy(voted).first()["accuracy"] > 0.6


def test_bagged_forest_draws_exactly(spark):
    rows, _, _ = blobs(spark, n=101)
    for replace in (True, False):
        bag = sampling.bags(rows, "row_key", 4, 60, 101, replace, "s").select(F.explode("bag").alias("b"))
        per_tree = bag.groupBy("b.tree_id").agg(F.sum("b.weight").alias("w"), F.max("b.weight").alias("m")).collect()
        assert [r["w"] for r in per_tree] == [60] * 4
        assert replace or all(r["m"] == 1 for r in per_tree)
    with pytest.raises(ValueError):
        sampling.bags(rows, "row_key", 1, 102, 101, True, "s")
    with pytest.raises(ValueError):
        sampling.subspaces(spark, 1, 4, 5, "s")
    with pytest.raises(ValueError):
        fo.ForestParams(gain="other")


@pytest.mark.parametrize("penalty", [0.5, 100.0])
def test_svm_newton_reaches_the_optimum(spark, penalty):
    rows, x, y = blobs(spark, n=80, m=3, k=3, spread=3.0)
    bag = F.array(F.struct(F.lit(0).alias("tree_id"), F.lit(1).cast("bigint").alias("weight")))
    rows = rows.select("features", "label", bag.alias("bag"))
    problems = [oblique.Separation(0, mask, penalty) for mask in oblique.bipartition_masks(3)]
    trees, bases = [scan.WalkedTree(0, None, [], {1: 0})], [oblique.Basis(3, [0, 1, 2])]
    oblique.separate(rows, trees, np.arange(3), (), bases, problems, 100)
    z = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0)])
    for p in problems:
        s = np.where(p.mask >> y & 1, -1.0, 1.0)
        u = np.append(p.kept[0] + p.kept[1:] @ x.mean(0), p.kept[1:] * x.std(0))
        inside = s * (z @ u) < 1
        slope = u + 2 * penalty * (z[inside].T @ (z[inside] @ u - s[inside]))
        assert np.abs(slope).max() < 1e-5 and p.gradient < 1e-8


def test_packed_rows_are_the_rows(spark, monkeypatch):
    monkeypatch.setattr(scan, "PACKED_BYTES", 1)  # many packed rows of one block
    rows, x, y = blobs(spark, n=300)
    bagged = sampling.bags(rows, "row_key", 3, 150, 300, True, "s")
    table = scan.packed(bagged, [0, 1, 2])
    classes = np.arange(3)
    assert table.count() > 1
    plain = scan.Block(scan.scanned(bagged).toArrow().to_batches(), classes, ())
    (back,) = scan.blocks(iter(table.toArrow().to_batches()), classes, ())
    whole = lambda b: {
        t: sorted((*b.raw[r], b.labels[r], w) for r, w in zip(*b.bags[t])) for t in b.bags
    }
    assert whole(back) == whole(plain)
    assert len(scan.sampled(table, 300, 60, classes, ()).raw) < len(back.raw)


def test_packed_rows_keep_large_weights_and_many_rows():
    for n, weight in ((10, 255.0), (10, 70_000.0), (70_000, 3.0)):
        block = scan.Block.__new__(scan.Block)
        block.raw, block.labels = np.arange(n, dtype=float)[:, None], np.zeros(n, int)
        block.bags = {4: (np.arange(n), np.full(n, weight))}
        back = scan.Block([block.part(np.arange(n))], np.arange(1), ())
        assert (back.bags[4][0] == np.arange(n)).all() and (back.bags[4][1] == weight).all()
        assert block.part(np.arange(n)).nbytes < 30 * n + 200 or weight > 255


def test_bags_of_some_hundred_thousand_rows_take_several_tasks(spark):
    n = 300_000
    rows = spark.range(n).select(F.col("id").cast("string").alias("row_key"))
    spread = sampling.bags(rows, "row_key", 3, n, n, True, "s").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < n * 0.8


def test_bags_of_many_groups_are_those_of_one(spark, monkeypatch):
    rows, *_ = blobs(spark, n=300)
    drawn = lambda: sorted((r["row_key"], r["bag"]) for r in sampling.bags(rows, "row_key", 4, 200, 300, True, "s").collect())
    one = drawn()
    monkeypatch.setattr(sampling, "GROUP_ROWS", 70)
    assert drawn() == one
    ranked = {r["position"]: r["row_key"] for r in sampling.dense_rows(rows.select("row_key"), "row_key", "s").collect()}
    want = {}
    for r in sampling.bag_draws(spark, 4, 200, 300, "s").collect():
        at = ranked[r["position"]], r["tree_id"]
        want[at] = want.get(at, 0) + 1
    assert {(k, b["tree_id"]): b["weight"] for k, bag in one for b in bag} == want


def test_one_draw_needs_no_join_and_whole_bags_no_digests(spark):
    rows, *_ = blobs(spark, n=60)
    fits = [fo.Fit(fo.ForestParams(trees=t, replace=False, gain=g)) for t, g in ((1, "gini"), (2, "entropy"))]
    table, first = fo.shared_bags(rows, "row_key", fits, {None: 60})
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert first == [0, 0] and "Join" not in plan and "Exchange" not in plan and "md5" not in plan
    assert sorted([(b["tree_id"], b["weight"]) for b in r["bag"]] for r in table.collect()) == [[(0, 1), (1, 1)]] * 60


def test_draws_are_those_of_the_columns(spark):
    ids = np.arange(5, 2 * 1000 + 3)
    tree, nth, position = sampling.drawn(ids, 1000, 77, "a|b")
    want = spark.createDataFrame([(int(i),) for i in ids], "id bigint").select(
        (draw("a|b", F.floor(F.col("id") / 1000).cast("int"), F.col("id") % 1000) % 77 + 1).alias("p")
    )
    assert position.tolist() == [r["p"] for r in want.collect()]
    assert (tree * 1000 + nth == ids).all() and all(len(a) == 0 for a in sampling.drawn(np.empty(0, int), 9, 9, 1))


def test_cents_round_as_round_does(spark):
    values = [0.005, -0.005, 1.115, 2.675, 1e13, None, 0.0] + [i / 800 for i in range(-900, 900)]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    plain = F.round(F.col("x") * 100).cast("bigint")
    assert table.filter((F.col("x") * 100 % 1 == 0.5)).count() > 100
    assert table.filter(~plain.eqNullSafe(cents("x"))).count() == 0


def test_bipartitions(spark):
    assert [len(oblique.bipartition_masks(k)) for k in (0, 1, 2, 3, 4, 5)] == [0, 0, 1, 3, 7, 15]
    rows = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 2)], "label int")
    table = oblique.bipartition_table(rows).collect()
    assert len({frozenset(r["members"]) for r in table}) == 7
    assert all(3 not in r["members"] for r in table)


def test_kernel_map_approximates_the_kernel(spark):
    rows, x, _ = blobs(spark, n=40)
    mapping = kernels.fit_kernel_map(rows, "row_key", "rbf", landmarks=40)
    phi = np.stack([r["features"] for r in kernels.apply_kernel_map(rows, mapping).orderBy("row_key").collect()])
    scaled = (x - mapping.mean) / mapping.scale
    assert np.abs(phi @ phi.T - kernels.kernel(scaled, scaled, "rbf", mapping.gamma)).max() < 1e-4


def test_grid_and_probabilities(spark):
    rows = twenty(spark)
    model = fo.fit_forest(rows, "row_key", 2, fo.ForestParams(max_depth=2, gain="entropy", bagging=False))
    bounds = local_table(spark, [(-1.0, 1.0, 0.0, 0.5)], "x_min double, x_max double, y_min double, y_max double")
    grid = fo.decision_grid(bounds, 0.5, margin=1.0)
    assert grid.count() == 9 * 6
    p = fo.class_probabilities(model, rows, "row_key").groupBy("row_key").agg(F.sum("probability").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-12 for r in p.collect())


def test_class_probabilities_need_no_shuffle(spark):
    rows, *_ = blobs(spark, n=60)
    model = fo.fit_forest(rows, "row_key", 4, fo.ForestParams(trees=3, max_depth=2, features_per_tree=2))
    holed = rows.union(spark.createDataFrame([("null", None, 0), ("hole", [1.0, None, 0.0, 0.0], 1)], rows.schema))
    p = fo.class_probabilities(model, holed, "row_key")
    assert "Exchange" not in p._jdf.queryExecution().executedPlan().toString()
    order = lambda df: sorted(map(tuple, df.select("row_key", "label", "probability").collect()))
    want = order(fo._joined_probabilities(model, holed, "row_key"))
    assert [(k, c, pytest.approx(v)) for k, c, v in want] == order(p) and len(want) == 180


def test_moments_and_weights(spark):
    rows, x, labels = blobs(spark, n=50)
    weighted = rows.withColumn("w", F.length("row_key") * 1.0)
    m = moments.moments(weighted, ["label"], weight="w").collect()
    z = np.column_stack([np.ones(50), x])
    for r in m:
        part = z[labels == r["label"]]
        assert r["s"] == pytest.approx(6 * (part[:, r["i"]] * part[:, r["j"]]).sum(), rel=1e-9, abs=1e-9)
    assert len(m) == 3 * 15


def test_least_squares_with_a_dependent_column(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    x[:, 2] = 2 * x[:, 0]
    y = x @ [1.0, -2.0, 0.5] + 3 + 0.1 * rng.normal(size=60)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, y double")
    model = linear.fit_least_squares(df, "y")
    xs, ys = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()
    assert np.allclose(model.weights, np.linalg.pinv(xs) @ ys, atol=1e-8)
    got = [r[0] for r in df.select(model.predict(F.col("features"))).collect()]
    assert np.allclose(got, (xs @ model.weights) * y.std() + y.mean())


def test_pca_matches_svd(spark):
    rows, x, _ = blobs(spark, n=70)
    pca = linear.fit_pca(rows)
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(pca.variances, s**2 / 70)
    assert np.allclose(np.abs((pca.axes * vt).sum(1)), 1)
    shares = linear.variance_shares(spark, pca)
    running = np.cumsum(s**2 / (s**2).sum())
    for v in (0.0, 0.6, 0.95):
        assert linear.components_for(shares, v).first()[0] == int(np.argmax(running >= v)) + 1
    with pytest.raises(ValueError):
        linear.components_for(shares, 1.5)


def brute_violations(x, p):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    dh = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    n, found = len(x), 0
    for i in range(n):
        for j in range(n):
            for k in range(n):
                if len({i, j, k}) == 3:
                    found += (d[i, j] < d[i, k]) != (dh[i, j] < dh[i, k])
    return int(found)


@pytest.mark.parametrize("rounded", [False, True])
def test_order_violations_against_brute_force(spark, rounded):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(17, 3))
    if rounded:  # many ties
        x = np.round(x)
    p = x[:, :1]
    df = spark.createDataFrame(
        [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, p))],
        "id int, features array<double>, projected array<double>",
    )
    want = brute_violations(x, p)
    assert linear.order_violations(df, "id", "projected").first()[0] == want
    assert linear.order_violations(df, "id", "projected", tile_bytes=5 * 4 * 8).first()[0] == want
    assert linear.order_violations(df, "id", "projected", tile_bytes=9 * 4 * 8).first()[0] == want  # two tiles
    unknown = spark.createDataFrame([(99, None, [0.0]), (98, [1.0, None, 0.0], [1.0])], df.schema)
    assert linear.order_violations(df.union(unknown), "id", "projected").first()[0] == want
    assert linear.order_violations(df.limit(0), "id", "projected").first()[0] == 0


def test_order_violations_of_many_tiles_are_few_tasks(spark, monkeypatch):
    """Work grows with the square of the rows however small the tiles are, and groups of bounded size add up as well."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(23, 3))
    rows = [(i, a.tolist(), a[:1].tolist()) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, features array<double>, projected array<double>")
    want, explodes = brute_violations(x, x[:, :1]), []
    sequence = F.sequence
    monkeypatch.setattr(F, "sequence", lambda low, high: explodes.append(str(high)) or sequence(low, high))
    assert linear.order_violations(df, "id", "projected", tile_bytes=32).first()[0] == want  # 23 tiles, 3 groups
    assert explodes and not any("'22'" in e or "'23'" in e for e in explodes)
    monkeypatch.setattr(linear, "GROUP_BYTES", 4 * 32)
    assert linear.order_violations(df, "id", "projected", tile_bytes=32).first()[0] == want  # six groups


def test_order_violations_of_two_groups_are_one_pass(spark, monkeypatch):
    """A table that fits two groups is not counted three times over."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20, 3))
    rows = [(i, a.tolist(), a[:1].tolist()) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, features array<double>, projected array<double>")
    explodes, sequence = [], F.sequence
    monkeypatch.setattr(F, "sequence", lambda low, high: explodes.append(str(high)) or sequence(low, high))
    monkeypatch.setattr(linear, "TILE_BYTES", 5 * 4 * 8)
    monkeypatch.setattr(linear, "GROUP_BYTES", 10 * 4 * 8)
    got = linear.order_violations(df, "id", "projected", tile_bytes=5 * 4 * 8).first()[0]  # four tiles, two groups
    assert got == brute_violations(x, x[:, :1])
    assert not any("'2'" in e for e in explodes)


@pytest.mark.parametrize("n", [1, 7, 32])
def test_spread_keys_fill_every_partition_once(spark, n):
    table = spark.createDataFrame([(k,) for k in spread_keys(n)], "k int").repartition(n, "k")
    assert [r["k"] for r in table.withColumn("p", F.spark_partition_id()).orderBy("p").collect()] == spread_keys(n)
    assert table.select(F.spark_partition_id().alias("p")).distinct().count() == n


@pytest.mark.parametrize("kind", ["spread", "whole", "copies", "far", "unknown", "close"])
def test_order_around_a_point_is_that_of_the_summed_distances(kind):
    """Squares from a matrix product are too coarse where distances are equal or nearly so."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(70, 4))
    if kind == "whole":
        x = np.round(x)
    elif kind == "copies":
        x[35:] = x[:35]
    elif kind == "far":
        x[7] *= 1e9
    elif kind == "unknown":
        x[7, 0], x[8, 1] = np.nan, np.inf
    elif kind == "close":
        x = x[0] + np.round(x, 1) * 1e-15
    p = x[:, :2].copy()
    sides = [linear.Distances(x), linear.Distances(p)]
    (near, limits), (near_p, limits_p) = (side.squared(v[:3]) for side, v in zip(sides, (x, p)))
    for i in range(3):
        with np.errstate(all="ignore"):
            d, dh = (np.sqrt(sum((v[:, f] - v[i, f]) ** 2 for f in range(v.shape[1]))) for v in (x, p))
        want = linear.order_violations_of(np.delete(d, i), np.delete(dh, i))
        pairs = [[np.delete(np.unique(v, return_inverse=True)[1], i) for v in (d, dh)]]
        brute = sum(int(((a[:, None] < a) != (b[:, None] < b)).sum()) for a, b in pairs)
        got = linear._anchor_violations(sides, [x[i], p[i]], [near[i], near_p[i]], [limits[i], limits_p[i]], i)
        assert got == want == brute


@pytest.mark.parametrize("n", [3000, 70000])
def test_inversions_of_many_ranks(n):
    ranks = np.random.default_rng(n).permutation(n)
    order, count = np.zeros(n + 1, int), 0  # a Fenwick tree
    for seen, r in enumerate(ranks.tolist()):
        i = r + 1
        count += seen
        while i:
            count -= order[i]
            i -= i & -i
        i = r + 1
        while i <= n:
            order[i] += 1
            i += i & -i
    assert linear._inversions(ranks) == count


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 64, 200])
def test_inversions_against_all_pairs(n):
    ranks = np.random.default_rng(n).permutation(n)
    assert linear._inversions(ranks) == sum(int((ranks[:j] > r).sum()) for j, r in enumerate(ranks))


@pytest.mark.parametrize("sizes", [{}, {"broadcast_bytes": 1, "block_bytes": 800}])
def test_nearest_against_brute_force(spark, sizes):
    rows, x, y = blobs(spark, n=60, spread=4.0)
    x = np.round(x)  # ties
    df = spark.createDataFrame([(f"r{i:05d}", x[i].tolist(), int(y[i])) for i in range(60)], SCHEMA)
    train, test = df.filter("row_key >= 'r00020'"), df.filter("row_key < 'r00020'")
    got = {}
    for r in neighbors.nearest(train, test, 3, "row_key", **sizes).collect():
        got.setdefault(r["query"], {})[r["rank"]] = r["neighbor"]
    for i in range(20):
        d = np.sqrt(((x[20:] - x[i]) ** 2).sum(1))
        want = [f"r{20 + j:05d}" for j in np.argsort(d, kind="stable")[:3]]
        assert [got[f"r{i:05d}"][k] for k in (1, 2, 3)] == want


def test_knn_ties_go_to_the_smallest_label(spark):
    train = spark.createDataFrame([("a", [0.0, 5.0], 2), ("b", [2.0, 5.0], 1)], SCHEMA)
    test = spark.createDataFrame([("q", [1.0, 5.0], 0)], SCHEMA)
    assert neighbors.knn_classify(train, test, 2, "row_key").first()["predicted"] == 1


def test_constant_feature_scales_to_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 2.0],)], "features array<double>")
    s = stats.feature_stats(df)
    assert [r["features"] for r in stats.zscore(df, s).collect()] == [[-1.0, None], [1.0, None]]
    new = spark.createDataFrame([([5.0, 2.0],)], "features array<double>")
    assert stats.minmax(new, s).first()["features"] == [2.0, None]


def test_overlap_and_empty_sides(spark):
    a = spark.createDataFrame([([1.0, 0.0],), ([2.0, 2.0],)], "features array<double>")
    b = spark.createDataFrame([([1.0, -0.0],), ([9.0, 9.0],)], "features array<double>")
    wide = spark.createDataFrame([([1.0, 0.0, 0.0],)], "features array<double>")
    nan = spark.createDataFrame([([float("nan"), 1.0],)], "features array<double>")
    flag = lambda x, y: metrics.has_overlap(x, y).first()["overlap"]
    assert flag(a, b) is True
    assert flag(a, wide) is False
    assert flag(a, a.limit(0)) is False and flag(a.limit(0), a) is False
    assert flag(nan, nan) is False


def test_empty_confusion(spark):
    empty = spark.createDataFrame([], "actual int, predicted int")
    assert tuple(metrics.confusion_stats(metrics.confusion(empty)).first()) == (-1, -1, -1)


def test_losses_truncate(spark):
    df = spark.createDataFrame([(1, 4), (2, 2), (5, 4)], "y_hat int, y_true int")
    assert metrics.task_loss(df, "regression").first()[0] == 3
    assert metrics.task_loss(df, "classification").first()[0] == 1
    with pytest.raises(ValueError):
        metrics.task_loss(df, "ranking")


@pytest.mark.parametrize("prefix", [b"", b"42|bag|3|", b"x" * 50, b"y" * 60])
def test_md5_heads_against_hashlib(prefix):
    numbers = np.concatenate([np.arange(120), 10 ** np.arange(18), 10 ** np.arange(1, 18) - 1, [2**62]])
    want = [int.from_bytes(hashlib.md5(prefix + b"%d" % i).digest()[:8], "big") for i in numbers.tolist()]
    assert md5_heads(prefix, numbers).tolist() == want
    assert len(md5_heads(prefix, numbers[:0])) == 0


def test_fits_that_differ_in_depth_alone_grow_once(spark, monkeypatch):
    rows, _, _ = blobs(spark, n=200, spread=3.0)
    fits = [fo.Fit(fo.ForestParams(trees=2, max_depth=d, features_per_tree=2)) for d in (1, 3, 0)]
    asked, best = [], growth.best_splits
    monkeypatch.setattr(growth, "best_splits", lambda rows, problems, *rest: asked.append(len(problems)) or best(rows, problems, *rest))
    models = fo.fit_forests(rows, "row_key", 4, fits)
    assert asked[0] == 2
    for fit, model in zip(fits, models):
        assert model.rows == fo.fit_forest(rows, "row_key", 4, fit.params).rows


def test_draws_with_replacement_come_packed(spark):
    rows, _, _ = blobs(spark, n=200, spread=3.0)
    plain = sampling.bags(rows, "row_key", 3, 150, 200, True, "s")
    packed = sampling.bags(rows, "row_key", 3, 150, 200, True, "s", kept=["features", "label"], finish=scan.packing([0, 1, 2]))
    assert packed.columns == scan.PACKED_NAMES and "row_key" in plain.columns
    found = []
    for table in (plain.select("features", "label", "bag"), packed):
        block = scan.Block(table.toArrow().to_batches(), np.arange(3), ())
        found.append(sorted((b, *block.raw[i], block.labels[i], w) for b, part in block.bags.items() for i, w in zip(*part)))
    assert found[0] == found[1]
    assert growth.bag_counts(packed, [0, 1, 2])[1].sum() == 150
