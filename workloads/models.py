"""Trees, forests and oblique splits on lineitem."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from grovekit.operators import forest as fo
from grovekit.operators import metrics, oblique, sampling, scan, splits
from grovekit.session import local_table, materialize
from workloads.features import BAG, SUB
from workloads.inputs import CLASSES, LI, LI_LONG, lineitem_rows, with_holes
from workloads.registry import query
from workloads.sqltext import forest_ctes, gains, walk

M = 4
ALL_ROWS = """bag AS (SELECT 0 AS tree_id, row_key, 1::BIGINT AS weight FROM li),
sub AS (SELECT 0 AS tree_id, unnest([0, 1, 2, 3])::INT AS feature)"""
NODES = """SELECT tree_id, node_id, kind, feature, round(th, 6) AS th, label, c0, c1, c2 FROM nodes"""


def _long(spark, sf):
    return lineitem_rows(spark, sf, busy=True).select("label", F.posexplode("features").alias("feature", "value"))


@query(
    "threshold_gains",
    f"""WITH {LI}, {LI_LONG}, g AS ({gains('long', ['feature'], 'entropy')})
    SELECT feature, round(th, 6) AS th, round(gain, 9) AS gain, l0 + l1 + l2 AS n_left FROM g""",
)
def threshold_gains(spark, sf):
    table = splits.class_table(_long(spark, sf), ["feature"], CLASSES)
    g = splits.threshold_gains(table, ["feature"], len(CLASSES), "entropy")
    n_left = F.col("l0") + F.col("l1") + F.col("l2")
    return g.select("feature", F.round("th", 6).alias("th"), F.round("gain", 9).alias("gain"), n_left.alias("n_left"))


def _best(method: str, midpoint: bool) -> str:
    return f"""WITH {LI}, {LI_LONG}, g AS ({gains('long', ['feature'], method, midpoint)})
    SELECT feature, round(th, 6) AS th, round(gain, 9) AS gain, l0 + l1 + l2 AS n_left,
      n0 + n1 + n2 - l0 - l1 - l2 AS n_right
    FROM g QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, th) = 1"""


def _rounded(best):
    return best.withColumns({"th": F.round("th", 6), "gain": F.round("gain", 9)})


@query("best_thresholds", _best("entropy", True))
def best_thresholds(spark, sf):
    return _rounded(splits.root_split(lineitem_rows(spark, sf, busy=True), CLASSES))


@query("best_thresholds_by_value", _best("gini", False))
def best_thresholds_by_value(spark, sf):
    return _rounded(splits.root_split(lineitem_rows(spark, sf, busy=True), CLASSES, "gini", "value"))


@query("best_thresholds_spread", _best("entropy", True))
def best_thresholds_spread(spark, sf):
    """The same with ranges cut again until few rows are left in them, as in large tables."""
    return _rounded(splits.root_split(lineitem_rows(spark, sf, busy=True), CLASSES, exact_rows=1000))


def _nodes(forest):
    n = forest.nodes()
    counts = [F.get("class_counts", F.lit(i)).alias(f"c{i}") for i in range(len(CLASSES))]
    return n.select("tree_id", "node_id", "kind", "feature", F.round("th", 6).alias("th"), "label", *counts)


SINGLE = fo.ForestParams(trees=1, max_depth=3, gain="entropy", bagging=False)


@query("decision_tree", f"WITH {LI}, {ALL_ROWS}, {forest_ctes(3, 'entropy')} {NODES}")
def decision_tree(spark, sf):
    return _nodes(fo.fit_forest(lineitem_rows(spark, sf, busy=True), "row_key", M, SINGLE))


@query(
    "tree_predictions",
    f"""WITH {LI}, {ALL_ROWS}, {forest_ctes(2, 'gini', False)},
    src AS (SELECT 0 AS tree_id, * FROM li), {walk('src', 2)}
    SELECT row_key, node_id, predicted FROM leafs""",
)
def tree_predictions(spark, sf):
    rows = lineitem_rows(spark, sf, busy=True)
    params = fo.ForestParams(trees=1, max_depth=2, gain="gini", bagging=False, candidates="value")
    model = fo.fit_forest(rows, "row_key", M, params)
    return fo.tree_predictions(model, rows, "row_key").select("row_key", "node_id", "predicted")


FOREST = fo.ForestParams(trees=3, max_depth=2, gain="gini", features_per_tree=2, seed="f")
FOREST_BAG = BAG.replace("'bag|'", "'f|bag|'")
FOREST_SUB = SUB.format(trees=3, m=M, k=2, seed="f|space")
FOREST_SQL = f"WITH {LI}, {FOREST_BAG}, {FOREST_SUB}, {forest_ctes(2, 'gini')}"


def _fitted(spark, sf):
    rows = lineitem_rows(spark, sf, busy=True)
    n = rows.count()
    params = fo.ForestParams(**{**FOREST.__dict__, "samples_per_tree": n // 2})
    return rows, fo.fit_forest(rows, "row_key", M, params, CLASSES, n)


@query("random_forest", f"{FOREST_SQL} {NODES}")
def random_forest(spark, sf):
    return _nodes(_fitted(spark, sf)[1])


@query(
    "forest_predictions",
    f"""{FOREST_SQL}, src AS (SELECT t.tree_id, li.* FROM li, (SELECT unnest(range(3))::INT AS tree_id) t),
    {walk('src', 2)}
    SELECT row_key, arg_min(predicted, (-n, predicted)) AS predicted
    FROM (SELECT row_key, predicted, count(*) AS n FROM leafs GROUP BY ALL) GROUP BY row_key""",
)
def forest_predictions(spark, sf):
    rows, model = _fitted(spark, sf)
    return fo.predict_forest(model, rows, "row_key")


@query(
    "incomplete_vectors_predictions",
    f"""{FOREST_SQL}, src AS (SELECT t.tree_id, li.* FROM li, (SELECT unnest(range(3))::INT AS tree_id) t),
    {walk('src', 2)},
    voted AS (SELECT row_key, arg_min(predicted, (-n, predicted)) AS predicted
      FROM (SELECT row_key, predicted, count(*) AS n FROM leafs GROUP BY ALL) GROUP BY row_key)
    SELECT row_key, path, CASE WHEN line < 6 THEN predicted END AS predicted
    FROM li JOIN voted USING (row_key), (SELECT unnest(['sent', 'joined']) AS path)""",
)
def incomplete_vectors_predictions(spark, sf):
    """Rows with a NULL vector or element get NULL, by the sent model and by the joined one."""
    rows, model = _fitted(spark, sf)
    rows = with_holes(rows)
    joined = fo.vote(fo.tree_predictions(model, rows, "row_key"), "row_key", model.classes)
    return (
        fo.predict_forest(model, rows, "row_key").withColumn("path", F.lit("sent"))
        .union(joined.withColumn("path", F.lit("joined")))
        .select("row_key", "path", "predicted")
    )


@query(
    "forest_vote",
    f"""WITH {LI}, v AS (SELECT row_key, unnest([label, line % 3, CASE WHEN f0 > 25 THEN 2 ELSE 0 END]) AS p FROM li)
    SELECT row_key, arg_min(p, (-n, p)) AS predicted FROM (SELECT row_key, p, count(*) AS n FROM v GROUP BY ALL)
    GROUP BY row_key""",
)
def forest_vote(spark, sf):
    third = F.when(F.get("features", F.lit(0)) > 25, 2).otherwise(0)
    votes = lineitem_rows(spark, sf, busy=True).select(
        "row_key", F.explode(F.array("label", F.col("line") % 3, third)).alias("predicted")
    )
    return fo.vote(votes, "row_key", CLASSES)


def _accuracy(spark, sf, params):
    """Fit on the training part of a stratified holdout, measure on the rest."""
    rows = materialize(lineitem_rows(spark, sf, busy=True).select("row_key", "features", "label"))
    rows = sampling.stratified_holdout(rows, "row_key")
    train = rows.filter("split = 'train'").select("row_key", "features", "label")
    test = rows.filter("split = 'test'").select("row_key", "features", "label")
    model = fo.fit_forest(train, "row_key", M, params)
    joined = test.select("row_key", F.col("label").alias("actual")).join(
        fo.predict_forest(model, test, "row_key"), "row_key", "left"
    )
    return metrics.accuracy(joined)


@query("pca_forest")
def pca_forest(spark, sf):
    return _accuracy(spark, sf, fo.ForestParams(trees=20, max_depth=4, split="PCA", c=2, features_per_tree=3))


@query("lda_forest")
def lda_forest(spark, sf):
    return _accuracy(spark, sf, fo.ForestParams(trees=20, max_depth=4, lda=2, features_per_tree=3))


@query("svm_forest")
def svm_forest(spark, sf):
    return _accuracy(spark, sf, fo.ForestParams(trees=10, max_depth=3, split="SVM", features_per_tree=3))


@query("kernel_svm_forest")
def kernel_svm_forest(spark, sf):
    params = fo.ForestParams(trees=5, max_depth=2, split="SVM", kernel="rbf", landmarks=8)
    return _accuracy(spark, sf, params)


@query(
    "svm_gradients",
    """SELECT m::INT AS mask, p::DOUBLE AS penalty, 0.0::DOUBLE AS gradient
    FROM (SELECT unnest([1, 2, 3]) AS m), (SELECT unnest([0.1, 1.0, 100.0]) AS p)""",
)
def svm_gradients(spark, sf):
    """Slope of the squared-hinge objective where the separations of all class masks end, as a share of its parts."""
    whole = F.array(F.struct(F.lit(0).alias("tree_id"), F.lit(1).cast("bigint").alias("weight")))
    rows = lineitem_rows(spark, sf, busy=True).select("features", "label", whole.alias("bag"))
    penalties, basis = (0.1, 1.0, 100.0), oblique.Basis(M, list(range(M)))
    trees = [scan.WalkedTree(0, None, [], {1: slot}) for slot in range(len(penalties))]
    asked = [oblique.Separation(s, m, c) for s, c in enumerate(penalties) for m in oblique.bipartition_masks(len(CLASSES))]
    oblique.separate(rows, trees, np.array(CLASSES), (), [basis] * len(trees), asked, 100)
    found = [(p.mask, p.penalty, p.gradient) for p in asked]
    table = local_table(spark, found, "mask int, penalty double, gradient double")
    return table.withColumn("gradient", F.round("gradient", 6))


@query(
    "class_probabilities",
    f"""WITH {LI}, {ALL_ROWS}, {forest_ctes(2, 'gini')},
    p AS (SELECT unnest([0, 1, 2])::INT AS label, unnest([c0, c1, c2]) AS c, c0 + c1 + c2 AS n FROM nodes WHERE kind = 'leaf')
    SELECT label, round(c / n, 6) AS probability, sum(n)::BIGINT AS n FROM p GROUP BY ALL""",
)
def class_probabilities(spark, sf):
    rows = lineitem_rows(spark, sf, busy=True)
    model = fo.fit_forest(rows, "row_key", M, fo.ForestParams(max_depth=2, bagging=False))
    p = fo.class_probabilities(model, rows, "row_key")
    return p.groupBy("label", F.round("probability", 6).alias("probability")).agg(F.count(F.lit(1)).alias("n"))


PLANE = f"""{LI.replace('li AS', 'full_li AS', 1)},
li AS (SELECT row_key, label, f0 / 10 AS f0, f3 / 20 AS f1, 0.0 AS f2, 0.0 AS f3 FROM full_li),
bag AS (SELECT 0 AS tree_id, row_key, 1::BIGINT AS weight FROM li),
sub AS (SELECT 0 AS tree_id, unnest([0, 1])::INT AS feature),
box AS (SELECT min(f0) - 1.0 AS x0, max(f0) + 1.0 AS x1, min(f1) - 1.0 AS y0, max(f1) + 1.0 AS y1 FROM li),
steps AS (SELECT *, unnest(range(floor((x1 - x0) / 0.05)::BIGINT + 1)) AS i FROM box),
cells AS (SELECT *, unnest(range(floor((y1 - y0) / 0.05)::BIGINT + 1)) AS j FROM steps),
src AS (SELECT 0 AS tree_id, i || ':' || j AS row_key, x0 + i * 0.05::DOUBLE AS f0, y0 + j * 0.05::DOUBLE AS f1,
  0.0 AS f2, 0.0 AS f3 FROM cells)"""


@query(
    "decision_grid",
    f"""WITH {PLANE}, {forest_ctes(3, 'entropy')}, {walk('src', 3)}
    SELECT predicted, count(*) AS cells FROM leafs GROUP BY predicted""",
)
def decision_grid(spark, sf):
    """Predicted class over the plane of two features, margins included."""
    rows = lineitem_rows(spark, sf, busy=True).withColumn(
        "features", F.array(F.get("features", F.lit(0)) / 10, F.get("features", F.lit(3)) / 20)
    )
    model = fo.fit_forest(rows, "row_key", 2, fo.ForestParams(max_depth=3, gain="entropy", bagging=False))
    x, y = F.get("features", F.lit(0)), F.get("features", F.lit(1))
    bounds = rows.agg(
        F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min(y).alias("y_min"), F.max(y).alias("y_max")
    )
    grid = fo.decision_grid(bounds, 0.05)
    return fo.predict_tree(model, grid, "row_key").groupBy("predicted").agg(F.count(F.lit(1)).alias("cells"))
