import ast
import json
import os
import pathlib

import pytest
import numpy as np
from pyspark.sql import functions as F

from grovekit.operators import forest
from grovekit.functions.answers import question_kind
from grovekit.plans import dataset, evaluation, experiments, search
from grovekit.session import local_table
from grovekit.sources import matrix, records, results
from grovekit.sources.schemas import RESULT
from grovekit.streaming import resume

Q_COUNT = "How many and gates are in this logic circuit?"
Q_OUT = "What is the output of this logic circuit, given the inputs x0=True?"


def items(spark, n=8, answers=True):
    rows = [
        (i, f"img/circuit_{i}.png", Q_COUNT if i % 2 == 0 else Q_OUT, (str(i % 3) if i % 2 == 0 else "True") if answers else None)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "index bigint, image string, question string, answer string")
    return df.withColumn("kind", question_kind(F.col("question")))


def test_broken_checkpoint(spark, tmp_path):
    good = {"index": 1, "answer": "a", "question": "é"}
    lines = [json.dumps(good), "", '{"index": 2, "ans', json.dumps({"answer": "x"}), json.dumps({**good, "answer": "b"})]
    (tmp_path / "c.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = records.read_checkpoint(spark, str(tmp_path / "c.jsonl")).select("index", "answer", "question").collect()
    assert [tuple(r) for r in got] == [(1, "b", "é")]
    assert records.read_checkpoint(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_strict_scan_raises(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"index": 1}\n\n{"index": 2}\n')
    assert records.read_jsonl(spark, str(tmp_path / "ok.jsonl")).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"index": 1}\n{"ind\n')
    with pytest.raises(Exception):
        records.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()


def test_matrix_header_by_position(spark, tmp_path):
    (tmp_path / "m.txt").write_text("2 3 9\n 1  2\t0 \n\n3 4.5 1\n")
    got = matrix.read_matrix(spark, str(tmp_path / "m.txt"), 3, labelled=True, header_lines=1).collect()
    assert [(r["features"], r["label"]) for r in got] == [([1.0, 2.0], 0), ([3.0, 4.5], 1)]
    assert matrix.read_matrix(spark, str(tmp_path / "m.txt"), 3).count() == 3


@pytest.mark.parametrize("line", ["1 2", "1 2 3 4", "1 2 x"])
def test_matrix_refuses_other_lines(spark, tmp_path, line):
    (tmp_path / "m.txt").write_text(f"1 2 3\n{line}\n")
    with pytest.raises(Exception, match="not 3 numbers|CAST_INVALID"):
        matrix.read_matrix(spark, str(tmp_path / "m.txt"), 3).collect()


def test_later_file_wins(spark, tmp_path):
    for name, answer, at in (("z", "old", 1_000_000), ("a", "new", 2_000_000)):
        file = tmp_path / f"part-{name}.json"
        file.write_text(json.dumps({"index": 1, "answer": answer}) + "\n")
        os.utime(file, (at, at))
    assert records.read_checkpoint(spark, str(tmp_path)).first()["answer"] == "new"


def test_submission_refuses_blanks(spark, tmp_path):
    ok = spark.createDataFrame([(2, " "), (1, "x")], "index bigint, answer string")
    results.write_submission(ok, str(tmp_path / "s.csv"))
    back = records.read_predictions(spark, str(tmp_path / "s.csv")).orderBy("index").collect()
    assert [tuple(r) for r in back] == [(1, "x"), (2, "")]
    for bad in ("", None):
        with pytest.raises(ValueError, match="1 blank"):
            results.write_submission(ok.withColumn("answer", F.when(F.col("index") == 1, F.lit(bad)).otherwise("y")), str(tmp_path / "n.csv"))


def test_images(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"circuit_{i}.png").write_bytes(b"x")
    (tmp_path / "other.txt").write_text("x")
    recs = dataset.build_records(items(spark, 4), str(tmp_path), True)
    listing = records.image_listing(spark, str(tmp_path))
    assert [r["index"] for r in records.missing_images(recs, listing).collect()] == [3]
    with pytest.raises(FileNotFoundError):
        dataset.require_images(recs, listing)


def test_prepare(spark, tmp_path):
    for side, n in (("train", 10), ("test", 4)):
        (tmp_path / side).mkdir()
        for i in range(n):
            (tmp_path / side / f"circuit_{i}.png").write_bytes(b"x")
        with open(tmp_path / f"{side}.jsonl", "w") as f:
            for i in range(n):
                f.write(json.dumps({"index": i, "question": Q_COUNT, **({"answer": i} if side == "train" else {})}) + "\n")
    out = str(tmp_path / "out")
    dataset.prepare(
        spark, str(tmp_path / "train.jsonl"), str(tmp_path / "test.jsonl"),
        str(tmp_path / "train"), str(tmp_path / "test"), out, 0.25,
    )
    counts = {s: records.read_jsonl(spark, f"{out}/{s}").count() for s in ("train", "val", "test")}
    assert counts == {"train": 8, "val": 2, "test": 4}
    assert records.read_jsonl(spark, f"{out}/train").filter("answer IS NULL").count() == 0


def test_score_counts_missing_apart(spark):
    refs = items(spark, 4)
    preds = spark.createDataFrame(
        [(0, "0", 1.0, 1, 1), (2, "9", None, 1, 2), (2, "2", None, 2, 1), (99, "x", 1.0, 1, 3)],
        "index bigint, answer string, elapsed_s double, batch_id bigint, seq bigint",
    )
    got = {r["kind"]: tuple(r)[1:] for r in evaluation.score(preds, refs).collect()}
    assert got == {
        "count": (2, 2, 100.0, 1.0, 0),
        "output": (0, 0, 0.0, None, 2),
        None: (2, 2, 100.0, 1.0, 2),
    }


def test_majority_ties_go_to_the_first_seen(spark):
    train = spark.createDataFrame([(1, "count", "3"), (2, "count", "1"), (3, "count", "1"), (4, "count", "3")], "index int, kind string, answer string")
    assert evaluation.majority_by_kind(train).first()["majority"] == "3"


def test_clamp(spark):
    preds = spark.createDataFrame([(1, "count", "10"), (2, "count", None), (3, "count", "1")], "index int, kind string, answer string")
    support = spark.createDataFrame([("count", "1"), ("count", "0")], "kind string, answer string")
    majority = spark.createDataFrame([("count", "0")], "kind string, majority string")
    got = evaluation.clamp(preds, support, majority).orderBy("index").collect()
    assert [(r["answer"], r["original"]) for r in got] == [("0", "10"), ("0", None), ("1", "1")]


def test_resume_mirror_and_mixed_backend(spark, tmp_path):
    todo = items(spark, 9)
    calls = []

    def predict(df):
        calls.append(df.count())
        return df.withColumn("answer", F.lit("1"))

    path, mirror = str(tmp_path / "run"), str(tmp_path / "mirror")
    first = experiments.run_predictions(todo.filter("index < 4"), predict, path, "dry", buckets=2, mirror=mirror)
    assert first.count() == 4 and sum(calls) == 4
    every = experiments.run_predictions(todo, predict, path, "dry", mirror=mirror)
    assert every.count() == 9 and calls[-1] == 5
    again = experiments.run_predictions(todo, predict, path, "dry", mirror=mirror)
    assert calls[-1] == 0
    assert sorted(map(str, every.collect())) == sorted(map(str, again.collect()))
    with pytest.raises(evaluation.MixedBackendError):
        experiments.run_predictions(todo, predict, path, "other")
    experiments.run_predictions(todo, predict, path, "other", allow_mixed=True)
    restored = experiments.run_predictions(todo, predict, str(tmp_path / "fresh"), "dry", mirror=mirror)
    assert restored.count() == 9 and calls[-1] == 0


def test_user_predict_runs_per_item(spark):
    def make():
        state = {"n": 0}

        def predict(item):
            state["n"] += 1
            return {"answer": item["question"][:3], "votes": ["a", "b"]}

        return predict

    got = experiments.predict_rows(items(spark, 5).select("index", "image", "question"), make).collect()
    assert {r["answer"] for r in got} == {"How", "Wha"}
    assert all(r["votes"] == ["a", "b"] and r["elapsed_s"] >= 0 and r["raw"] is None for r in got)


def test_vote_ties_go_to_the_first_sample(spark):
    votes = spark.createDataFrame(
        [(1, 1, "b"), (1, 2, "a"), (2, 1, None), (2, 2, "c"), (3, 1, None)], "index int, sample int, vote string"
    )
    got = {r["index"]: (r["answer"], r["agreement"]) for r in evaluation.sample_vote(votes, ["index"]).collect()}
    assert got == {1: ("b", 1), 2: ("c", 1)}


class Mute:
    tag = "mute"

    def generate(self, df, user, raw, tokens, system, limit, sample=None):
        return df.withColumn(raw, F.lit("no idea")).withColumn(tokens, F.lit(2))


def test_unparsed_generations_fall_back(spark):
    majority = spark.createDataFrame([("count", "0"), ("output", "True")], "kind string, majority string")
    todo = items(spark, 2)
    todo = todo.drop("answer").filter("kind = 'count'")
    runs = experiments.strategies(majority, Mute())
    for name in ("exp1_baseline", "exp3_cot", "exp4_self_consistency", "exp5_reflexion"):
        row = runs[name](todo).first()
        assert row["answer"] == "0", name
    assert runs["exp4_self_consistency"](todo).first()["agreement"] == 0
    assert runs["exp5_reflexion"](todo).first()["changed"] is True


def test_stream_resumes(spark, tmp_path):
    source = tmp_path / "in"
    items(spark, 6).select("index", "image", "question", "answer").write.json(str(source))
    predict = lambda df: df.withColumn("answer", F.lit("1"))
    for extra in (0, 3):
        if extra:
            items(spark, 6 + extra).filter("index >= 4").select("index", "image", "question", "answer").write.mode("append").json(str(source))
        query = resume.stream_predictions(
            resume.item_stream(spark, str(source)), predict, str(tmp_path / "run"), str(tmp_path / "ck"), "dry"
        )
        query.awaitTermination(120)
    run = experiments.open_run(spark, str(tmp_path / "run"))
    assert run.count() == 9 and run.select("index").distinct().count() == 9


def test_stock_space_and_filters(spark):
    assert search.stock_space(spark).count() == 216
    narrow = search.search_space(spark.range(1).drop("id"), F.lit(18))
    assert narrow.select("features_per_tree").distinct().collect() == [(15,)]
    axes = {**search.STOCK_AXES, "features_per_tree": ((7,), "int")}
    few = search.search_space(spark.range(1).drop("id"), F.lit(34), axes=axes)
    assert few.filter("split.type = 'PCA' AND split.c > 7").count() == 0


def test_median_pruning(spark):
    steps = [(t, s, 0.5 + t / 100 - (0.4 if t == 11 and s else 0)) for t in range(12) for s in range(2)]
    df = local_table(spark, steps, "number bigint, step int, running_mean double").withColumn(
        "state", F.when(F.col("number") < 10, "COMPLETE").otherwise("RUNNING")
    )
    cut = search.median_pruned(df, startup=10).filter("pruned").select("number", "step").collect()
    assert {(r["number"], r["step"]) for r in cut} == {(t, 1) for t in range(5)}
    near = search.median_pruned(df, startup=10, spread=False).filter("pruned").select("number", "step").collect()
    assert sorted(near) == sorted(cut)
    assert search.median_pruned(df, startup=11).filter("pruned").count() == 0


def test_failed_trial_leaves_a_row_and_is_retried(spark, tmp_path):
    space = search.stock_space(spark).limit(2)

    def objective(config, *_):
        raise RuntimeError("out of luck")

    path = str(tmp_path / "r")
    done = search.run_search(items(spark), "index", 2, space, path, mode="grid", objective=objective)
    assert [r["status"] for r in done.collect()] == ["erro: out of luck"] * 2
    assert search.pending_configs(space, done).count() == 2
    good = lambda *_: [{"fold": f, "acc": 0.5 + f / 10, "fit_s": 1.0, "pred_s": 1.0} for f in range(2)]
    done = search.run_search(items(spark), "index", 2, space, path, mode="grid", objective=good)
    assert search.pending_configs(space, done).count() == 0
    best = search.best_config(done).first()
    assert (best["acc_mean"], best["acc_std"], best["acc_folds"]) == (0.55, 0.05, [0.5, 0.6])
    assert done.schema.names == RESULT.names
    late = search.run_search(
        items(spark), "index", 2, space, str(tmp_path / "b"), budget_s=-1.0, mode="grid", objective=good
    )
    assert late.count() == 0


def test_report_statuses(spark):
    expected = items(spark, 2)
    rows = [("a_test", 0, "1"), ("a_test", 1, "True"), ("a_test", 7, "x"), ("b_test", 0, "1"), ("c_test", 0, ""), ("c_test", 1, "True")]
    runs = spark.createDataFrame(rows, "experiment string, index bigint, answer string").withColumn("backend", F.lit("dry"))
    support = spark.createDataFrame([("count", "1"), ("output", "True")], "kind string, answer string")
    majority = spark.createDataFrame([("count", "1"), ("output", "True")], "kind string, majority string")
    report, out = evaluation.submission_report(runs, expected, support, majority, do_clamp=False)
    got = {r["experiment"]: (r["status"], r["missing"], r["extra"]) for r in report.collect()}
    assert got == {"a_test": ("written", 0, 1), "b_test": ("incomplete", 1, 0), "c_test": ("blank", 0, 0)}
    assert out.count() == 2


def test_shared_fits_equal_single_fits(spark):
    rng = np.random.default_rng(4)
    n = 150
    x, y = rng.normal(size=(n, 4)), np.arange(n) % 3
    x[:, 0] += y
    rows = spark.createDataFrame(
        [(f"r{i:04d}", x[i].tolist(), int(y[i])) for i in range(n)] + [("none", None, 1)],
        "row_key string, features array<double>, label int",
    )
    folded = search.folds_of(rows, "row_key", 2, 1)
    kinds = [
        dict(trees=2, max_depth=2, features_per_tree=2, samples_per_tree=40),
        dict(trees=1, max_depth=2, split="PCA", c=2, samples_per_tree=40, gain="entropy"),
        dict(trees=1, max_depth=1, split="SVM", bagging=False),
        dict(trees=2, max_depth=2, lda=1, replace=False, samples_per_tree=30),
    ]
    fits = [forest.Fit(forest.ForestParams(**k), f) for k in kinds for f in (0, 1, None)]
    models = forest.fit_forests(folded, "row_key", 4, fits)
    for fit, model in list(zip(fits, models))[::7]:
        part = folded if fit.without is None else folded.filter(F.col("fold") != fit.without)
        alone = forest.fit_forest(part, "row_key", 4, fit.params)
        assert [n[:4] + n[7:] for n in alone.rows] == [n[:4] + n[7:] for n in model.rows]
    measured = forest.right_answers(models, [f.without for f in fits], folded)
    for fit, model, (right, asked) in list(zip(fits, models, measured))[::5]:
        part = folded if fit.without is None else folded.filter(F.col("fold") == fit.without)
        joined = part.join(forest.predict_forest(model, part, "row_key"), "row_key")
        assert asked == part.count() and right == joined.filter("label = predicted").count()


def test_failing_configurations_leave_their_rows(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [(f"r{i:03d}", [float(i % 7), float(i)], i % 2) for i in range(60)], "row_key string, features array<double>, label int"
    )
    axes = {"gain": (("gini",), "string"), "max_depth": ((1, 2), "int"), "lda": ((None,), "int"), "tree_count": ((1,), "int"),
            "features_per_tree": ((2,), "int"), "samples_fraction": ((1.0,), "double"), "repeated_sampling": ((False,), "boolean")}
    width = rows.agg(F.max(F.size("features")).alias("m"))
    space = search.search_space(width, F.col("m"), search.STOCK_SPLITS[:1], axes).drop("m")
    whole = search.evaluate_folds

    def fails_at_two(configs, *args):
        if any(c["max_depth"] == 2 for c in configs):
            raise RuntimeError("too deep")
        return whole(configs, *args)

    monkeypatch.setattr(search, "evaluate_folds", fails_at_two)
    done = search.run_search(rows, "row_key", 2, space, str(tmp_path / "r"), mode="grid", k=2).collect()
    assert {r["max_depth"]: r["status"] for r in done} == {1: "ok", 2: "erro: too deep"}


@pytest.mark.parametrize("module", ["answers", "features", "inputs", "models", "search"])
def test_no_helper_is_defined_twice(module):
    """A second helper of the same name takes the place of the first one in the queries above it."""
    path = pathlib.Path(__file__).parent.parent / "workloads" / f"{module}.py"
    names = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, ast.FunctionDef)]
    assert len(names) == len(set(names))
