"""Question/answer workloads: parsing, baselines, inference, scoring, checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from grovekit.functions import answers, labels, masks, prompts
from grovekit.plans import dataset, evaluation, experiments
from grovekit.session import shared_folder
from grovekit.sources import records, results
from grovekit.sources.schemas import RUN
from workloads import sqltext as q
from workloads.inputs import ITEMS, POOL, PREDS, items, pool, predictions, table
from workloads.registry import query

WITH = f"WITH {POOL}, {PREDS}"


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _parts(spark, sf):
    """train, val, majority, support."""
    p = pool(spark, sf)
    train, val = p.filter("split = 'train'"), p.filter("split = 'val'")
    return train, val, evaluation.majority_by_kind(train), evaluation.answer_support(train)


# Records -------------------------------------------------------------------


@query(
    "qa_records",
    f"""WITH {ITEMS} SELECT "index", image, question, answer FROM items""",
)
def qa_records(spark, sf):
    return dataset.build_records(items(spark, sf), "kaggle_dataset/images", has_answer=True)


@query(
    "question_kinds",
    f"""WITH {ITEMS} SELECT kind, CASE WHEN kind = 'count' THEN lower(regexp_extract(question, '(?i)How many (\\w+) gates', 1)) END AS gate,
    count(*) AS n FROM items GROUP BY ALL""",
)
def question_kinds(spark, sf):
    asked = F.concat(F.lit(" \t\n"), F.col("question"), F.lit(" \n"))
    return (
        items(spark, sf)
        .select(answers.question_kind(asked).alias("kind"), answers.asked_gate(F.col("question")).alias("gate"))
        .groupBy("kind", "gate")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "dataset_split",
    f"""WITH {POOL} SELECT "index", split FROM pool""",
)
def dataset_split(spark, sf):
    labelled = items(spark, sf).filter("labelled")
    return dataset.split_records(dataset.build_records(labelled, "x", True), 0.25).select("index", "split")


@query(
    "prepared_files",
    f"""WITH {POOL} SELECT split, count(*) AS n, sum("index")::BIGINT AS total FROM (
      SELECT split, "index" FROM pool UNION ALL SELECT 'test', "index" FROM items WHERE NOT labelled) GROUP BY split""",
)
def prepared_files(spark, sf):
    """Build records, split them, write JSON lines, read them back strictly."""
    folder = _path(spark, "prepared")
    base = items(spark, sf)
    train = dataset.split_records(dataset.build_records(base.filter("labelled"), "x", True), 0.25)
    test = dataset.build_records(base.filter("NOT labelled"), "x", False)
    for split in ("train", "val"):
        records.write_jsonl(train.filter(F.col("split") == split).drop("split"), f"{folder}/{split}")
    records.write_jsonl(test, f"{folder}/test")
    out = None
    for split in ("train", "val", "test"):
        part = records.read_jsonl(spark, f"{folder}/{split}").agg(
            F.count(F.lit(1)).alias("n"), F.sum("index").alias("total")
        ).select(F.lit(split).alias("split"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "split_profile",
    f"""WITH {POOL} SELECT split, count(*) AS n, count(*) FILTER (kind = 'count') AS "count",
    count(*) FILTER (kind = 'output') AS output FROM pool GROUP BY split""",
)
def split_profile(spark, sf):
    return evaluation.split_profile(evaluation.with_kind(pool(spark, sf)))


# Parsing -------------------------------------------------------------------


@query(
    "stripped_artifacts",
    f"""WITH {ITEMS}, t AS (SELECT "index", 'Q: ' || question || ' given x3=true; X12 = FALSE,x4=True ' || text AS t, question FROM items)
    SELECT "index", md5({q.strip_artifacts('t', 'question')}) AS cleaned FROM t""",
)
def stripped_artifacts(spark, sf):
    t = F.concat(
        F.lit("Q: "), F.col("question"), F.lit(" given x3=true; X12 = FALSE,x4=True "), F.col("text")
    )
    return items(spark, sf).select("index", F.md5(answers.strip_artifacts(t, F.col("question"))).alias("cleaned"))


@query(
    "extracted_tokens",
    f"""WITH {ITEMS} SELECT "index", {q.extract_bool('text')} AS as_bool, {q.extract_count('text')} AS as_count FROM items""",
)
def extracted_tokens(spark, sf):
    t = F.col("text")
    return items(spark, sf).select(
        "index", answers.extract_bool(t).alias("as_bool"), answers.extract_count(t).alias("as_count")
    )


@query(
    "clean_answers",
    f"""WITH {POOL}, src AS (SELECT items.*, majority FROM items LEFT JOIN maj USING (kind))
    SELECT "index", parsed FROM ({q.clean_answer('src', 'text', 'parsed', 'question', 'majority')})""",
)
def clean_answers(spark, sf):
    _, _, majority, _ = _parts(spark, sf)
    src = evaluation.with_majority(items(spark, sf), majority)
    parsed = answers.with_clean_answer(
        src, "text", None, F.col("question"), F.col("majority"), "parsed"
    )
    return parsed.select("index", "parsed")


ECHO = """'Final answer - 3. ' || question || chr(10) || text || chr(10) || 'Final Answer: ' || answer || chr(13) || 'x1=True 7'"""


@query(
    "clean_marked_answers",
    f"""WITH {ITEMS}, src AS (SELECT *, {ECHO} AS generated FROM items)
    SELECT "index", parsed, parsed = answer AS hit FROM ({q.clean_answer('src', 'generated', 'parsed', 'question')})""",
)
def clean_marked_answers(spark, sf):
    generated = F.concat(
        F.lit("Final answer - 3. "), F.col("question"), F.lit("\n"), F.col("text"),
        F.lit("\nFinal Answer: "), F.col("answer"), F.lit("\rx1=True 7"),
    )
    src = items(spark, sf).withColumn("generated", generated)
    parsed = answers.with_clean_answer(src, "generated", F.col("kind"), F.col("question"), None, "parsed")
    return parsed.select("index", "parsed", (F.col("parsed") == F.col("answer")).alias("hit"))


# Prompts -------------------------------------------------------------------


def _reviewed(text: str, proposed: str) -> str:
    return f"""'Question: ' || question || chr(10) || 'Initial Analysis: ' || {text} || chr(10) ||
      'Proposed Answer: ' || coalesce({proposed}, 'None') || chr(10) || chr(10) || {q.REVIEW}"""


@query(
    "built_prompts",
    f"""WITH {ITEMS} SELECT "index", md5(question {q.STEPWISE}) AS stepwise,
      md5({_reviewed('text', "CASE WHEN kind = 'count' THEN answer END")}) AS review FROM items""",
)
def built_prompts(spark, sf):
    proposed = F.when(F.col("kind") == "count", F.col("answer"))
    return items(spark, sf).select(
        "index",
        F.md5(prompts.stepwise_prompt(F.col("question"))).alias("stepwise"),
        F.md5(prompts.review_prompt(F.col("question"), F.col("text"), proposed)).alias("review"),
    )


@query(
    "chat_messages",
    """SELECT conv_id, turn, 2 AS n, 'system' AS first_role, md5('Answer the question about the image.' || '|' || text) AS contents
    FROM conversations""",
)
def chat_messages(spark, sf):
    chat = prompts.chat_messages(F.lit(prompts.BASELINE_SYSTEM), F.col("text"))
    c = table(spark, sf, "conversations").select("conv_id", "turn", chat.alias("chat"))
    return c.select(
        "conv_id",
        "turn",
        F.size("chat").alias("n"),
        F.get("chat.role", F.lit(0)).alias("first_role"),
        F.md5(F.array_join("chat.content", "|")).alias("contents"),
    )


@query(
    "stand_in_generations",
    f"""WITH {ITEMS}, p AS (SELECT "index", question {q.STEPWISE} AS u, question || ' ' || text AS t FROM items)
    SELECT "index", {q.stand_in_text('t')} AS direct, {q.stand_in_text('u', "'2'")} AS sampled,
      least(128, {q.words(q.stand_in_text('u'))})::INT AS tokens, least(16, {q.words('t')})::INT AS long_tokens FROM p""",
)
def stand_in_generations(spark, sf):
    user, t = prompts.stepwise_prompt(F.col("question")), F.concat("question", F.lit(" "), "text")
    return items(spark, sf).select(
        "index",
        prompts.stand_in_generation(t).alias("direct"),
        prompts.stand_in_generation(user, F.lit(2)).alias("sampled"),
        prompts.stand_in_tokens(prompts.stand_in_generation(user), 128).alias("tokens"),
        prompts.stand_in_tokens(t, 16).alias("long_tokens"),
    )


WORD_ID = "(('0x' || substr(md5(w), 1, 6))::INT + 1)"


@query(
    "loss_masks",
    f"""WITH t AS (SELECT conv_id, turn, list_transform(string_split(role || ' : ' || text || ' assistant :', ' '), lambda w: {WORD_ID}) || [0, 0] AS ids FROM conversations),
    m AS (SELECT *, (SELECT list(('0x' || substr(md5(w), 1, 6))::INT + 1) FROM (SELECT unnest(['assistant', ':']) AS w)) AS marker FROM t),
    s AS (SELECT *, coalesce(list_min([i FOR i IN range(1, len(ids)) IF ids[i] = marker[1] AND ids[i + 1] = marker[2]]), 0) AS start FROM m)
    SELECT conv_id, turn, len(ids)::INT AS n_tokens, start::INT AS start,
      md5(array_to_string([CASE WHEN (start > 0 AND i <= start + 1) OR ids[i] = 0 THEN -100 ELSE ids[i] END FOR i IN range(1, len(ids) + 1)], ' ')) AS labels
    FROM s""",
)
def loss_masks(spark, sf):
    def word_id(w):
        return F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("int") + 1

    spoken = F.concat(F.col("role"), F.lit(" : "), F.col("text"), F.lit(" assistant :"))
    ids = F.concat(F.transform(F.split(spoken, " "), word_id), F.array(F.lit(0), F.lit(0)))
    marker = F.array(word_id(F.lit("assistant")), word_id(F.lit(":")))
    # Staged, so that ids and the marker's place are computed once per row.
    t = table(spark, sf, "conversations").select("conv_id", "turn", ids.alias("ids"), marker.alias("marker"))
    t = t.withColumn("start", masks.first_occurrence(F.col("ids"), F.col("marker")))
    masked = masks.loss_labels(F.col("ids"), F.col("marker"), F.lit(0), F.col("start"))
    return t.select(
        "conv_id",
        "turn",
        F.size("ids").alias("n_tokens"),
        "start",
        F.md5(F.array_join(F.transform(masked, lambda v: v.cast("string")), " ")).alias("labels"),
    )


# Baseline and support ----------------------------------------------------------


@query("majority_answers", f"WITH {POOL} SELECT kind, majority FROM maj")
def majority_answers(spark, sf):
    return _parts(spark, sf)[2]


@query("answer_support", f"WITH {POOL} SELECT kind, answer FROM support")
def answer_support(spark, sf):
    return _parts(spark, sf)[3]


CLAMPED = """clamped AS (SELECT l.*, CASE WHEN s.answer IS NOT NULL THEN l.answer ELSE majority END AS fixed
  FROM latest l LEFT JOIN support s USING (kind, answer) LEFT JOIN maj USING (kind))"""


@query(
    "clamped_answers",
    f"""{WITH}, {CLAMPED} SELECT "index", fixed AS answer, answer AS original FROM clamped""",
)
def clamped_answers(spark, sf):
    _, _, majority, support = _parts(spark, sf)
    run = evaluation.latest(predictions(spark, sf), columns=["kind", "answer"])
    done = evaluation.clamp(run, support, majority)
    return done.select("index", "answer", "original")


# Scores --------------------------------------------------------------------


def _rounded(scores):
    return scores.withColumns({c: F.round(c, 6) for c in ("accuracy", "avg_s") if c in scores.columns})


@query("exact_match_score", f"{WITH} {q.score('latest', 'items')}")
def exact_match_score(spark, sf):
    return _rounded(evaluation.score(predictions(spark, sf), items(spark, sf)))


@query(
    "score_half_width",
    f"""{WITH}, s AS ({q.score('latest', 'items')}) SELECT kind, n,
    round(100.0 * 1.96 * sqrt(accuracy / 100 * (1 - accuracy / 100) / n), 4) AS half_width FROM s""",
)
def score_half_width(spark, sf):
    s = evaluation.half_width(_rounded(evaluation.score(predictions(spark, sf), items(spark, sf))))
    return s.select("kind", "n", F.round("half_width", 4).alias("half_width"))


@query(
    "score_lines",
    f"""{WITH}, s AS ({q.score('latest', 'items')}) SELECT printf('  %-7s %6.2f%%  (%d/%d)', coalesce(kind, 'TOTAL'),
      round_even(accuracy, 2), correct, n) || CASE WHEN avg_s <> 0 THEN printf('  %.2fs/item', round_even(avg_s, 2)) ELSE '' END AS line FROM s""",
)
def score_lines(spark, sf):
    return evaluation.score_lines(_rounded(evaluation.score(predictions(spark, sf), items(spark, sf)))).select("line")


@query(
    "predicted_subset",
    f"""{WITH} SELECT count(*) AS n, count(*) FILTER (l.answer = i.answer) AS correct
    FROM latest l JOIN items i USING ("index")""",
)
def predicted_subset(spark, sf):
    """References restricted to the predicted items."""
    refs = items(spark, sf).select("index", F.col("answer").alias("want"))
    joined = refs.join(evaluation.latest(predictions(spark, sf), columns=["answer"]), "index")
    hit = F.coalesce(F.col("answer") == F.col("want"), F.lit(False))
    return joined.agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("bigint")).alias("correct"))


@query(
    "last_record_wins",
    f"""{WITH} SELECT "index", batch_id, answer FROM latest""",
)
def last_record_wins(spark, sf):
    return evaluation.latest(predictions(spark, sf), columns=["batch_id", "answer"])


REPARSED = f"""refs AS (SELECT "index", majority FROM latest JOIN maj USING (kind)),
src AS (SELECT l.* REPLACE (CASE WHEN elapsed_s IS NULL THEN NULL ELSE raw END AS raw), majority
  FROM latest l LEFT JOIN refs USING ("index")),
reparsed AS (SELECT * REPLACE (CASE WHEN raw IS NULL THEN answer ELSE parsed END AS answer)
  FROM ({q.clean_answer("(SELECT * REPLACE (coalesce(raw, '') AS raw) FROM src)", 'raw', 'parsed', 'question', 'majority')}) p
  JOIN (SELECT "index" AS i2, raw AS raw0 FROM src) ON i2 = p."index")"""
# The original NULL generations decide which answers stay.
REPARSED = REPARSED.replace("CASE WHEN raw IS NULL THEN answer", "CASE WHEN raw0 IS NULL THEN answer")


def _reparsed(spark, sf):
    _, _, majority, _ = _parts(spark, sf)
    before = evaluation.latest(predictions(spark, sf)).withColumn(
        "raw", F.when(F.col("elapsed_s").isNotNull(), F.col("raw"))
    )
    return before, evaluation.reparse(before, items(spark, sf), majority)


@query("reparsed_answers", f"""{WITH}, {REPARSED} SELECT "index", answer FROM reparsed""")
def reparsed_answers(spark, sf):
    return _reparsed(spark, sf)[1].select("index", "answer")


def _before_after(after: str, column: str) -> str:
    return f"""SELECT round(100.0 * count(*) FILTER (coalesce(b.answer, 'None') = i.answer) / count(*), 6)::DOUBLE AS accuracy_before,
      round(100.0 * count(*) FILTER (coalesce(a.{column}, 'None') = i.answer) / count(*), 6)::DOUBLE AS accuracy_after,
      count(*) FILTER (a.{column} IS DISTINCT FROM b.answer) AS changed
    FROM items i JOIN latest b USING ("index") JOIN {after} a USING ("index")"""


def _rounded_pair(df):
    return df.withColumns({c: F.round(c, 6) for c in ("accuracy_before", "accuracy_after")})


@query("reparse_effect", f"{WITH}, {REPARSED} {_before_after('reparsed', 'answer')}")
def reparse_effect(spark, sf):
    before, after = _reparsed(spark, sf)
    return _rounded_pair(evaluation.before_after(before, after, items(spark, sf)))


@query("clamp_effect", f"{WITH}, {CLAMPED} {_before_after('clamped', 'fixed')}")
def clamp_effect(spark, sf):
    _, _, majority, support = _parts(spark, sf)
    before = evaluation.latest(predictions(spark, sf))
    after = evaluation.clamp(before, support, majority)
    return _rounded_pair(evaluation.before_after(before, after, items(spark, sf)))


@query(
    "sample_votes",
    f"""{WITH}, v AS (SELECT experiment, kind, answer, count(*) AS n, min(("index", batch_id)) AS first FROM preds
      WHERE answer IS NOT NULL GROUP BY ALL)
    SELECT experiment, kind, arg_min(answer, (-n, first)) AS answer, max(n)::INT AS agreement FROM v GROUP BY ALL""",
)
def sample_votes(spark, sf):
    votes = predictions(spark, sf).withColumn("sample", F.struct("index", "batch_id"))
    return evaluation.sample_vote(votes, ["experiment", "kind"], "answer")


@query(
    "token_totals",
    f"""{WITH} SELECT experiment, count(*) AS items, coalesce(sum(new_tokens), 0)::BIGINT AS tokens,
    round(coalesce(sum(new_tokens), 0) / count(*), 6) AS tokens_per_item FROM latest GROUP BY experiment""",
)
def token_totals(spark, sf):
    run = evaluation.latest(predictions(spark, sf), columns=["experiment", "new_tokens"])
    t = evaluation.token_totals(run, ["experiment"])
    return t.withColumn("tokens_per_item", F.round("tokens_per_item", 6))


@query(
    "other_backends",
    f"{WITH} SELECT DISTINCT backend FROM latest WHERE backend IS NOT NULL AND backend <> 'nf4'",
)
def other_backends(spark, sf):
    return evaluation.other_backends(evaluation.latest(predictions(spark, sf), columns=["backend"]), "nf4")


@query(
    "completeness",
    f"""{WITH} SELECT "index", 'missing' AS status FROM items WHERE NOT labelled AND "index" NOT IN (SELECT "index" FROM latest)
    UNION ALL SELECT "index", 'extra' FROM latest WHERE "index" IN (SELECT "index" FROM items WHERE labelled)""",
)
def completeness(spark, sf):
    expected = items(spark, sf).filter("NOT labelled")
    return evaluation.completeness(expected, evaluation.latest(predictions(spark, sf)))


@query(
    "experiment_comparison",
    f"""{WITH}, one AS (SELECT * FROM preds QUALIFY row_number() OVER (PARTITION BY experiment, "index" ORDER BY batch_id DESC) = 1),
    m AS (SELECT o.experiment, o.kind, o.elapsed_s, o.new_tokens, coalesce(o.answer, 'None') = i.answer AS hit
      FROM one o JOIN items i USING ("index"))
    SELECT experiment, count(*) AS n, round(100.0 * avg(hit::INT), 6) AS accuracy,
      coalesce(round(100.0 * avg(hit::INT) FILTER (kind = 'count'), 6), 0) AS accuracy_count,
      coalesce(round(100.0 * avg(hit::INT) FILTER (kind = 'output'), 6), 0) AS accuracy_output,
      round(sum(elapsed_s) / nullif(count(elapsed_s), 0), 6) AS s_per_item,
      round(coalesce(sum(new_tokens), 0) / count(*), 6) AS tokens_per_item FROM m GROUP BY experiment""",
)
def experiment_comparison(spark, sf):
    c = evaluation.compare_experiments(predictions(spark, sf), items(spark, sf), ["experiment"])
    rounded = ("accuracy", "accuracy_count", "accuracy_output", "s_per_item", "tokens_per_item")
    return c.withColumns({k: F.round(k, 6) for k in rounded})


def _test_runs(spark, sf):
    """One run per experiment: two over everything, one over what was predicted."""
    base = predictions(spark, sf).drop("experiment")
    whole = items(spark, sf).select(
        "index", "question", "kind", F.lit(1).cast("bigint").alias("batch_id"), F.col("index").alias("seq"),
        F.col("answer"), F.lit("dry").alias("backend"),
    )
    blank = whole.withColumn("answer", F.when(F.col("kind") == "count", F.col("answer")).otherwise(F.lit("")))
    cols = whole.columns
    return (
        whole.withColumn("experiment", F.lit("exp1_test"))
        .unionByName(blank.withColumn("experiment", F.lit("exp2_test")))
        .unionByName(base.select(*cols).withColumn("experiment", F.lit("exp3_test")))
    )


TEST_RUNS = """truns AS (
  SELECT 'exp1_test' AS experiment, "index", kind, answer, 'dry' AS backend FROM items UNION ALL
  SELECT 'exp2_test', "index", kind, CASE WHEN kind = 'count' THEN answer ELSE '' END, 'dry' FROM items UNION ALL
  SELECT 'exp3_test', "index", kind, answer, backend FROM latest),
test AS (SELECT "index" FROM items WHERE NOT labelled),
report AS (
  SELECT experiment, 'submission_' || replace(experiment, '_test', '') || '.csv' AS file,
    count(*) FILTER (inside) AS got, (SELECT count(*) FROM test) - count(*) FILTER (inside) AS missing,
    count(*) FILTER (NOT inside) AS extra, count(*) FILTER (inside AND (answer IS NULL OR answer = '')) AS blank,
    count(DISTINCT coalesce(backend, 'None'))::INT AS backends,
    CASE WHEN count(*) FILTER (inside) < (SELECT count(*) FROM test) THEN 'incomplete'
      WHEN count(*) FILTER (inside AND (answer IS NULL OR answer = '')) > 0 THEN 'blank' ELSE 'written' END AS status
  FROM (SELECT *, "index" IN (SELECT "index" FROM test) AS inside FROM truns) GROUP BY experiment)"""


def _report(spark, sf):
    _, _, majority, support = _parts(spark, sf)
    expected = evaluation.with_kind(items(spark, sf).filter("NOT labelled"))
    runs = _test_runs(spark, sf).drop("kind")
    return evaluation.submission_report(runs, expected, support, majority, do_clamp=False)


@query("submission_report", f"{WITH}, {TEST_RUNS} SELECT * FROM report")
def submission_report(spark, sf):
    return _report(spark, sf)[0].drop("clamped")


@query(
    "submission_rows",
    f"""{WITH}, {TEST_RUNS} SELECT file, "index", answer FROM truns JOIN report USING (experiment)
    WHERE status = 'written' AND "index" IN (SELECT "index" FROM test)""",
)
def submission_rows(spark, sf):
    """Checked rows of all complete runs written as CSV, one folder per run, and read back."""
    path = _path(spark, "submissions")
    results.write_submissions(_report(spark, sf)[1], path)
    back = spark.read.schema("index bigint, answer string, file string").option("header", True).csv(path)
    return back.select("file", "index", "answer")


@query(
    "ordered_submission",
    f"""WITH {POOL} SELECT "index", answer FROM items""",
)
def ordered_submission(spark, sf):
    """Rows without blanks written in index order with a header and read back."""
    path = _path(spark, "submission") + ".csv"
    results.write_submission(items(spark, sf), path)
    return records.read_predictions(spark, path)


@query(
    "mirror_merge",
    f"""{WITH}, loc AS (SELECT "index", answer, 'local' AS side FROM latest WHERE backend = 'nf4'),
    mir AS (SELECT "index", CASE WHEN answer IS NULL THEN 'x' ELSE answer END AS answer, 'mirror' AS side FROM latest)
    SELECT * FROM loc UNION ALL SELECT * FROM mir WHERE "index" NOT IN (SELECT "index" FROM loc)""",
)
def mirror_merge(spark, sf):
    run = evaluation.latest(predictions(spark, sf))
    local = run.filter("backend = 'nf4'").select("index", "answer", F.lit("local").alias("side"))
    mirror = run.select("index", F.coalesce("answer", F.lit("x")).alias("answer"), F.lit("mirror").alias("side"))
    return records.merge_mirror(local, mirror).select("index", "answer", "side")


@query(
    "checkpoint_scan",
    f"""{WITH} SELECT "index", batch_id, answer FROM latest""",
)
def checkpoint_scan(spark, sf):
    """A JSON-lines checkpoint with blank, truncated and index-less lines among good ones."""
    path = _path(spark, "checkpoint")
    runs = predictions(spark, sf)
    line = F.to_json(F.struct("index", "question", "answer", "batch_id"))
    no_index = F.to_json(F.struct("question", "answer"))
    broken = F.substring(line, 1, 12)
    runs.sort("batch_id", "seq").select(
        F.explode(F.array(broken, line, F.lit("   "), no_index)).alias("value")
    ).write.text(path)
    return records.read_checkpoint(spark, path, RUN).select("index", "batch_id", "answer")


@query(
    "appended_checkpoint",
    f"""WITH {ITEMS}, s AS (SELECT "index", answer, 0 AS side FROM items UNION ALL
      SELECT "index", 'again', 1 FROM items WHERE "index" % 3 = 0)
    SELECT "index", arg_max(answer, side) AS answer FROM s GROUP BY "index" """,
)
def appended_checkpoint(spark, sf):
    """Two runs in one folder, without batch numbers: the file written later counts, whatever it is called."""
    path = _path(spark, "appended")
    rows = items(spark, sf).select("index", "answer")
    rows.write.json(path)
    rows.filter("index % 3 = 0").withColumn("answer", F.lit("again")).write.mode("append").json(path)
    return records.read_checkpoint(spark, path, RUN).select("index", "answer")


@query(
    "wide_digits",
    f"""WITH {ITEMS} SELECT "index", CAST(n_chars % 1000 AS VARCHAR) AS as_count FROM items""",
)
def wide_digits(spark, sf):
    """Counts written in decimal digits beyond the first 65,536 characters."""
    double_struck = "".join(chr(0x1D7D8 + d) for d in range(10))
    written = F.translate((F.col("n_chars") % 1000).cast("string"), "0123456789", double_struck)
    text = F.concat(F.lit("There are "), written, F.lit(" gates."))
    return items(spark, sf).select("index", answers.extract_count(text).alias("as_count"))


@query(
    "csv_predictions",
    f"""{WITH} SELECT "index", coalesce(trim(answer), '') AS answer FROM latest""",
)
def csv_predictions(spark, sf):
    path = _path(spark, "preds") + ".csv"
    run = evaluation.latest(predictions(spark, sf))
    padded = run.select("index", F.concat(F.lit("  "), F.coalesce("answer", F.lit("")), F.lit("\t ")).alias("answer"))
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return records.read_predictions(spark, path)


# Inference -----------------------------------------------------------------


def _answers(strategy: str, keep):
    def run(spark, sf):
        _, _, majority, _ = _parts(spark, sf)
        test = items(spark, sf).select("index", "image", "question", "kind")
        return experiments.strategies(majority)[strategy](test).select(*keep)

    return run


SRC = f"WITH {POOL}, src AS (SELECT items.*, majority FROM items LEFT JOIN maj USING (kind))"

query("constant_baseline", f"""{SRC} SELECT "index", majority AS answer FROM src""")(
    _answers("exp0_constant", ["index", "answer"])
)


@query(
    "constant_against_dummy",
    f"""WITH {POOL}, a AS (SELECT 'majority' AS run, kind, v.answer = m.majority AS hit FROM val v JOIN maj m USING (kind)
      UNION ALL SELECT 'dummy', kind, answer = CASE kind WHEN 'output' THEN 'True' ELSE '1' END FROM val)
    SELECT run, kind, count(*) AS n, count(*) FILTER (hit) AS correct FROM a GROUP BY run, ROLLUP (kind)""",
)
def constant_against_dummy(spark, sf):
    _, val, majority, _ = _parts(spark, sf)
    runs = experiments.constant(val.drop("answer"), majority).select("index", "answer", F.lit("majority").alias("run"))
    runs = runs.unionByName(experiments.dummy(val).select("index", "answer", F.lit("dummy").alias("run")))
    return evaluation.score(runs, val, ["run"]).select("run", "kind", "n", "correct")


def _single(user: str) -> str:
    gen = f"(SELECT *, {q.stand_in_text(user)} AS raw FROM src)"
    return f"""{SRC} SELECT "index", raw, parsed AS answer, least({{limit}}, {q.words('raw')})::INT AS new_tokens
    FROM ({q.clean_answer(gen, 'raw', 'parsed', 'question', 'majority')})"""


KEEP = ["index", "raw", "answer", "new_tokens"]
query("baseline_experiment", _single("question").replace("{limit}", "16"))(_answers("exp1_baseline", KEEP))
query("domain_prompt_experiment", _single("question").replace("{limit}", "16"))(_answers("exp2_prompt", KEEP))
query("stepwise_experiment", _single(f"(question {q.STEPWISE})").replace("{limit}", "128"))(_answers("exp3_cot", KEEP))

STEP = f"(question {q.STEPWISE})"
VOTES = f"""{SRC}, s AS (SELECT *, {q.stand_in_text(STEP, 'k')} AS raw FROM (SELECT *, unnest([1, 2, 3]) AS k FROM src)),
v AS ({q.clean_answer('s', 'raw', 'vote', 'question')}),
c AS (SELECT "index", vote, count(*) AS n, min(k) AS first FROM v WHERE vote IS NOT NULL GROUP BY ALL),
w AS (SELECT "index", arg_min(vote, (-n, first)) AS vote, max(n)::INT AS n FROM c GROUP BY ALL),
t AS (SELECT "index", sum(least(128, {q.words('raw')}))::INT AS new_tokens, list(vote ORDER BY k) AS votes FROM v GROUP BY "index")
SELECT "index", coalesce(vote, majority) AS answer, coalesce(n, 0) AS agreement, new_tokens,
  array_to_string(votes, ',') AS votes
FROM src LEFT JOIN w USING ("index") JOIN t USING ("index")"""


@query("self_consistency_experiment", VOTES)
def self_consistency_experiment(spark, sf):
    run = _answers("exp4_self_consistency", ["index", "answer", "agreement", "new_tokens", "votes"])(spark, sf)
    return run.withColumn("votes", F.array_join("votes", ","))


TWO = f"""{SRC}, s1 AS (SELECT *, {q.stand_in_text(STEP)} AS raw1 FROM src),
p1 AS ({q.clean_answer('s1', 'raw1', 'initial', 'question')}),
s2 AS (SELECT *, {_reviewed('raw1', 'initial')} AS u2 FROM p1),
g2 AS (SELECT *, {q.stand_in_text('u2')} AS raw2 FROM s2),
p2 AS ({q.clean_answer('g2', 'raw2', 'final', 'question')})
SELECT "index", initial AS initial_answer, coalesce(final, initial, majority) AS answer,
  initial IS DISTINCT FROM coalesce(final, initial, majority) AS changed,
  (least(128, {q.words('raw1')}) + least(128, {q.words('raw2')}))::INT AS new_tokens FROM p2"""
query("two_stage_experiment", TWO)(
    _answers("exp5_reflexion", ["index", "initial_answer", "answer", "changed", "new_tokens"])
)


@query(
    "resumed_run",
    f"""{SRC} SELECT "index", CASE WHEN lang = 'fr' THEN 1 ELSE 2 END::BIGINT AS batch_id,
      {q.stand_in_value('question')} AS answer, 'dry' AS backend FROM src""",
)
def resumed_run(spark, sf):
    """A run that was stopped after the French items, then resumed over all items."""
    _, _, majority, _ = _parts(spark, sf)
    predict = experiments.strategies(majority)["exp1_baseline"]
    everything = items(spark, sf)
    todo = everything.select("index", "image", "question", "kind", "lang")
    path, mirror = _path(spark, "run"), _path(spark, "mirror")
    experiments.run_predictions(todo.filter("lang = 'fr'"), predict, path, "dry", mirror=mirror)
    done = experiments.run_predictions(todo, predict, path, "dry", mirror=mirror)
    return done.select("index", "batch_id", "answer", "backend")


@query(
    "pending_items",
    f"""{WITH} SELECT "index" FROM items WHERE "index" NOT IN (SELECT "index" FROM latest)""",
)
def pending_items(spark, sf):
    return experiments.pending(items(spark, sf), predictions(spark, sf)).select("index")


@query(
    "user_predictions",
    f"""WITH {ITEMS} SELECT "index", (length(question) % 7)::VARCHAR AS answer, length(question)::INT AS new_tokens FROM items""",
)
def user_predictions(spark, sf):
    """A user's Python callback, built once per task, over Arrow batches."""

    def make():
        seven = 7
        return lambda item: {"answer": str(len(item["question"]) % seven), "new_tokens": len(item["question"])}

    todo = items(spark, sf).select("index", "image", "question", "kind")
    return experiments.predict_rows(todo, make).select("index", "answer", "new_tokens")


@query(
    "model_backend",
    f"""{SRC} SELECT "index", CASE WHEN kind = 'count' THEN (length(question) % 3)::VARCHAR
      WHEN length(question) % 3 = 0 THEN 'False' WHEN length(question) % 3 = 1 THEN 'True' ELSE majority END AS answer,
      3 AS new_tokens FROM src""",
)
def model_backend(spark, sf):
    """The baseline strategy with a model object behind the backend interface."""
    _, _, majority, _ = _parts(spark, sf)
    backend = experiments.ModelBackend(_make_echo, "echo")
    todo = items(spark, sf).select("index", "image", "question", "kind")
    return experiments.strategies(majority, backend)["exp1_baseline"](todo).select("index", "answer", "new_tokens")


def _make_echo():
    class Echo:
        def ask(self, image, system, user, max_new_tokens=16, temperature=None, top_p=None):
            return f"Final Answer: {len(user) % 3}", 3

    return Echo()


@query(
    "experiment_run",
    f"""WITH {POOL}, g AS (SELECT v.*, {q.stand_in_value(STEP)} AS got FROM val v)
    SELECT kind, count(*) AS n, count(*) FILTER (got = answer) AS correct, 0::BIGINT AS missing FROM g GROUP BY ROLLUP (kind)""",
)
def experiment_run(spark, sf):
    """Validation first, then the test items and their submission."""
    _, val, majority, _ = _parts(spark, sf)
    folder = _path(spark, "experiment")
    test = items(spark, sf).filter("NOT labelled")
    scores, _ = experiments.run_experiment(
        val, experiments.strategies(majority)["exp3_cot"], folder, "exp3_cot", "val", "dry",
        test=test, submission=f"{folder}/submission.csv",
    )
    return scores.select("kind", "n", "correct", "missing")


@query(
    "run_names",
    f"""WITH {ITEMS} SELECT DISTINCT source, lang,
      source || '200-lim20' || '_dry' || '_ft-' || substr(trim(regexp_replace('--' || source || ' adapter/' || lang || '..v1 long name!!', '[^A-Za-z0-9]+', '-', 'g'), '-'), 1, 24) AS tag,
      'submission_' || source || '_' || lang || '.csv' AS file FROM items""",
)
def run_names(spark, sf):
    adapter = F.concat(F.lit("--"), "source", F.lit(" adapter/"), "lang", F.lit("..v1 long name!!"))
    tag = F.concat(
        labels.split_tag(F.col("source"), F.lit(200), F.lit(20)), labels.variant_suffix(F.lit(True), adapter)
    )
    run = F.concat("source", F.lit("_"), "lang", F.lit("_test"))
    return items(spark, sf).select("source", "lang", tag.alias("tag"), labels.submission_name(run).alias("file")).distinct()

