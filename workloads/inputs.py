"""The given tables in the shapes the operators read, for Spark and for SQL.

Feature rows come from lineitem and embeddings, question items from documents,
trial and result rows from orders.  Every function reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovekit.functions.answers import COUNT, OUTPUT
from grovekit.functions.hashing import draw
from grovekit.operators.sampling import holdout
from grovekit.sources.tables import read_table

FEATURE_NAMES = ("l_quantity", "l_discount", "l_tax", "price_k")
CLASSES = (0, 1, 2)
# Fixed value: where the items name their pictures.
IMAGE_PREFIX = "kaggle_dataset/images/circuit_"
GATES = ("and", "or", "nand", "nor", "xor", "xnor")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def busy_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """For work that is heavy per row: a table of few splits is dealt out to all cores."""
    return read_table(spark, f"{sf}/{name}.parquet")


# lineitem ------------------------------------------------------------------


def cents(c: str) -> Column:
    """``round(c * 100)`` with halves away from zero, without the big decimals that Spark's ``round`` makes of doubles."""
    y = F.col(c) * 100
    even = F.rint(y)
    up = F.when(y - even == F.signum(y) * 0.5, F.signum(y)).otherwise(0.0)  # rint went to the even side, towards zero
    return (even + up).cast("bigint")


def lineitem_rows(spark: SparkSession, sf: str, busy: bool = False) -> DataFrame:
    """``row_key, features, label, status``; the key is the md5 of the whole row."""
    li = (busy_table if busy else table)(spark, sf, "lineitem")

    key = F.md5(
        F.concat_ws(
            "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            cents("l_quantity"), cents("l_extendedprice"), cents("l_discount"), cents("l_tax"),
            "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").cast("string"),
        )
    )
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return li.select(
        key.alias("row_key"),
        F.array("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice") / 1000).alias("features"),
        label.alias("label"),
        F.col("l_linestatus").alias("status"),
        F.col("l_linenumber").alias("line"),
    )


def with_holes(rows: DataFrame) -> DataFrame:
    """Lineitem rows of which the sixth line has a NULL element and the seventh no vector."""
    holed = F.transform("features", lambda v, i: F.when(i != 1, v))
    features = F.when(F.col("line") == 7, F.lit(None)).when(F.col("line") == 6, holed).otherwise(F.col("features"))
    return rows.withColumn("features", features)


LI = """li AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
      CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
      l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS row_key,
    l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_extendedprice / 1000 AS f3,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label,
    l_linestatus AS status, l_linenumber AS line
  FROM lineitem)"""

LI_COMPLETE = LI.replace("FROM lineitem)", "FROM lineitem WHERE l_linenumber < 6)")

LI_LONG = """long AS (
  SELECT row_key, label, status, 0 AS feature, f0 AS value FROM li UNION ALL
  SELECT row_key, label, status, 1, f1 FROM li UNION ALL
  SELECT row_key, label, status, 2, f2 FROM li UNION ALL
  SELECT row_key, label, status, 3, f3 FROM li)"""


def embedding_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


EMB = "emb AS (SELECT vec_id, embedding::DOUBLE[] AS features, label FROM embeddings)"
EMB_LONG = """elong AS (
  SELECT vec_id, label, unnest(range(len(features)))::INT AS feature, unnest(features) AS value
  FROM emb)"""


# documents -----------------------------------------------------------------


def items(spark: SparkSession, sf: str) -> DataFrame:
    """``index, question, kind, answer, text, lang, source, n_chars, labelled``.

    Even documents get a count question, odd ones an output question; labelled
    documents are the labelled pool, the others the test items.
    """
    docs = busy_table(spark, sf, "documents")
    labelled = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("labelled"))
    n = F.col("n_chars")
    gate = F.get(F.array(*[F.lit(g) for g in GATES]), (n % 6).cast("int"))

    def bit(c: Column) -> Column:
        return F.when(c % 2 == 0, F.lit("True")).otherwise(F.lit("False"))

    count_q = F.concat(F.lit("How many "), gate, F.lit(" gates are in this logic circuit?"))
    output_q = F.concat(
        F.lit("What is the output of this logic circuit, given the inputs x0="),
        bit(n), F.lit(", x1="), bit(F.floor(n / 2)), F.lit(", x2="), bit(F.floor(n / 4)), F.lit("?"),
    )
    even = F.col("doc_id") % 2 == 0
    return docs.join(labelled, "doc_id", "left").select(
        F.col("doc_id").alias("index"),
        F.when(even, count_q).otherwise(output_q).alias("question"),
        F.when(even, F.lit(COUNT)).otherwise(F.lit(OUTPUT)).alias("kind"),
        F.when(even, (n % 8).cast("string")).otherwise(bit(n)).alias("answer"),
        F.concat(F.lit(IMAGE_PREFIX), F.col("doc_id").cast("string"), F.lit(".png")).alias("image"),
        "text",
        "lang",
        "source",
        "n_chars",
        F.coalesce("labelled", F.lit(False)).alias("labelled"),
    )


ITEMS = f"""items AS (
  SELECT d.doc_id AS "index",
    CASE WHEN d.doc_id % 2 = 0
      THEN 'How many ' || ['and','or','nand','nor','xor','xnor'][n_chars % 6 + 1]
        || ' gates are in this logic circuit?'
      ELSE 'What is the output of this logic circuit, given the inputs x0='
        || CASE WHEN n_chars % 2 = 0 THEN 'True' ELSE 'False' END || ', x1='
        || CASE WHEN (n_chars // 2) % 2 = 0 THEN 'True' ELSE 'False' END || ', x2='
        || CASE WHEN (n_chars // 4) % 2 = 0 THEN 'True' ELSE 'False' END || '?' END AS question,
    CASE WHEN d.doc_id % 2 = 0 THEN 'count' ELSE 'output' END AS kind,
    CASE WHEN d.doc_id % 2 = 0 THEN CAST(n_chars % 8 AS VARCHAR)
      WHEN n_chars % 2 = 0 THEN 'True' ELSE 'False' END AS answer,
    '{IMAGE_PREFIX}' || d.doc_id || '.png' AS image,
    text, lang, source, n_chars,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS labelled
  FROM documents d)"""


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled items with their seeded ``split`` into train and val."""
    return holdout(items(spark, sf).filter("labelled"), "index", 0.25, 42)


POOL = ITEMS + """,
pool AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42|' || "index"), "index")
      <= floor(count(*) OVER () * 0.25) THEN 'val' ELSE 'train' END AS split
  FROM items WHERE labelled),
train AS (SELECT * FROM pool WHERE split = 'train'),
val AS (SELECT * FROM pool WHERE split = 'val'),
maj AS (
  SELECT kind, arg_min(answer, (-n, first)) AS majority FROM (
    SELECT kind, answer, count(*) AS n, min("index") AS first FROM train GROUP BY ALL)
  GROUP BY kind),
support AS (SELECT DISTINCT kind, answer FROM train)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A run over all items but the Spanish ones; French items were run twice.

    Answers are drawn per (index, batch); some are blank or out of range, and
    some records were not timed.
    """
    base = items(spark, sf).filter("lang <> 'es'")
    last = F.when(F.col("lang") == "fr", 2).otherwise(1).cast("bigint")
    runs = base.withColumn("batch_id", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))
    u = draw("pred", F.col("index"), F.col("batch_id"))
    count_answer = F.when(u % 12 == 11, F.lit(None)).otherwise((u % 12).cast("string"))
    bool_answer = F.when(u % 7 == 0, F.lit("")).when(u % 2 == 0, F.lit("True")).otherwise(F.lit("False"))
    return runs.select(
        "index",
        "question",
        "kind",
        "batch_id",
        F.col("index").alias("seq"),
        F.when(F.col("kind") == COUNT, count_answer).otherwise(bool_answer).alias("answer"),
        F.when(F.col("source") != "src1", F.col("n_chars") / 1000).alias("elapsed_s"),
        F.when(F.col("source") == "src0", F.lit("nf4")).when(F.col("source") != "src2", F.lit("fp32")).alias("backend"),
        F.when(F.col("source") != "src3", (F.col("n_chars") % 100).cast("int")).alias("new_tokens"),
        F.col("text").alias("raw"),
        F.concat(F.lit("exp_"), F.col("source")).alias("experiment"),
    )


PREDS = """runs AS (
  SELECT *, unnest(CASE WHEN lang = 'fr' THEN [1, 2] ELSE [1] END)::BIGINT AS batch_id
  FROM items WHERE lang <> 'es'),
drawn AS (
  SELECT *, ('0x' || substr(md5('pred|' || "index" || '|' || batch_id), 1, 12))::BIGINT AS u FROM runs),
preds AS (
  SELECT "index", question, kind, batch_id, "index" AS seq,
    CASE WHEN kind = 'count' THEN CASE WHEN u % 12 = 11 THEN NULL ELSE CAST(u % 12 AS VARCHAR) END
      WHEN u % 7 = 0 THEN '' WHEN u % 2 = 0 THEN 'True' ELSE 'False' END AS answer,
    CASE WHEN source <> 'src1' THEN n_chars / 1000 END AS elapsed_s,
    CASE WHEN source = 'src0' THEN 'nf4' WHEN source <> 'src2' THEN 'fp32' END AS backend,
    CASE WHEN source <> 'src3' THEN n_chars % 100 END AS new_tokens,
    text AS raw, 'exp_' || source AS experiment
  FROM drawn),
latest AS (
  SELECT * FROM preds QUALIFY row_number() OVER (
    PARTITION BY "index" ORDER BY batch_id DESC, seq DESC) = 1)"""


# orders --------------------------------------------------------------------


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Search results, one per order: drawn configuration, accuracy from the price."""
    o = table(spark, sf, "orders")
    d = lambda axis: draw(f"cfg|{axis}", F.col("o_orderkey"))

    def pick(axis: str, values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), (d(axis) % len(values)).cast("int"))

    split = pick("split", SPLIT_LABELS)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.select(
        F.col("o_orderkey").alias("number"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        split.alias("split"),
        pick("gain", ("gini", "entropy")).alias("gain"),
        pick("depth", (4, 8, 12)).alias("max_depth"),
        F.when(d("lda") % 2 == 0, F.lit(2)).alias("lda"),
        F.lit(100).alias("tree_count"),
        pick("feats", (15, 20, 25)).alias("features_per_tree"),
        F.lit(0.8).alias("samples_fraction"),
        F.lit(True).alias("repeated_sampling"),
        (F.lit(3000) + cents % 5000).alias("acc_bp"),
        F.when(F.col("o_orderstatus") != "P", F.lit("ok")).otherwise(F.lit("erro: lost")).alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("COMPLETE"))
        .when(F.col("o_orderstatus") == "O", F.lit("PRUNED"))
        .otherwise(F.lit("RUNNING"))
        .alias("state"),
    ).withColumn("acc_mean", F.col("acc_bp") / 10000)


SPLIT_LABELS = ("orthogonal", "PCA-c5", "PCA-c10", "SVM-linear-C1.0", "SVM-rbf-C1.0", "SVM-poly-C1.0")


def _cfg(axis: str) -> str:
    return f"('0x' || substr(md5('cfg|{axis}|' || o_orderkey), 1, 12))::BIGINT"


RESULTS = f"""results AS (
  SELECT *, acc_bp / 10000 AS acc_mean,
    split || '|gain=' || gain || '|depth=' || max_depth || '|lda=' || coalesce(lda::VARCHAR, 'None')
      || '|trees=100|feats=' || features_per_tree || '|frac=0.8|boot=True' AS config_key
  FROM (SELECT o_orderkey AS number, o_orderdate AS "timestamp",
    {list(SPLIT_LABELS)}[{_cfg('split')} % 6 + 1] AS split,
    ['gini','entropy'][{_cfg('gain')} % 2 + 1] AS gain,
    [4,8,12][{_cfg('depth')} % 3 + 1] AS max_depth,
    CASE WHEN {_cfg('lda')} % 2 = 0 THEN 2 END AS lda,
    [15,20,25][{_cfg('feats')} % 3 + 1] AS features_per_tree,
    3000 + CAST(round(o_totalprice * 100) AS BIGINT) % 5000 AS acc_bp,
    CASE WHEN o_orderstatus <> 'P' THEN 'ok' ELSE 'erro: lost' END AS status,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'PRUNED' ELSE 'RUNNING' END AS state
  FROM orders))"""


def trial_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Three fold accuracies and times per trial: ``number, state, fold, acc, fit_s, pred_s``."""
    bp = F.col("acc_bp")
    return results(spark, sf).withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(3)]))).select(
        "number",
        "state",
        "status",
        "fold",
        ((bp + F.col("fold") * 37 + F.col("number") * F.col("fold") % 101) / 10000).alias("acc"),
        (bp % 97 + F.col("fold")).cast("double").alias("fit_s"),
        (bp % 13 + F.col("fold")).cast("double").alias("pred_s"),
    )


FOLDS = RESULTS + """,
folds AS (
  SELECT number, state, status, fold, (acc_bp + fold * 37 + number * fold % 101) / 10000 AS acc,
    (acc_bp % 97 + fold)::DOUBLE AS fit_s, (acc_bp % 13 + fold)::DOUBLE AS pred_s
  FROM results, (SELECT unnest([0, 1, 2]) AS fold))"""
