import pytest
from pyspark.sql import functions as F

from grovekit.functions import answers, labels, masks, prompts

QUESTION = "What is the output of this logic circuit, given the inputs x0=True, x1=False?"

GOLDEN = [
    ("True", "output", "True"),
    ("false", "output", "False"),
    ("2", "count", "2"),
    ("There are 12 and gates.", "count", "12"),
    ("02", "count", "2"),
    ("000", "count", "0"),
    ("zero", "count", "0"),
    ("Yes", "output", "True"),
    ("1", "output", "True"),
    ("Final Answer: [True]", "output", "True"),
    ("Step 1: gate 3 is AND. Step 2: gate 4 is OR.\nFinal Answer: 5", "count", "5"),
    ("I see gate 1, gate 2, so there are 3 nor gates", "count", "3"),
    ("Final Answer: True\nOn reflection the NAND was misread.\nFinal Answer: False", "output", "False"),
    ("given the inputs x0=False, x1=False, x2=False. Final Answer: True", "output", "True"),
    ("given x0=False, x1=True", "output", None),
    ("no idea", "count", None),
    # Word boundaries and white space are those of Unicode.
    ("éno yesé", "output", None),
    ("final answer – yes", "output", "True"),
    ("Final Answer: none true", "output", "True"),
    ("Final Answer: 3\x85 4", "count", "3"),
    ("٣", "count", "3"),
    ("TRUE then FALSE", "output", "False"),
    ("maybe 4 or 7", None, "7"),
    ("0 of 7", None, "False"),
    ("seven Ten", "count", "10"),
    (None, "count", None),
]


def test_golden_cases(spark):
    rows = [(i, t, k) for i, (t, k, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "i int, text string, kind string")
    got = answers.with_clean_answer(df, "text", F.col("kind")).orderBy("i").collect()
    assert [r["answer"] for r in got] == [e for _, _, e in GOLDEN]


def test_default_and_question_echo(spark):
    rows = [("not sure", QUESTION), (f"{QUESTION} False", f"  {QUESTION}\n"), (f"False. {QUESTION} hm", QUESTION)]
    df = spark.createDataFrame(rows, "text string, q string")
    got = answers.with_clean_answer(df, "text", None, F.col("q"), F.lit("dflt")).collect()
    assert [r["answer"] for r in got] == ["dflt", "False", "dflt"]


def test_default_for_counts(spark):
    df = spark.createDataFrame([("no idea",)], "text string")
    got = answers.with_clean_answer(df, "text", F.lit("count"), None, F.lit("0")).first()
    assert got["answer"] == "0"


def test_question_kind_raises_on_unknown(spark):
    df = spark.createDataFrame([("\t How many and gates?",), ("what else",)], "q string")
    lenient = df.select(answers.question_kind(F.col("q"), strict=False).alias("k")).collect()
    assert [r["k"] for r in lenient] == ["count", None]
    with pytest.raises(Exception, match="unknown question"):
        df.select(answers.question_kind(F.col("q"))).collect()


def test_asked_gate(spark):
    df = spark.createDataFrame([("how MANY XNOR gates are",), ("none",)], "q string")
    assert [r[0] for r in df.select(answers.asked_gate(F.col("q"))).collect()] == ["xnor", None]


@pytest.mark.parametrize(
    "tokens, marker, expected",
    [
        ([7, 8, 1, 2], [7, 8], [-100, -100, 1, 2]),
        ([1, 7, 8, 2], [7, 8], [-100, -100, -100, 2]),
        ([1, 7, 8, 2, 7, 8, 3], [7, 8], [-100, -100, -100, 2, 7, 8, 3]),
        ([1, 2, 3], [7, 8], [1, 2, 3]),
        ([7, 7, 8, 4, 0, 0], [7, 8], [-100, -100, -100, 4, -100, -100]),
        ([7], [7, 8], [7]),
    ],
)
def test_loss_labels(spark, tokens, marker, expected):
    df = spark.createDataFrame([(tokens, marker)], "t array<int>, m array<int>")
    got = df.select(masks.loss_labels(F.col("t"), F.col("m"), F.lit(0)).alias("l")).first()
    assert got["l"] == expected


def test_stand_in_value_is_md5_modulo(spark):
    import hashlib

    users = [f"How many x{i} gates" for i in range(40)] + [f"What {i}" for i in range(40)]
    df = spark.createDataFrame([(u,) for u in users], "u string")
    got = [r[0] for r in df.select(prompts.stand_in_answer(F.col("u"), F.lit(3))).collect()]

    def want(u):
        v = int(hashlib.md5(f"{u}|3".encode()).hexdigest(), 16)
        return str(v % 5) if "How many" in u else str(v % 2 == 1)

    assert got == [want(u) for u in users]


def test_labels_round_trip(spark):
    texts = ["orthogonal", "PCA-c5", "SVM-rbf-C1.0", "SVM-linear-C0.0402", "strange"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select(labels.split_label(labels.split_from_label(F.col("t"))).alias("b")).collect()
    assert [r["b"] for r in back] == [*texts[:4], None]


def test_names(spark):
    df = spark.createDataFrame([("exp3_cot_test", "/Lora out!!v1 with a very long tail name")], "r string, a string")
    row = df.select(
        labels.submission_name(F.col("r")).alias("f"),
        labels.variant_suffix(F.lit(True), F.col("a")).alias("s"),
        labels.variant_suffix(F.lit(False), F.lit(None).cast("string")).alias("e"),
        labels.split_tag(F.lit("val"), F.lit(None), F.lit(20)).alias("t"),
        labels.lda_from_text(F.lit("2.0")).alias("l"),
        labels.lda_from_text(F.lit("nan")).alias("n"),
    ).first()
    assert tuple(row) == ("submission_exp3_cot.csv", "_dry_ft-Lora-out-v1-with-a-very-", "", "val-lim20", 2, None)
