"""The whole pipeline on the smallest tables, against plain versions of its stages."""

from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from grovekit.llm import lines, quality
from grovekit.llm.contamination import Words, allowed, nearest_end
from tests.llm import brute


def test_stages_and_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs.limit(0), sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0


def test_pipeline(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    judged = quality.judge(table, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    good = {r.doc_id for r in judged if r.kept}
    rows = [(r.doc_id, r.text) for r in table.collect() if r.doc_id in good]
    left = brute.later_or_long_lines(rows, 2, lines.LONG_WORDS, lines.LONG_WORDS * lines.WORD_BYTES)
    rows = [(d, "\n".join(left[d, t])) for d, t in rows if any(map(brute.WORD.search, left[d, t]))]
    rows.sort()
    firsts = brute.components([brute.shingles(t) for _, t in rows])
    rows = [r for i, r in enumerate(rows) if firsts[i] == i]
    words = Words()
    items = [words(r.text).tolist() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [
        (d, t) for d, t in rows
        if all(nearest_end(x, words(t).tolist())[0] > allowed(len(x), 0.2) for x in items)
    ]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = {d: encode(t, add_special_tokens=False).ids + [0] for d, t in rows}
    got: dict[int, list] = {}
    for p in sorted(corpus_pipeline.run(spark, sf).collect(), key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(got.setdefault(p.doc_id, []))
        got[p.doc_id] += p.ids
    assert got == want
