"""Suffix-array, substring and line dedup, and the Jaccard join, against plain versions."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grovekit.llm import common, jaccard, lines, substrings, suffixes
from tests.llm import brute


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


def test_substrings(spark, rows):
    kept = substrings.dedup_substrings(brute.frame(spark, rows), k=7, m=3).collect()
    gone = brute.repeated([r[1] for r in rows], 7, brute.WORD.findall)
    want = []
    for r, g in zip(rows, gone):
        words = brute.WORD.findall(r[1] or "")
        want.append((r[0], " ".join(w for w, x in zip(words, g) if not x), len(words), sum(g)))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text, r.n_words, r.n_removed)) for r in kept)


@pytest.mark.parametrize("dedup", [substrings.dedup_substrings, suffixes.dedup_suffixes])
def test_many_repeated_rows(spark, dedup):
    """Lists stay as long as one row's, however many rows repeat it: thousands under a null id are no square."""
    text = " ".join(f"word{i}" for i in range(400))
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    docs = docs.union(spark.createDataFrame([(1, "alone " * 3 + "here")], "doc_id long, text string"))
    got = dedup(docs).groupBy("doc_id", "n_removed").count().collect()
    size = 400 if dedup is substrings.dedup_substrings else len(text)
    assert sorted((r.doc_id or 0, r.n_removed, r["count"]) for r in got) == [(0, size, 3000), (1, 0, 1)]


def test_split_minimisers_give_the_same(spark, rows):
    df = brute.frame(spark, rows)
    found = [sorted(map(repr, substrings.dedup_substrings(df, 7, 3, hot).collect())) for hot in (0, 20_000)]
    assert found[0] == found[1]


def test_suffixes(spark, rows):
    kept = suffixes.dedup_suffixes(brute.frame(spark, rows)).collect()
    gone = brute.repeated([r[1] for r in rows], 200, str.encode)
    want = []
    for r, g in zip(rows, gone):
        raw = (r[1] or "").encode()
        want.append((r[0], bytes(b for b, x in zip(raw, g) if not x), len(raw), sum(g)))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed)) for r in kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_of_periodic_and_similar_texts(spark, seed):
    rng = random.Random(seed)
    texts = ["ab" * 300, "ab" * 301 + "c" * 250, "c" * 500, "".join(rng.choice("ab") for _ in range(3000))]
    texts += [texts[3][rng.randrange(200) : 2000 + rng.randrange(900)] for _ in range(4)]
    for t in texts[4:]:
        at = rng.randrange(len(t))
        texts.append(t[:at] + "z" + t[at + rng.randrange(3) :])
    table = [(i, t, "x", "y", 0) for i, t in enumerate(texts)]
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.dedup_suffixes(brute.frame(spark, table)).collect()}
    for i, (t, g) in enumerate(zip(texts, brute.repeated(texts, 200, str.encode))):
        assert kept[i] == bytes(b for b, x in zip(t.encode(), g) if not x), i


@pytest.mark.parametrize("k", [8, 20, 24, 72, 136, 200, 217])
def test_names_are_ranks(k):
    from grovekit.llm.suffix_array import suffix_names

    rng = random.Random(k)
    data = bytes(rng.choice(b"a\x00\xff") for _ in range(300)) * 2 + b"ab" * 300 + b"c" * 250
    starts = np.array(rng.sample(range(len(data) - k + 1), 900))
    strings = [data[s : s + k] for s in starts]
    ranks = {x: i for i, x in enumerate(sorted(set(strings)))}
    assert suffix_names(np.frombuffer(data, np.uint8), starts, k).tolist() == [ranks[x] for x in strings]


def test_split_samples_give_the_same(spark, rows):
    df = brute.frame(spark, rows)
    found = [sorted(map(repr, suffixes.dedup_suffixes(df, hot=hot).collect())) for hot in (0, 20_000)]
    assert found[0] == found[1]


def test_suffixes_write_less_than_the_text(spark, monkeypatch):
    """All steps together write fewer bytes than the texts have, so that disk stays within a small multiple."""
    rng = random.Random(3)
    line = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [line(900) for _ in range(60)]
    texts = ["".join(line(900) + rng.choice(shared) for _ in range(40)) for _ in range(20)]
    sizes, write = [], common.materialize

    def weighed(df):
        table = write(df)
        path = table.written_path.removeprefix("file:")
        sizes.append(sum(os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(path) for x in names if x.endswith(".parquet")))
        return table

    monkeypatch.setattr(common, "materialize", weighed)
    df = brute.frame(spark, [(i, t, "x", "y", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: r.n_removed for r in suffixes.dedup_suffixes(df).collect()}
    assert all(got[i] >= 39 * 900 for i in range(len(texts)))
    assert sum(sizes) < sum(map(len, texts)), sizes


def test_suffixes_refuse_short_strings(spark, rows):
    with pytest.raises(ValueError):
        suffixes.dedup_suffixes(brute.frame(spark, rows), k=50)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_lines(spark, rows, k):
    left = brute.later_lines(rows, k)
    got = lines.dedup_lines(brute.frame(spark, rows), k).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == "\n".join(left[r.doc_id, r.row.text or ""])
        own = [x for x in (r.row.text or "").split("\n") if brute.WORD.search(x)]
        assert r.n_lines == len(own) and r.n_removed == sum(x.length for x in r.runs or [])


def test_lines_keep_columns(spark, rows):
    df = brute.frame(spark, rows)
    left = lines.delete_later_lines(df)
    assert left.columns == df.columns
    kept = brute.later_lines(rows, 2)
    whole = sum(any(map(brute.WORD.search, kept[r[0], r[1] or ""])) or not brute.WORD.search(r[1] or "") for r in rows)
    got = left.collect()
    assert len(got) == whole
    assert all(r.n_chars in (None, 0) or r.n_chars == len(r.text) for r in got)


def test_long_lines_count_alone(spark, rows):
    """Long lines between differing neighbours, alone in a text, without spaces, at the limits, and in one text twice."""
    rng = random.Random(7)
    line = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    long, short, spaceless, tiny = line(50), line(49), "\u8a9e" * 134, " ".join(f"{i % 10}" for i in range(50))
    texts = [f"{line(3)}\n{x}\n{line(3)}" for x in (long, short, spaceless, tiny, "\u8a9e" * 133) for _ in range(3)]
    texts += [long, long, short, short, f"{tiny}\n{line(2)}\n\n{tiny}\n{line(2)}"]
    table = [*rows, *[(1000 + i, t, "x", "y", len(t)) for i, t in enumerate(texts)], (None, long, "x", "y", 0)]
    left = brute.later_or_long_lines(table, 2, 50, 400)
    df = brute.frame(spark, table)
    got = lines.dedup_lines(df, 2, 50).collect()
    assert len(got) == len(table)
    for r in got:
        assert r.text == "\n".join(left[r.doc_id, r.row.text or ""])
    kept = "\n".join(r.text for r in got).split("\n")
    assert [kept.count(x) for x in (long, short, spaceless, tiny)] == [1, 5, 1, 1]
    stay = {(d, t) for (d, t), x in left.items() if any(map(brute.WORD.search, x)) or not brute.WORD.search(t)}
    docs = lines.delete_later_lines(df, 2, 50).collect()
    assert len(docs) == sum((r[0], r[1] or "") in stay for r in table)


def test_jaccard(spark, rows):
    got = jaccard.join_documents(brute.frame(spark, rows)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [brute.shingles(r[1]) for r in ordered]
    want = [(r[0], len(s), ordered[c][0]) for r, s, c in zip(ordered, sets, brute.components(sets))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got)


def test_jaccard_of_a_large_group(spark):
    """Near copies of one text, of which many link only through others."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    table = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        table.append((i, " ".join(w), "x", "y", 0))
    got = {r.doc_id: r.component_id for r in jaccard.join_documents(brute.frame(spark, table)).collect()}
    assert got == dict(enumerate(brute.components([brute.shingles(r[1]) for r in table])))


def test_jaccard_keeps_one(spark, rows):
    df = brute.frame(spark, rows)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=brute.key)
    sets = [brute.shingles(t) for _, t in docs]
    # Of each component the first document stays, under a lowest id of null.
    stay = {docs[c] for c in brute.components(sets)}
    got = kept.collect()
    assert {(r.doc_id, r.text or "") for r in got} == stay
    assert len(got) == sum((r[0], r[1] or "") in stay for r in rows)


def test_jaccard_keeps_one_row(spark, rows):
    """Rows that repeat id and text, also under a null id, leave one row, and the same one however they are dealt out."""
    text = " ".join(f"r{i}" for i in range(40))
    table = rows + [(5000, text, "en", f"s{i}", 0) for i in range(300)] + [(None, text + " end", None, f"n{i}", 0) for i in range(200)]
    table += [(None, "null twice", None, None, i) for i in (3, 2)] + [(5001, text, "en", "a", 0), (5002, None, None, None, 0)]
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    found = []
    for n in (2, 5):
        df = brute.frame(spark, table).repartition(n)
        kept = stage(spark, df, "")
        assert kept.columns == df.columns
        found.append(kept.collect())
    ordered = sorted(table, key=brute.key)
    sets = [brute.shingles(r[1]) for r in ordered]
    first = brute.components(sets)
    want = [(r[0], r[1] or "") for i, r in enumerate(ordered) if first[i] == i or not sets[i]]
    for got in found:
        assert sorted((r.doc_id, r.text or "") for r in got if r.doc_id is not None) == sorted(x for x in want if x[0] is not None)
        assert sorted(r.text or "" for r in got if r.doc_id is None) == sorted(t for d, t in want if d is None)
        assert {r.n_chars for r in got if r.text == "null twice"} == {2}
    assert sorted(map(repr, found[0])) == sorted(map(repr, found[1]))


@pytest.mark.parametrize("run", [
    suffixes.dedup_suffixes, substrings.dedup_substrings, lines.dedup_lines, lines.delete_later_lines,
    jaccard.join_documents, jaccard.keep_one,
])
def test_empty_table(spark, run):
    assert run(brute.frame(spark, [])).count() == 0
