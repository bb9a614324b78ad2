"""Periodic runs, shards and the source audit, against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grovekit.llm import divergence, periodic, queries, shards
from tests.llm import brute


def plain_runs(words, repeats=4, shortest=6):
    """``start, length, period`` of every run, by trying each period along the whole sequence."""
    smallest = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(shortest, repeats * q):
                smallest.setdefault((start, length), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def runs_in(sequences, repeats=4):
    ids = np.array([w for s in sequences for w in s], np.int64)
    owner, *columns = periodic.runs_of(ids, np.array([len(s) for s in sequences], np.int64), repeats)
    found = [[] for _ in sequences]
    for d, *run in zip(owner.tolist(), *[c.tolist() for c in columns]):
        found[d].append(tuple(run))
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5), st.integers(3, 5))
def test_runs_of_small_alphabets(sequences, repeats):
    assert runs_in(sequences, repeats) == [plain_runs(s, repeats) for s in sequences]


def test_runs_of_long_periods():
    rng = random.Random(3)
    sequences = [[7] * 5000, [], [1, 2] * 700 + [3] + [2, 1] * 700]
    for p in (1, 2, 7, 30, 171):
        once = [rng.randrange(40) for _ in range(p)]
        sequences.append([rng.randrange(40) for _ in range(50)] + once * (900 // p) + once[: p // 2])
    for rounds in (9, 14):  # words whose runs nest: Fibonacci and period doubling
        a, b = [0], [0, 1]
        for _ in range(rounds):
            a, b = b, b + a
        sequences.append(b * 4)
    assert runs_in(sequences) == [plain_runs(s) for s in sequences]


def test_chunks_and_slices_do_not_matter(spark, monkeypatch):
    rng = random.Random(5)
    sequences = [[rng.randrange(2) for _ in range(rng.randrange(120))] for _ in range(30)]
    whole = runs_in(sequences)
    monkeypatch.setattr(periodic, "CHUNK", 7)
    assert runs_in(sequences) == whole
    import pyarrow as pa

    monkeypatch.setattr(periodic, "SLICE_WORDS", 3)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": ["a" * n for n in (0, 5, 90, 0, 0, 3, 3, 3, 11)]})
    cut = list(periodic.slices(iter([batch, batch.slice(0, 0)])))
    assert [d for b in cut for d in b.column(0).to_pylist()] == list(range(9)) and len(cut) > 3


def test_find_runs(spark):
    rows = brute.corpus() + [(900, "go on " * 9 + "x\n" + "ha " * 4000, "en", "s", 0), (900, " a\x0b" * 30, "en", "s", 0)]
    rows += [(901, "\x1cb \xa0 " * 12, None, None, None)]
    want = []
    for d, text, *_ in rows:
        words = brute.WORD.findall(text or "")
        runs = plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((d, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    found = periodic.find_runs(brute.frame(spark, rows)).collect()
    got = [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert any(runs for _, _, runs, _ in want)
    assert periodic.find_runs(brute.frame(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(brute.frame(spark, rows), repeats=2)


def test_repeating_documents(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37)) + "\n", "en", "s", 0) for i in range(200)]
    rows += [(i, None, "en", "s", 0) for i in range(200, 260)] + [(None, "a b c", "en", "s", 0)]
    for r in queries.repeating(spark.createDataFrame(rows, brute.SCHEMA)).collect():
        text = dict((x[0], x[1]) for x in rows)[r.doc_id]
        words = brute.WORD.findall(text or "")
        h = -1 if r.doc_id is None else zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert brute.WORD.findall(r.text or "") == words


def plain_shards(rows, n):
    keys = sorted(
        (d is not None, d or 0, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in ((r[0], r[1] or "") for r in rows)
    )
    total, begin, slots, out = sum(k[2] for k in keys), 0, Counter(), []
    for known, d, size, crc in keys:
        k = min(n - 1, n * (2 * begin + size) // (2 * total))
        out.append((d if known else None, size, crc, k, slots[k]))
        slots[k] += 1
        begin += size
    return sorted(map(repr, out))


@pytest.mark.parametrize("n", [1, 8, 500])
def test_shards(spark, n):
    rows = brute.corpus() + [(3, "again", "x", "y", 0)] * 40
    got = [tuple(r) for r in shards.shard_rows(brute.frame(spark, rows), n).collect()]
    assert sorted(map(repr, got)) == plain_shards(rows, n)
    if n == 8:
        size = Counter()
        for _, s, _, k, _ in got:
            size[k] += s
        assert max(size.values()) - min(size.values()) <= 2 * max(r[1] for r in got)
    assert shards.shard_rows(brute.frame(spark, rows).limit(0), n).count() == 0


def test_written_shards(spark, tmp_path):
    rows = brute.corpus()
    docs = brute.frame(spark, rows).withColumn("shard", docs_shard())
    shards.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(repr(tuple(r.row)) for r in back.collect()) == sorted(repr(tuple(r)) for r in docs.collect())
    for k in range(4):
        slots = [r.slot for r in back.filter(f"shard = {k}").collect()]
        assert sorted(slots) == list(range(len(slots)))


def docs_shard():
    from pyspark.sql import functions as F

    return F.lit("own")


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(lower))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        within = Counter(t for g, _, ts in docs if g == lang for t in set(ts))
        kept = {t for t, n in within.items() if n >= least}
        counts = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, ts in docs:
            if g == lang:
                counts[s].update(t for t in ts if t in kept)
        total = sum(counts.values(), Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        of, q = {s: shares(c) for s, c in counts.items()}, shares(total)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(sum(far(of[s][t], of[o][t]) for t in kept), o) for o in counts if o != s]
            term = [(far(of[s][t], q[t]), t) for t in kept if counts[s][t] > 0 and of[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found[:most])]
    return sorted(map(repr, out))


@pytest.mark.parametrize("edge", [(32, 4096), (2, 3)])
def test_audit(spark, monkeypatch, edge):
    monkeypatch.setattr(divergence, "SOURCES", edge[0])
    monkeypatch.setattr(divergence, "TERMS", edge[1])
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = random.Random(2)
    words = ["ab", "Cd", "Éa", "éa", "x1y", "o'k", "日本", "ſ", "K", "z_"] + [f"w{chr(97 + i)}" for i in range(12)]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice([None, "", "s0", "s0", "s1", "s2", "É", "s9"])
        rows.append((i % 50, " ".join(rng.choice(words) for _ in range(rng.randrange(30))), lang, source, 0))
    rows += [rows[3]] * 12 + [(None, None, "fr", f"s{k}", 0) for k in range(3)] + [(1, "only once", "it", "s", 0)]
    got = divergence.audit_sources(brute.frame(spark, rows), 10, 4).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain_audit(rows, 10, 4)
    assert divergence.audit_sources(brute.frame(spark, rows).limit(0)).count() == 0
