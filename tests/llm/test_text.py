"""Token files, packing, contamination, toxicity, quality and licenses against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from grovekit.llm import contamination, huffman, licenses, packing, quality, toxicity
from grovekit.llm.tokens import Encoder, at_white_space, before_spaces
from tests.llm import brute

WORDS, BYTES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


@pytest.mark.parametrize(("path", "cut"), [(WORDS, at_white_space), (BYTES, before_spaces)])
def test_encoder(rows, path, cut):
    texts = [r[1] or "" for r in rows]
    texts += ["a\nb", "a\n\nb", "é\né x\n", "\na", "a\n b", "a \nb", "a\u2028\nb", "end.\nNext 12\n34"]
    texts += ["a  b\n\n c\td  ", "don't  stop. <|endoftext|> z", " x  é é ü", "é Σ ΑΣ", "x　y z", "tab\t x", "é ́y"]
    texts += ["J\u030c. A\u0301,x É.É İstanbul İ. Ab.C×. a÷. <|ENDOFTEXT|>. x.<|endoftext|>y", "E.g. it's. IT'S, 3.14$ ###a#", "Σ. ΑΣ, ǅ. ŉa. ß.", "", " ", "\x1c.a"]
    encode = Encoder(path, cut, limit=50)
    got = [ids.tolist() for k in range(0, len(texts), 7) for ids, _ in encode(texts[k : k + 7])]
    assert got == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, rows):
    got = huffman.round_trip(brute.frame(spark, rows), WORDS, 2).collect()
    encode = Tokenizer.from_file(WORDS).encode
    want = sorted((r[0] is not None, r[0] or 0, encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows)
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d if known else None for known, d, _ in want]
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens


@pytest.mark.parametrize("counts", [[1], [3, 1], [1, 1, 2, 3, 5, 8, 13, 21, 34, 55], [7] * 9, [10**9, 1, 1, 1, 1]])
@pytest.mark.parametrize("most", [4, 18])
def test_code_lengths(counts, most):
    lengths = huffman.code_lengths(np.array(counts), most)
    assert lengths.max() <= most and (sum(2.0**-lengths) == 1 or len(counts) == 1)
    ids = np.repeat(np.arange(len(counts)), np.minimum(counts, 50)) * 3
    np.random.default_rng(0).shuffle(ids)
    code = huffman.Code(np.arange(len(counts)) * 3, lengths)
    offsets, bits = code.encode(ids, 8)
    assert code.decode(len(ids), offsets, 8, bits).tolist() == ids.tolist()
    if most == 18:  # no limit for so few symbols: the total is that of plain Huffman merging
        heap, total = sorted(counts), 0
        while len(heap) > 1:
            a = heap.pop(0) + heap.pop(0)
            total += a
            heap = sorted([*heap, a])
        assert len(counts) == 1 or total == int((lengths * counts).sum())


def test_packing(spark, rows):
    pieces = packing.pack_documents(brute.frame(spark, rows), BYTES, size=64, stretch=50).collect()
    encode = Tokenizer.from_file(BYTES).encode
    want = sorted((str(r[0]), encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows)
    sequences, whole = {}, []
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    held = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = [] if p.start == 0 else held.pop(str(p.doc_id))
        assert len(ids) == p.start
        ids += p.ids
        if len(ids) == p.doc_tokens:
            whole.append((str(p.doc_id), ids))
        else:
            held[str(p.doc_id)] = ids
    assert not held and sorted(whole) == want


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        places = np.array(sorted({0, *(rng.randrange(1, 60) for _ in range(14))}))
        places, cost = packing.with_bridges(places, np.array([rng.choice([0.0, 2.0, 5.0]) for _ in places]), 16, 7.0)
        best = {0: 0.0}
        for j in range(1, len(places)):
            best[j] = min(
                best[i] + (0 if (n := int(places[j] - places[i])).bit_count() == 1 else 16 - n) + cost[j]
                for i in range(j)
                if places[j] - places[i] <= 16
            )
        cuts, total, at = packing.choose_cuts(places, cost, 16), 0.0, 0
        for j in cuts:
            n = int(places[j]) - at
            total += (0 if n.bit_count() == 1 else 16 - n) + cost[j]
            at = int(places[j])
        assert cuts[-1] == len(places) - 1 and total == best[len(places) - 1]


def test_contamination(spark, rows):
    rng = random.Random(7)
    items = [" ".join(f"b{rng.randrange(10**4)}" for _ in range(n)) for n in (14, 30, 59, 20, 3)]
    edited = []
    for text in items[:4]:
        w = text.split()
        for _ in range(len(w) // 7):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [f"c{rng.randrange(100)}"][: rng.randint(0, 1)]
        edited.append(" ".join(w))
    table = rows + [(900, "start of it. " + items[0].upper() + "! and more", "x", "y", 0)]
    table += [(901 + i, f"{' '.join(brute.WORD.findall(rows[i][1] or '')[:40])} {t} tail {rows[-i - 1][1]}", "x", "y", 0) for i, t in enumerate(edited)]
    table += [(910, items[4], "x", "y", 0), (None, items[1], "x", "y", 0), (911, items[2] + " " + items[2], "x", "y", 0)]
    bench = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, " ... ")], "item_id long, text string")
    found = contamination.find_passages(brute.frame(spark, table), bench).collect()
    words = lambda t: [w.lower().strip("\"'()[]{}<>.,;:!?-*_`") for w in brute.WORD.findall(t or "")]
    want = {
        (r[0], i): d
        for r in table
        for i, t in enumerate(items)
        if (d := brute.edit_distance_within(words(t), words(r[1]))) <= len(words(t)) // 5 and words(r[1])
    }
    got = {}
    for r in found:
        got[r.doc_id, r.item_id] = min(r.distance, got.get((r.doc_id, r.item_id), 99))
    assert got == want
    assert sum((r.doc_id, r.item_id) == (911, 2) for r in found) == 2
    df = brute.frame(spark, table)
    clean = contamination.decontaminate(df, bench)
    assert clean.columns == df.columns
    gone = {d for d, _ in want if d is not None}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(r[0]) for r in table if r[0] not in gone and (r[0] is not None or r[1] != items[1])
    )


def test_contamination_by_a_very_long_item(spark):
    rng = random.Random(3)
    item = [f"b{rng.randrange(10**5)}" for _ in range(5000)]
    copy = [w for w in item if rng.random() > 0.03]
    items = spark.createDataFrame([(0, " ".join(item)), (1, "one two three four five six seven")], "item_id long, text string")
    texts = ["head " * 9 + " ".join(copy) + " tail", " ".join(item[:3000]), "so one two three four five six seven, and on", "x " * 9000]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = contamination.find_passages(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(0, 0, 5000 - len(copy)), (2, 1, 0)]


def test_recall_over_all_items():
    rng = np.random.default_rng(5)
    items = [rng.integers(1, 2**63, n).astype(np.uint64) for n in rng.integers(5, 120, 200)]
    index = contamination.ItemIndex(list(range(200)), items, contamination.LshParams())
    met = 0
    for i, x in enumerate(items):  # copies of other draws than those that the tables were counted with
        y = x.copy()
        places = rng.choice(len(y), contamination.allowed(len(y), 0.2), replace=False)
        y[places] = rng.integers(1, 2**63, len(places)).astype(np.uint64)
        n = np.array([len(y)])
        met += i in index.candidates(y, np.zeros(1, np.int64), n, n)[:, 1]
    assert met / 200 >= 0.97
    with pytest.raises(RuntimeError, match="recall"):
        contamination.ItemIndex(list(range(200)), items, contamination.LshParams(most_tables=2))


def test_contamination_without_items(spark, rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contamination.find_passages(brute.frame(spark, rows), bench).count() == 0


def test_items_in_blocks(spark):
    items = spark.createDataFrame([(i, f"u{i} v{i} w{i} x{i} y{i} z{i}") for i in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"begin u{i} v{i} w{i} x{i} y{i} z{i} end") for i in range(9)], "doc_id long, text string")
    found = contamination.find_passages(docs, items, block_words=20).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.n_words) for r in found) == [(i, i, 1, 6) for i in range(9)]


def plain_counts(text):
    words = brute.WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    )


def test_quality(spark, rows):
    rng = random.Random(1)
    table = rows + [(1000 + i, " ".join(f"w{rng.randrange(300)}" for _ in range(80)), "x", "y", 0) for i in range(60)]
    table += [(2000 + i, " ".join(f"w{rng.randrange(300)}###$$$" for _ in range(80)), "x", "y", 0) for i in range(20)]
    labels = spark.createDataFrame(
        [(1000 + i, 1) for i in range(40)] + [(2000 + i, 0) for i in range(10)] + [(None, 1), (1001, None), (77777, 0)],
        "doc_id long, quality int",
    )
    df = brute.frame(spark, table)
    got = quality.judge(df, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), tuple(r[n] for n in names)) for r in got) == sorted(
        (str(r[0]), plain_counts(r[1])) for r in table
    )
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[1000 + i] for i in range(60)) and not any(kept[2000 + i] for i in range(20))
    good = quality.keep_good(df, labels)
    assert good.columns == df.columns and good.count() == sum(r.kept for r in got)


def test_forest_paths():
    """Scores are those of walking each row down each tree."""
    rng = np.random.default_rng(0)
    rows = rng.random((300, 4))
    params = quality.ForestParams(trees=9, sample=64)
    forest = quality.fit_forest(rows, np.array([rows.min(0), rows.max(0)]), params)
    for row, score in zip(rows[:40], quality.anomaly(rows[:40], forest, 64)):
        total = 0.0
        for axis, cut, left, right, length in forest:
            at = 0
            while axis[at] >= 0:
                at = left[at] if row[axis[at]] < cut[at] else right[at]
            total += length[at]
        assert score == pytest.approx(2 ** (-total / 9 / quality.usual_path(64)))


def test_quality_without_labels(spark, rows):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in quality.judge(brute.frame(spark, rows), labels).collect())


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(2)
    score, sizes, trans = rng.normal(size=9), np.array([4, 1, 3, 1]), rng.normal(size=(2, 2))
    got, pairs = toxicity.marginals(score, sizes, trans)
    at, expected = 0, np.zeros((2, 2))
    for n in sizes:
        weights = {}
        for code in range(2**n):
            tags = [code >> i & 1 for i in range(n)]
            weights[tuple(tags)] = np.exp(sum(score[at + i] * t for i, t in enumerate(tags)) + sum(trans[a, b] for a, b in zip(tags, tags[1:])))
        total = sum(weights.values())
        for i in range(n):
            assert got[at + i] == pytest.approx(sum(w for t, w in weights.items() if t[i]) / total)
        for t, w in weights.items():
            for a, b in zip(t, t[1:]):
                expected[a, b] += w / total
        at += n
    assert pairs == pytest.approx(expected)


def test_toxicity_on_held_out_rows(spark, rows):
    rng = random.Random(4)
    vocabulary = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnp')}{i}" for i in range(300)]
    table, labels = list(rows), []
    for i in range(3000, 3600):
        words = [rng.choice(vocabulary) for _ in range(60)]
        toxic = i % 3 == 0
        for _ in range(2 * toxic):
            words[rng.randrange(60)] = rng.choice(("Vileone,", "grubber", "vileish", "wretchy."))
        words[20] += "."
        table.append((i, " ".join(words), "x", "y", 0))
        labels.append((i, int(toxic)))
    labelled = spark.createDataFrame([*labels, (None, 1), (3001, None)], "doc_id long, toxic int")
    df = brute.frame(spark, table)
    got = toxicity.score_documents(df, labelled).collect()
    assert len(got) == len(table)
    truth = dict(labels)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    spans = [r for r in held if truth[r.doc_id] and r.predicted]
    texts = {r[0]: (r[1] or "").split() for r in table}
    assert all(any(w.lower().startswith(("vile", "grub", "wret")) for s in r.spans for w in texts[r.doc_id][s.start : s.end]) for r in spans)
    # Held-out labels change nothing.
    other = [(d, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, t in labels]
    again = toxicity.score_documents(df, spark.createDataFrame(other, "doc_id long, toxic int")).collect()
    scores = lambda found: sorted((str(r.doc_id), round(r.score, 9)) for r in found)
    assert scores(again) == scores(got)


def test_toxicity_sample_is_bounded(spark):
    """One id with many texts and one row many times do not exceed the bound; without ties it is the lowest hashed ids."""
    schema = "doc_id long, text string, toxic int"
    table = [(1, f"text {i}", i % 2) for i in range(200)] + [(2, "same", 1)] * 200 + [(i, f"own {i}", 0) for i in range(3, 40)]
    df = spark.createDataFrame([*table, (None, None, 1), (50, "unlabelled", None)], schema).repartition(3)
    for most in (1, 20, 150, 300, 430):
        got = [tuple(r) for r in toxicity.fit_sample(df, most, 8).collect()]
        assert len(got) == most and not Counter(got) - Counter(table)
    assert Counter(map(tuple, toxicity.fit_sample(df, 1000, 8).collect())) == Counter(table)
    assert toxicity.CrfParams().calm_share == 8


def test_toxicity_without_labels(spark, rows):
    got = toxicity.score_documents(brute.frame(spark, rows), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.0}


def test_licenses(spark, rows):
    given = licenses.TEMPLATES
    mit = given["MIT"].split()
    table = rows + [
        (500, "Intro. " + given["MIT notice"] + " tail", "x", "y", 0),
        (501, " ".join(mit[:50] + ["changed"] + mit[51:]), "x", "y", 0),
        (502, " ".join(mit[: len(mit) // 2]), "x", "y", 0),
        (503, given["Apache-2.0"].lower() + "\n" + given["ISC"], "x", "y", 0),
        (None, given["CC-BY-4.0"], "x", "y", 0),
    ]
    found = licenses.find_licenses(brute.frame(spark, table), block_shingles=100).collect()

    def parts(text):
        w = licenses.template_words(text or "")
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    want = set()
    for r in table:
        own = parts(r[1])
        for name, text in given.items():
            t = set(parts(text))
            step = licenses.window_step(len(t))
            best = max((len(t & set(own[k : k + 2 * step])) for k in range(0, max(1, len(own)), step)), default=0)
            if 100 * best >= 80 * len(t):
                want.add((r[0], name, len(t), best))
    assert {(r.doc_id, r.license, r.n_shingles, r.n_common) for r in found} == want
    assert {(500, "MIT notice"), (501, "MIT"), (503, "ISC")} <= {x[:2] for x in want}
    with pytest.raises(ValueError):
        licenses.find_licenses(brute.frame(spark, rows), {"short": "two words"})


def test_empty_tables(spark):
    empty = brute.frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "some words of it")], "item_id long, text string")
    for df in (
        huffman.round_trip(empty, WORDS, 2), packing.pack_documents(empty, BYTES), quality.judge(empty, labels),
        quality.keep_good(empty, labels), toxicity.score_documents(empty, labels), licenses.find_licenses(empty),
        contamination.find_passages(empty, bench), contamination.decontaminate(empty, bench),
    ):
        assert df.count() == 0
