"""Plain versions of the corpus operators, and small tables for them."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; a table may have columns of the same names.
CLASH = ("f", "h", "p", "k", "row", "runs", "n_words", "kept", "root", "c", "start", "window", "gone_id", "component_id")


def corpus(seed: int = 0) -> list[tuple]:
    """Texts with nulls, empty and one-word texts, long ones, exact and near copies, repeated lines and rows, null ids."""
    rng = random.Random(seed)
    words = [rng.choice(("ba", "Lo", "mi", "nu", "Ra", "é")) * rng.randint(1, 3) + str(i) for i in range(400)]

    def line(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n)) + rng.choice((".", "", "!"))

    def text(lines: int, n: int = 12) -> str:
        return "\n".join(line(n) for _ in range(lines))

    base = [text(8, 15) for _ in range(6)]
    shared, boiler = text(1, 60), [line(9), line(7), line(8)]
    rows: list = [None, "", "   \n\t", "one", "two words", "a a a a a a a a " * 40, "x" * 700, line(4), line(4)]
    rows += base + [base[0], base[1], base[1]]
    for b in base[:4]:
        for k in range(3):
            w = b.split(" ")
            for _ in range(k + 1):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append(" ".join(w))
    rows += [text(3) + "\n" + "\n".join(boiler) + "\n" + text(2) for _ in range(4)]
    rows += [text(2) + " " + shared + " " + text(2) for _ in range(3)]
    rows += [text(60, 20), "\n".join([line(10)] * 30), "\n\n" + line(5) + "\n\n" + line(5) + "\n"]
    rows += ["日本語 のテキスト " * 30, "ÀÉ " * 90 + line(60), "\U0001d7e1 " * 120]
    table = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(rows)]
    table += [table[20], table[12], (None, base[2], None, None, None), (None, None, None, None, 0)]
    rng.shuffle(table)
    return table


def frame(spark, rows, clash: bool = True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clash:
        for name in CLASH:
            df = df.selectExpr("*", f"concat('own ', source) as {name}")
    return df


def key(row) -> tuple:
    return row[0] is not None, row[0] or 0, row[1] or ""


def repeated(texts: list, k: int, cut) -> list[list[bool]]:
    """For each text, which of its parts lie in a window of ``k`` that starts anywhere else too."""
    parts = [cut(t or "") for t in texts]
    times = Counter(tuple(p[i : i + k]) for p in parts for i in range(len(p) - k + 1))
    out = []
    for p in parts:
        gone = [False] * len(p)
        for i in range(len(p) - k + 1):
            if times[tuple(p[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append(gone)
    return out


def later_lines(rows: list[tuple], k: int) -> dict[tuple, list[str]]:
    """What is left of each distinct (id, text), as lines."""
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=key)
    lines = {d: d[1].split("\n") for d in docs}
    at = {d: [i for i, x in enumerate(lines[d]) if WORD.search(x)] for d in docs}
    seen, gone = set(), defaultdict(set)
    for d in docs:
        for j in range(len(at[d]) - k + 1):
            window = tuple(lines[d][i] for i in at[d][j : j + k])
            if window in seen:
                gone[d].update(at[d][j : j + k])
            seen.add(window)
    return {d: [x for i, x in enumerate(lines[d]) if i not in gone[d]] for d in docs}


def later_or_long_lines(rows: list[tuple], k: int, words: int, size: int) -> dict[tuple, list[str]]:
    """As ``later_lines``, and without later copies of lines that have ``words`` words or ``size`` bytes."""
    left = later_lines(rows, k)
    out, seen = {}, set()
    for d in sorted(left, key=key):
        out[d] = []
        for x in left[d]:
            long = WORD.search(x) and (len(WORD.findall(x)) >= words or len(x.encode()) >= size)
            if not (long and x in seen):
                out[d].append(x)
            if long:
                seen.add(x)
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(sets: list[frozenset], percent: int = 80) -> list[int]:
    """The place of the first member of each set's component; empty sets are alone."""
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def edit_distance_within(pattern: list, text: list) -> int:
    """Least edit distance of ``pattern`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
