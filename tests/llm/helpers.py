"""Small documents with everything that texts and columns can do, and plain versions of the operators."""

from __future__ import annotations

import random
from collections import defaultdict

#: Extra columns whose names the operators use themselves.
CLASH = "doc_id long, text string, row string, label string, hash int, `a.b` string, block int"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "r", "l", 7, "dot", 9) for i, t in rows], CLASH)


def words(rng: random.Random, n: int, vocabulary: int = 40) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed: int = 5, n: int = 60) -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages, nulls, empties, and one long text."""
    rng = random.Random(seed)
    passage = words(rng, 30, 500)
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "one two")]
    for i in range(5, n):
        kind = rng.randrange(6)
        earlier = rng.choice(rows)[1] or "x"
        if kind == 0:
            text = earlier
        elif kind == 1:
            parts = earlier.split(" ")
            parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        elif kind == 2:
            text = f"{words(rng, 20, 500)} {passage} {words(rng, 20, 500)}"
        else:
            text = words(rng, rng.randrange(1, 90), 500)
        rows.append((i, text))
    rows.append((n, words(rng, 6000, 3000) + " Ünïcödé ß 日本語 's <|endoftext|>"))
    return rows


def joined(links, nodes):
    """Smallest node that each reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_links(rows, width, percent):
    """Shingle sets by id, and all links of at least so many percent."""
    sets = {}
    for i, text in rows:
        parts = (text or "").encode().lower().split()
        sets[i] = {tuple(parts[k:k + width]) for k in range(len(parts) - width + 1)} if len(parts) >= width else ({tuple(parts)} if parts else set())
    holders = defaultdict(list)
    for i, held in sets.items():
        for shingle in held:
            holders[shingle].append(i)
    links = set()
    for i, held in sets.items():
        counts = defaultdict(int)
        for shingle in held:
            for j in holders[shingle]:
                counts[j] += j < i
        links |= {(i, j) for j, n in counts.items() if n and 100 * n >= percent * (len(held) + len(sets[j]) - n)}
    return sets, links


def repeated(rows, length):
    """By id, the maximal removed runs of a text's bytes."""
    seen, out = set(), {}
    for i, text in rows:
        body = (text or "").encode()
        runs: list[list[int]] = []
        for start in range(len(body) - length + 1):
            window = body[start:start + length]
            if window in seen:
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = start + length
                else:
                    runs.append([start, start + length])
            seen.add(window)
        out[i] = [tuple(r) for r in runs]
    return out
