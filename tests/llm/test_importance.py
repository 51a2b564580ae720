import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from hubcat.llm import importance
from hubcat.llm.queries import op13_importance_resampling
from helpers import clashing, corpus, frame

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(rows, target, least=20):
    """Rows of (doc_id, n_features, weight, score, rank), word by word."""
    def features(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        return len(words), [zlib.crc32(f.encode()) % 10000 for f in runs]

    s, t, made = Counter(), Counter(), []
    for i, text in rows:
        n, found = features(text)
        s.update(found)
        made.append((i, n, found))
    for text in target:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for i, n, found in made:
        weight = math.floor(sum(gain[b] for b in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(able[:25 * len(able) // 100], 1)}
    return sorted((i, n_features, weight, score, rank.get(i)) for i, _, n_features, weight, score in out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abzAZ09 _-\t\n\x00\x7f`/:{éÀßİ日😀İ ")))
def test_words_and_offsets(text):
    found = importance.words_with_offsets(text)
    low = text.encode().lower().decode()
    assert [w for w, _ in found] == WORD.findall(low)
    assert all(low[a:b] == w for w, (a, b) in found)


def test_longer_runs():
    n, found = importance.buckets_of("A b, c", 10000, 3)
    assert n == 3 and found.tolist() == [zlib.crc32(x) % 10000 for x in (b"a", b"b", b"c", b"a b", b"b c", b"a b c")]


def test_against_plain_version(spark):
    rows = corpus(n=160)
    rng = random.Random(2)
    target = [" ".join(rng.choice(rows)[1] or "" for _ in range(2)) for _ in range(9)] + [None, ""]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert rows_of(importance.resample(frame(spark, rows), wanted)) == plain(rows, target)
    assert rows_of(importance.resample(clashing(spark, rows), wanted)) == plain(rows, target)


def test_empty_tables_missing_and_repeated_ids(spark):
    none = spark.createDataFrame([], "text string")
    assert rows_of(importance.resample(frame(spark, []), none)) == []
    long = " ".join(f"w{i}" for i in range(25))
    rows = [(1, long), (1, long + " more"), (1, long), (2, None), (3, ""), (4, "...")]
    found = importance.resample(frame(spark, rows + [(None, long)]), none).collect()
    assert len(found) == 7 and sorted(r["rank"] for r in found if r["rank"]) == [1]
    assert all(r["n_features"] == 0 and r["weight"] == 0 and r["rank"] is None for r in found if r["doc_id"] in (2, 3, 4))


def test_gains_are_whole_numbers():
    gain = importance.gains(np.asarray([0, 3]), np.asarray([5, 0]))
    assert gain.tolist() == [math.floor(1000 * math.log(6 * 5 / (1 * 7))), math.floor(1000 * math.log(1 * 5 / (4 * 7)))]


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(op13_importance_resampling(spark, SF)) == plain(rows, target)
