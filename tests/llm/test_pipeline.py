"""Every stage of the pipeline, and the whole of it, against plain versions on small tables."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hubcat.llm import toxicity
from helpers import corpus, frame, joined, repeated, shingle_links

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = re.compile("[\x20\x09-\x0D]")


def wide(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t)) for i, t in rows], SCHEMA)


def labels_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def toxic_corpus(n=160):
    rng = random.Random(12)
    rows, labels = [], []
    for i, text in corpus(seed=9, n=n):
        bad = text is not None and len(text) > 60 and rng.random() < 0.25
        if bad:
            parts = text.split(" ")
            for _ in range(5):
                parts.insert(rng.randrange(len(parts)), rng.choice(["vileone", "viletwo", "nasty", "awful"]))
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    return rows, labels


# The classifier without arrays or averages over slices: one dictionary per part

def plain_scores(rows, labels):
    """FTRL-proximal, coordinate by coordinate, in the parts and passes of the operator."""
    label = {i: y for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    features = {i: sorted(set(next(iter(toxicity.features_of([t or ""]))).tolist())) for i, t in rows}
    order = {i: hash_of(i) for i in label}
    parts = defaultdict(list)
    for i in sorted(label, key=lambda i: order[i]):
        parts[order[i] % toxicity.PARTS].append(i)
    z, n = defaultdict(float), defaultdict(float)

    def weight(z, n, c):
        l1 = 0.0 if c == toxicity.COORDINATES else toxicity.L1
        return 0.0 if abs(z[c]) <= l1 else -math.copysign(abs(z[c]) - l1, z[c]) / ((toxicity.BETA + math.sqrt(n[c])) / toxicity.ALPHA + toxicity.L2)

    def sigmoid(x):
        return 1 / (1 + math.exp(-max(-35, min(35, x))))

    for _ in range(toxicity.PASSES):
        states = []
        for ids in parts.values():
            own_z, own_n = defaultdict(float, z), defaultdict(float, n)
            for i in ids:
                at = [*features[i], toxicity.COORDINATES]
                w = {c: weight(own_z, own_n, c) for c in at}
                error = sigmoid(sum(w.values())) - label[i]
                for c in at:
                    own_z[c] += error - (math.sqrt(own_n[c] + error * error) - math.sqrt(own_n[c])) / toxicity.ALPHA * w[c]
                    own_n[c] += error * error
            states.append((len(ids), own_z, own_n))
        total = sum(k for k, _, _ in states)
        every = {c for _, own, _ in states for c in own}
        z = defaultdict(float, {c: sum(k * own[c] for k, own, _ in states) / total for c in every})
        n = defaultdict(float, {c: sum(k * own[c] for k, _, own in states) / total for c in every})
    return [(i, sigmoid(weight(z, n, toxicity.COORDINATES) + sum(weight(z, n, c) for c in features[i]))) for i, _ in rows]


_ORDER = {}


def hash_of(i):
    return _ORDER[i]


@pytest.fixture(scope="module")
def ordered(spark):
    ids = spark.range(1000).select("id", F.xxhash64("id").alias("h")).collect()
    _ORDER.update((r["id"], r["h"]) for r in ids)
    return _ORDER


def test_classifier_against_plain_ftrl(spark, tmp_path, ordered):
    rows, labels = toxic_corpus()
    scored = toxicity.score_toxicity(wide(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["id"]: r["score"] for r in scored.select("row.doc_id", "score").withColumnRenamed("doc_id", "id").collect()}
    expected = dict(plain_scores(rows, labels))
    assert len(got) == len(rows) and max(abs(got[i] - expected[i]) for i in got) < 2e-3
    # Ids that the table repeats are scored each; a repeated label counts once, by its larger value.
    again = toxicity.score_toxicity(wide(spark, rows + rows[5:9]), spark.createDataFrame(labels + [(labels[9][0], 0, 0)], "doc_id long, quality int, toxic int"))
    assert again.count() == len(rows) + 4


def plain_pipeline(rows, labels):
    """Documents after each filtering stage."""
    after = [[(i, t) for (i, t), (_, score) in zip(rows, plain_scores(rows, labels)) if score < toxicity.THRESHOLD]]
    groups = defaultdict(list)
    for i, t in after[-1]:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i))
    kept = {min(g)[1] for g in groups.values()}
    after.append([r for r in after[-1] if r[0] in kept])
    _, links = shingle_links(after[-1], 5, 80)
    label = joined(links, [i for i, _ in after[-1]])
    after.append([r for r in after[-1] if label[r[0]] == r[0]])
    spans = repeated(after[-1], 100)
    cut = []
    for i, t in after[-1]:
        body, out, at = (t or "").encode(), b"", 0
        for a, b in spans[i]:
            out, at = out + body[at:a], b
        cut.append((i, None if t is None else (out + body[at:]).decode(errors="replace")))
    return [*after, cut]


def test_stages_and_the_whole_run(spark, tmp_path, ordered):
    rows, labels = toxic_corpus()
    # A passage of ASCII letters that repeats, so that no cut falls inside a character.
    passage = " ".join(f"passage{k} word" for k in range(40))
    rows += [(300 + k, f"own start {k} alpha beta {k * 7} {passage} tail {k} gamma {k * 13} delta epsilon {k * 17}") for k in range(6)]
    sf = labels_of(spark, tmp_path, labels)
    expected = plain_pipeline(rows, labels)
    docs = wide(spark, rows)
    docs.write.parquet(f"{sf}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), SCHEMA)
        found = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        assert [i for i, _ in found] == [i for i, _ in sorted(want)], name
        assert found == sorted(want), name
        if name == "suffix-array dedup":
            assert all(r["n_chars"] == len(r["text"] or "") for r in docs.collect())
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    ids = {i: [*encode(t or "", add_special_tokens=False).ids, 0] for i, t in expected[-1]}
    packed = corpus_pipeline.run(spark, sf).collect()
    pieces = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(ids)
    for i, found in pieces.items():
        for piece, start, length, crc in sorted(found):
            part = ids[i][start:start + length]
            assert start == 2048 * piece and len(part) == length and zlib.crc32(np.asarray(part, "<u4").tobytes()) == crc
        assert sum(length for _, _, length, _ in found) == len(ids[i])


def test_stages_on_empty_tables_extra_columns_and_repeated_rows(spark, tmp_path):
    sf = labels_of(spark, tmp_path, [(1, 1, 0), (2, 0, 1)])
    clash = "doc_id long, text string, row string, label string, hash int, `a.b` string, kept int"
    for rows in ([], [(1, None, "r", "l", 1, "d", 2), (1, None, "r", "l", 1, "d", 2), (2, "", "r", "l", 1, "d", 2), (None, "x " * 300, None, None, None, None, None)]):
        docs = spark.createDataFrame(rows, clash)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf)
            assert after.columns == docs.columns and after.count() <= len(rows), name
            if rows:
                assert after.count() >= 1, name
        assert corpus_pipeline.packing(spark, docs, sf).count() == len(rows)
