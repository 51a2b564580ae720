import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, corpus, frame
from hubcat.llm import histogram_sort, html_layout, space_curves, toxicity


# Sharding

def sharded(docs, shards, **limits):
    size = (F.coalesce(F.octet_length(F.col("text").cast("binary")), F.lit(0)) + 16).cast("long")
    key = histogram_sort.sort_key(F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return histogram_sort.histogram_shards(docs.withColumn("size", size), key, F.col("size"), shards, **limits).collect()


@pytest.mark.parametrize("range_rows", [500_000, 20])
def test_shards_are_runs_of_keys_with_near_equal_bytes(spark, range_rows):
    rows = [*corpus(n=400), (None, "a"), (-5, "b"), (-(2 ** 62), "c"), (2 ** 63 - 1, "d")]
    got = sharded(clashing(spark, rows).repartition(3), 7, range_rows=range_rows)
    assert len(got) == len(rows)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [-(2 ** 63) - 1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert ids == sorted(ids)
    for shard in range(7):
        mine = [r for r in got if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 7) <= largest + 0.002 * total


def test_shards_of_few_equal_or_no_rows(spark):
    assert sharded(frame(spark, []), 4) == []
    assert [r["slot"] for r in sharded(frame(spark, [(1, "x")]), 4)] == [0]


def test_rows_that_repeat_a_key_are_cut(spark):
    rows = [(1, "the same text")] * 300 + [(i, f"another text {i}") for i in range(2, 602)]
    random.Random(3).shuffle(rows)
    for limits in ({}, {"range_rows": 20}):
        found = sharded(frame(spark, rows), 9, **limits)
        slots, size = {}, Counter()
        for r in found:
            slots.setdefault(r["shard"], []).append(r["slot"])
            size[r["shard"]] += r["size"]
        assert len(found) == 900 and set(slots) == set(range(9))
        assert all(sorted(held) == list(range(len(held))) for held in slots.values())
        assert max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in found) + 0.002 * max(size.values())
        shard_of = [r["shard"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"])) if r["doc_id"] == 1]
        assert len(set(shard_of)) >= 2


def test_columns_called_shard_and_slot_give_way(spark):
    rows = spark.createDataFrame([(i, "x" * i, -5, "old", b"k", 3) for i in range(20)], "doc_id long, text string, shard int, slot string, key binary, weight int")
    found = sharded(rows, 4)
    assert sorted(found[0].asDict()) == ["doc_id", "key", "shard", "size", "slot", "text", "weight"]
    assert {r["shard"] for r in found} == {0, 1, 2, 3} and all(r["weight"] == 3 and r["key"] == b"k" for r in found)


# Toxicity

def labelled(n=400):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        parts = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if bad:
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(["vileone", "viletwo", "nasty"]))
        docs.append((i, " ".join(parts)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled()
    extra = [(9000, None), (9001, ""), (None, "nasty vileone"), (9002, "nasty vileone viletwo " * 30_000)]
    rows = toxicity.score_toxicity(clashing(spark, docs + extra), frame(spark, labels + [(0, None), (None, 1)], "doc_id long, toxic int")).collect()
    assert len(rows) == len(docs) + len(extra)
    score = {r["row"]["doc_id"]: r["score"] for r in rows}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((score[i] >= 0.7) == bool(dict(labels)[i]) for i in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in score.values()) and score[9002] >= 0.7 and score[9000] == score[9001] < 0.7


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(150)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    first, second = (toxicity.fit(toxicity.training_rows(frame(spark, docs), frame(spark, some, "doc_id long, toxic int"), "text", "doc_id", "toxic")) for some in (labels, turned))
    assert np.array_equal(first.coordinates, second.coordinates) and np.allclose(first.weights, second.weights)


def test_toxicity_without_labels(spark):
    rows = toxicity.score_toxicity(frame(spark, [(1, "a"), (2, None)]), frame(spark, [], "doc_id long, toxic int")).collect()
    assert [r["score"] for r in rows] == [0.5, 0.5]
    assert toxicity.score_toxicity(frame(spark, []), frame(spark, [(1, 1)], "doc_id long, toxic int")).count() == 0


# Nearest neighbours

def nearest(x, ids, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


@pytest.mark.parametrize("scaled", [False, True])
def test_neighbours_against_all_pairs(spark, scaled):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype("f4").astype("f8")
    x /= np.linalg.norm(x, axis=1)[:, None]
    if scaled:
        x *= rng.uniform(0.5, 2, 3000)[:, None]
    x = x.astype("f4").astype("f8")
    x[100:110] = x[99]
    ids = rng.permutation(3000)
    rows = [(int(i), v.tolist(), "e") for i, v in zip(ids, x)]
    rows += [(5000, None, "e"), (5020, [0.0] * 16, "e"), (5040, [1.0] * 15 + [None], "e"), (5060, [math.nan] * 16, "e"), (5080, [math.inf] * 16, "e"), (None, [1.0] * 16, "e"), (5100, [1.0], "e")]
    got = space_curves.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string"), F.col("id") % 20 == 0, 20).collect()
    want = nearest(x, ids, 20)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == set(want)
    hits = sum(len({v for v, _ in by[i]} & {v for v, _ in want[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for i, found in by.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and len(found) == 20
        for v, score in found:
            assert abs(score - float(x[np.flatnonzero(ids == v)[0]] @ x[np.flatnonzero(ids == i)[0]])) < 1e-12


def test_few_equal_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert space_curves.search(spark.createDataFrame([], schema), F.col("id") % 20 == 0, 20).count() == 0
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(30)], schema)
    got = space_curves.search(same, F.col("id") == 0, 20).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(i, i, 1.0) for i in range(1, 21)]


def unit_vectors(rng, n, dims=64):
    x = rng.normal(size=(n, dims))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype("f4").astype("f8")


def hits_of(spark, x, ids):
    """Share of the true 20 neighbours found, by query."""
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>").repartition(5)
    by = {}
    for r in space_curves.search(rows, F.col("id") % 20 == 0, 20).collect():
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    return {i: len(by[i] & {v for v, _ in want}) / 20 for i, want in nearest(x, ids, 20).items()}


def test_a_third_of_equal_vectors_with_narrow_ranges(spark, monkeypatch):
    monkeypatch.setattr(space_curves, "LEAST_ROWS", 32)
    rng = np.random.default_rng(11)
    x, ids = unit_vectors(rng, 3000), rng.permutation(3000)
    x[:1000] = x[0]
    x[:500, 7] = x[0, 7] = 0.0
    x[500:1000] = x[0]
    x[:300, 7] = -0.0
    hits = hits_of(spark, x, ids)
    assert all(hits[int(i)] == 1 for i in ids[:1000] if i % 20 == 0)
    assert sum(hits.values()) >= 0.9 * len(hits)


def test_neighbours_with_as_many_ranges_as_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(space_curves, "LEAST_ROWS", 32)
    rng = np.random.default_rng(13)
    hits = hits_of(spark, unit_vectors(rng, 3000), rng.permutation(3000))
    assert sum(hits.values()) >= 0.9 * len(hits)


@pytest.mark.parametrize("share", [1 / 3, 0.9])
def test_a_tight_cluster_with_narrow_ranges(spark, monkeypatch, share):
    monkeypatch.setattr(space_curves, "LEAST_ROWS", 32)
    rng = np.random.default_rng(12)
    x, ids, inside = unit_vectors(rng, 3000), rng.permutation(3000), int(3000 * share)
    x[:inside] = x[0] + rng.normal(size=(inside, 64)) * 0.0002
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype("f4").astype("f8")
    hits = hits_of(spark, x, ids)
    among = [hits[int(i)] for i in ids[:inside] if i % 20 == 0]
    assert sum(among) >= 0.9 * len(among) and sum(hits.values()) >= 0.9 * len(hits)


def test_repeated_ids_count_once_and_do_not_crowd_out_others(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, i / 1000]) for i in range(60)] + [(i, [0.5, i / 1000]) for i in range(100, 130)]
    got = space_curves.search(spark.createDataFrame(rows, schema), F.col("id") == 0, 20).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [7, *range(100, 119)]


def test_hilbert_keys_walk_from_cell_to_neighbouring_cell():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = space_curves.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# HTML

@pytest.mark.parametrize("source, text", [
    ("", ""),
    ("plain &amp; simple &lt;", "plain & simple <"),
    ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b  c</div>", "a\nb c"),
    ("a<b>b</b> <i>c</i><br>d", "ab c\nd"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>", "- a\n- b\n  3. x\n  4. y"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>3<tr><td>fig<td>12</table>end", "Name   N\napple  3\nfig    12\n\nend"),
    ("<table><tr><td colspan=2>wide<td>c<tr><td>a<td>bb<td>d</table>", "wide   c\na  bb  d"),
    ("<pre>\n x\n   y</pre>", " x\n   y"),
    ("<p hidden>no</p><p style='display: none'>no</p><script>var a='</p>'</script><style>p{}</style><p>yes", "yes"),
    ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span></div>", "b"),
    ("<details><summary>s</summary>closed</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ("<title>t</title><body>x<!-- c --><!doctype z>y", "xy"),
    ("a < b <3 <", "a < b <3 <"),
    ("</div></p>x</b>", "x"),
    ("<blockquote>q<p>r</blockquote>z", "  q\n\n  r\n\nz"),
    ("<img alt='pic'><input type=hidden value=v>t", "pict"),
    ("<a href=\"x>y\">link</a>", "link"),
])
def test_layout(source, text):
    assert html_layout.visible_text(source) == text


@pytest.mark.parametrize("source, text", [
    ("<table><tr><th>Name<th>A<th>B<tr><td rowspan=2>fig<td>1<td>2<tr><td>3<td>4<tr><td>kiwi<td>5<td>6</table>",
     "Name  A  B\nfig   1  2\n      3  4\nkiwi  5  6"),
    ("<table><tr><td>a<td rowspan=2 colspan=2>wide<td>b<tr><td>c<td>d<tr><td>e<td>f<td>g<td>h</table>", "a  wide  b\nc        d\ne  f  g  h"),
    ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</tbody><tbody><tr><td>e<td>f</table>", "a  b\n   c\n   d\ne  f"),
    ("<table><tbody><tr><td rowspan=9>a<td>b</tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td><p>a<p>b<td>c<tr><td>d</table>", "a  c\n\nb\nd"),
    ("<blockquote><table><tr><td><p>a<p>b</table></blockquote>", "  a\n\n  b"),
    ("<table>loose<tr><td>a</table>", "loose\na"),
    ("<table><tr><td><tr><td>a<tr><td> <td></table>", "a"),
    (f"<table><tr><td colspan={'9' * 5000} rowspan={'0' * 5000}1>a</table>", "a"),
])
def test_layout_of_spans_and_paragraphs_in_tables(source, text):
    assert html_layout.visible_text(source) == text


@pytest.mark.parametrize("source, text", [
    ("<p hidden>" + "<b>" * 100 + "no</p>yes", "yes"),
    ("<p>a" + "<i>" * 5000 + "b</p>c", "ab\n\nc"),
    ("<p style='display:none'><span>" + "<b><i>" * 32 + "no</p>yes", "yes"),
    ("a</p>b", "a\n\nb"),
])
def test_a_paragraph_ends_below_many_open_elements(source, text):
    assert html_layout.visible_text(source) == text


def test_an_end_tag_does_not_end_the_paragraph_around_a_table():
    assert html_layout.visible_text("<p>a<b><table><tr><td>" + "<i>" * 70 + "b</p>c") == "a\n\nb\n\nc"


def test_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (None, "u", "<p>x"), (4, "u", "<div>" * 50_000 + "deep"), (4, "u", "<table>" * 300 + "<tr><td>t"), (5, "u", "x" * 300_000)]
    got = html_layout.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r["page_id"]), len(r["text"])) for r in got) == sorted([("1", 0), ("2", 0), ("None", 1), ("4", 4), ("4", 1), ("5", 300_000)])
    assert html_layout.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
