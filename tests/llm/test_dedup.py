import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import clashing, corpus, frame, joined, repeated, shingle_links
from hubcat.llm import components, exact_dedup, jaccard_join, suffix_dedup


def exact(rows):
    keys = {k: re.sub(r"[\x20\x09-\x0D]", "", t or "") for k, (_, t) in enumerate(rows)}
    groups = {}
    for k, key in keys.items():
        groups.setdefault(key, []).append(k)
    out = []
    for k, key in keys.items():
        best = min(groups[key], key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0))
        out.append((rows[k][0], rows[best][0], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda c: F.unhex(F.lit("00")), lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)])
def test_exact_groups_whatever_the_hash(spark, digest):
    rows = [*corpus(), (None, "one"), (None, None), (7000, "o ne"), (7000, "o ne"), (7001, "o\n n  e"), (7002, "𝕏 one"), (7003, "𝕏one")]
    got = exact_dedup.exact_groups(frame(spark, rows), digest=digest).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == exact(rows)
    assert all(r["kept"] == (r["id"] == r["keep_id"]) for r in got)


def test_exact_copies_are_dropped_with_all_columns(spark):
    rows = [*corpus(), (None, "one"), (9, "zzz"), (9, "zzz"), (9, "zzz")]
    docs = clashing(spark, rows)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    assert kept.where("text = 'zzz'").count() == 1
    assert exact_dedup.drop_exact_copies(docs.limit(0)).count() == exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]
    got = {r["node"]: r["label"] for r in components.components(frame(spark, links + links[:5], "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    want = joined(links, nodes | {n for link in links for n in link})
    assert got == {n: want[n] for n in nodes}
    assert components.components(frame(spark, [], "a long, b long")).count() == 0


def test_components_take_few_rounds(spark, monkeypatch):
    """What lies in one task is joined there: a long chain in a few tasks is written once or twice, not once for each doubling."""
    written = []
    monkeypatch.setattr(components, "stored_at", lambda df, name, old=components.stored_at: written.append(name) or old(df, name))
    links = [(i, i + 1) for i in range(3000)] + [(9000 + i, 5000) for i in range(500)]
    got = {r["node"]: r["label"] for r in components.components(frame(spark, links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(3001)} | {9000 + i: 5000 for i in range(500)} | {5000: 5000}
    assert len(written) <= 3


def test_contracted_edges_join_the_same(monkeypatch):
    monkeypatch.setattr(components, "GATHERED", 6)
    monkeypatch.setattr(components, "MOST_NODES", 20)
    rng = random.Random(4)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    batches = [pa.RecordBatch.from_pydict({"a": [a for a, _ in links[i:i + 5]], "b": [b for _, b in links[i:i + 5]]}) for i in range(0, 90, 5)]
    made = [row for batch in components._contracted(iter(batches)) for row in zip(*batch.to_pydict().values())]
    whole = lambda pairs: {n: r for n, r in zip(*(x.tolist() for x in components.joined(*np.array(pairs).T))) if n != r}
    assert whole(made) == whole(links) and all(a > b for a, b in made)
    assert list(components._contracted(iter([])))[0].num_rows == 0


def test_linked_sets_agree_on_a_column_block():
    rng = np.random.default_rng(4)
    for part in (90, 80, 50):
        scheme = jaccard_join.Scheme(part, 100)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 1 << 62, n, dtype="u8") * np.uint64(4) + np.uint64(1))
            out = int(rng.integers(0, n + 1))
            b = np.unique(np.r_[a[out:], rng.integers(0, 1 << 62, int(rng.integers(0, n)), dtype="u8")])
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= part * (len(a) + len(b) - both):
                assert len(np.intersect1d(scheme.signatures(a), scheme.signatures(b)))


@pytest.mark.parametrize("width, percent, entries", [(3, 90, None), (5, 80, None), (5, 80, 300), (1, 50, 300)])
def test_jaccard_groups(spark, width, percent, entries):
    rows = corpus(n=150)
    sets, links = shingle_links(rows, width, percent)
    want = joined(links, sets)
    limit = {"block_entries": entries} if entries else {}
    got = jaccard_join.jaccard_groups(clashing(spark, rows).repartition(3), width, percent, **limit).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len({i for i, c in want.items() if i != c}) > 5


def test_near_copies_leave_one_of_each_group(spark):
    rows = corpus(n=120) + [(None, "alone in this"), (None, None)]
    docs = clashing(spark, rows)
    kept = jaccard_join.drop_near_copies(docs)
    sets, links = shingle_links(rows[:-2], 5, 80)
    want = joined(links, sets)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({*want.values()})
    assert kept.where("doc_id is null").count() == 2
    assert jaccard_join.drop_near_copies(docs.limit(0)).count() == 0


def test_hot_groups_of_copies_and_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(100)] + [(100 + i, " ".join([*base[:59], f"x{i}"])) for i in range(100)]
    got = jaccard_join.jaccard_groups(frame(spark, rows).repartition(4), 5, 80, block_entries=1000)
    assert {r["component_id"] for r in got.collect()} == {0}


@pytest.mark.parametrize("heavy", [50_000, 3])
def test_repeats_against_all_windows(spark, heavy):
    for seed in (1, 2):
        rng = random.Random(seed)
        base = "".join(rng.choice("ab ") for _ in range(60))
        pieces = [lambda: base[rng.randrange(40):][:rng.randrange(5, 30)], lambda: "a" * rng.randrange(25), lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(20)))]
        rows = [(i, "".join(rng.choice(pieces)() for _ in range(rng.randrange(8)))) for i in range(50)] + [(50, None), (51, "")]
        want = repeated(rows, 12)
        got = suffix_dedup.remove_repeats(clashing(spark, rows).repartition(3), length=12, gram=5, heavy=heavy).collect()
        assert {r["row"]["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in got} == want
        for r in got:
            body, kept, at = (r["row"]["text"] or "").encode(), b"", 0
            for start, end in want[r["row"]["doc_id"]]:
                kept, at = kept + body[at:start], end
            assert bytes(r["kept"]) == kept + body[at:]


def test_repeats_of_rows_that_share_or_lack_an_id(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    docs = frame(spark, [(5, text), (5, text), (None, text), (None, text), (1, text + "tail")])
    got = suffix_dedup.remove_repeats(docs, as_text=True).collect()
    assert sorted(len(r["kept"]) for r in got) == [0, 0, 0, 4, 300]
    assert next(r["row"]["doc_id"] for r in got if len(r["kept"]) == 300) is None
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_blocks_grow_with_the_texts_and_not_with_one_id(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1000)
    rng = random.Random(10)
    base = "".join(rng.choice("abcdefgh") for _ in range(60))
    made = ["".join(rng.choice("abcdefgh") for _ in range(30)) + base[rng.randrange(40):][:20] for _ in range(400)]
    # Half share an id, and some of them the text; a few lack one.
    rows = [(7 if i % 2 else 1000 + i, t) for i, t in enumerate(made)] + [(7, made[1])] * 60 + [(None, made[3])] * 60 + [(-(2 ** 63), made[3]), (7, None)]
    docs = clashing(spark, rows).repartition(3)
    blocks = suffix_dedup.blocks_of(docs, "text", 1000)
    assert blocks == -(-sum(len(t or "") for _, t in rows) // 1000) > 8
    held = [r["count"] for r in suffix_dedup.dealt(docs, "text", "doc_id", blocks).groupBy("block").count().collect()]
    assert sum(held) == len(rows) and max(held) < len(rows) / 8
    inner = sorted(rows, key=lambda r: (-(2 ** 63) - 1 if r[0] is None else r[0], (r[1] or "").encode()))
    want = repeated([(place, t) for place, (_, t) in enumerate(inner)], 12)
    got = suffix_dedup.remove_repeats(docs, length=12, gram=5).collect()
    key = lambda i, t, spans: (str(i), t or "", tuple(spans))
    assert sorted(key(r["row"]["doc_id"], r["row"]["text"], [(s["start"], s["end"]) for s in r["spans"]]) for r in got) == sorted(
        key(i, t, want[place]) for place, (i, t) in enumerate(inner))


def test_signature_buckets_grow_with_the_texts(spark, monkeypatch):
    seen, rows = [], jaccard_join._rows
    monkeypatch.setattr(jaccard_join, "BUCKET_BYTES", 500)
    monkeypatch.setattr(jaccard_join, "_rows", lambda words, scheme, buckets, *more: (seen.append(buckets), rows(words, scheme, buckets, *more))[1])
    docs = corpus(seed=6)
    want = joined(shingle_links(docs, 3, 80)[1], [i for i, _ in docs])
    got = jaccard_join.jaccard_groups(frame(spark, docs), 3, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert seen == [-(-sum(len((t or "").encode()) for _, t in docs) // 500)] and seen[0] > 8


def test_candidate_links_do_not_grow_with_the_square_of_a_group():
    """Sets that share many signatures in many buckets come out once in a task, and hang together as before."""
    rng = np.random.default_rng(2)

    def batch(bucket, uids):
        signature = np.concatenate([np.full(2, k) for k in range(len(uids) - 1)]).astype("u8")
        owners = np.stack([uids[:-1], uids[1:]], axis=1).ravel().astype("u4")
        order = np.argsort(owners, kind="stable")
        signature, owners = signature[order], owners[order]
        return pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int64()), pa.array([signature.view("u1").reshape(-1, 8)[:, :6].tobytes()]), pa.array([np.diff(owners, prepend=np.uint32(0)).tobytes()]),
             pa.array([bucket], pa.int32())], names=["uid", "signatures", "owners", "bucket"])

    out = list(jaccard_join._stars(batch(k, rng.permutation(50) + 100 * (k % 2)) for k in range(30)))
    links = sorted((a, b) for x in out for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist()))
    assert links == [(a + base, base) for base in (0, 100) for a in range(1, 50)]


def test_near_copies_meet_in_few_buckets():
    """A set's links do not grow with the signatures that it shares: a scheme's signatures lie in as few buckets as its weight asks for."""
    rng, scheme = np.random.default_rng(5), jaccard_join.Scheme(80, 100)

    def some(n):
        return rng.integers(0, 1 << 62, n, dtype="u8") * np.uint64(4)

    base = np.unique(some(400))
    copies = [np.unique(np.r_[np.delete(base, rng.integers(0, 400, 4)), some(4)]) for _ in range(60)]
    sets = copies + [np.unique(some(int(n))) for n in np.exp(rng.uniform(2, 7, 600))]
    found = [scheme.signatures_by_scheme(x) for x in sets]
    assert all((schemes[np.isin(signatures, scheme.signatures(x))] >= 0).all() and len(signatures) == len(schemes) for x, (signatures, schemes) in zip(sets, found))
    sizes = {float(n): k for n, k in zip(*np.unique([len(x) for x in sets], return_counts=True))}
    parts = scheme.parts(sizes, 64)
    assert 64 <= parts[np.unique(np.concatenate([c for _, c in found]))].sum() <= 64 + 40
    rows = jaccard_join._dealt(0, [x for x, _ in found], [c for _, c in found], [np.full(len(x), k, "u4") for k, (x, _) in enumerate(found)], parts, pa.int64())
    rows = rows.select(["uid", "signatures", "owners", "bucket"])
    links = [x for k in range(rows.num_rows) for x in jaccard_join._stars(iter([rows.slice(k, 1)]))]
    a, b = (np.concatenate([x.column(k).to_numpy() for x in links]) for k in (0, 1))
    assert len(np.intersect1d(found[0][0], found[1][0])) > 60 and (a < 60).sum() <= 20 * 60
    node, root = jaccard_join._joined(a, b)
    assert set(node[root == 0]) >= set(range(60))


def test_cuts_inside_characters_leave_valid_text(spark):
    passage = "é" * 80
    got = suffix_dedup.remove_repeats(frame(spark, [(1, "x" + passage), (2, "yy" + passage + "z")]), as_text=True).collect()
    assert {r["row"]["doc_id"]: r["kept"] for r in got}[2].startswith("yy")


def test_long_texts_in_stretches(monkeypatch):
    rng = random.Random(3)
    body = bytes(rng.randrange(97, 103) for _ in range(5000))
    whole = suffix_dedup._segments(body, 40, 12)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 512)
    first, last, anchor, h = suffix_dedup._segments(body, 40, 12)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert (covered == np.arange(len(body) - 39)).all()
    chosen = dict(zip(covered.tolist(), np.repeat(anchor, last - first + 1).tolist()))
    again = np.repeat(whole[2], whole[1] - whole[0] + 1)
    assert [chosen[i] for i in range(len(again))] == again.tolist()


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(8)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) + bytes([k, j]) for j in range(rng.randrange(0, 30))}) for k in range(7)]
    got = list(suffix_dedup.merged([suffix_dedup.decoded(*suffix_dedup.front_coded(run)) for run in runs]))
    want = sorted(item for run in runs for item in run)
    assert [item for item, _ in got] == want
    for (before, _), (item, shared) in zip(got, got[1:]):
        assert item[:shared] == before[:shared] and item[:shared + 1] != before[:shared + 1]
