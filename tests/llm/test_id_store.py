import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hubcat.llm import id_store
from hubcat.llm.queries import op12_id_store
from hubcat.session import scratch_path
from helpers import clashing, corpus, frame

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encode():
    return Tokenizer.from_file(PATH).encode


def plain(rows, encode):
    """(doc_id, start, n_tokens, ids_crc32) of rows in order."""
    out, start = [], 0
    for i, text in rows:
        ids = np.asarray([*encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab1 \t\n.,'sé日\x1c\x85 <|endoftext>")), max_size=5))
def test_ids_of_whole_texts(texts):
    texts = [*texts, "a<|endoftext|> b <|endoftext|>", "it's  a \n b ", "a.\nB c$$$ d.%%%\ne' f's g_ (h) i<|endoftext|>. <|endoftext|>.\nj\n", "a\n\nb", "\na", "a\tb c", "a\u2003b c", "x\u0301 \u0531\u0561 \u1e9e!", "Éa été, là. straße! ªx µ, ǅ. x,y", "x" * 200 + " 日" * 40]
    encode = Tokenizer.from_file(PATH).encode
    assert [np.frombuffer(b, "<u2").tolist() for b in id_store.encode_texts(texts, PATH)] == [encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_index_is_perfect_minimal_and_knows_strangers(n):
    hashes = id_store._hashes(list(range(n)))
    index = id_store.PerfectIndex.build(hashes)
    assert sorted(index.find(hashes).tolist()) == list(range(n))
    strangers = id_store._hashes([f"no {i}" for i in range(2000)])
    assert (index.find(strangers) >= 0).sum() <= 2
    assert len(index.bits) <= max(8, n) and len(index.sizes) < 40


def test_round_trip(spark, encode):
    rows = corpus(n=150)
    random.Random(4).shuffle(rows)
    expected = plain(sorted(rows), encode)
    for docs in (frame(spark, rows), clashing(spark, rows)):
        assert rows_of(id_store.document_ids(docs, scratch_path(spark, "ids"), PATH)) == expected


def test_keyed_access_and_payload(spark, encode):
    rows = corpus(n=80)
    path = scratch_path(spark, "ids")
    id_store.write_ids(frame(spark, rows), path, PATH, file_bytes=2000)
    texts = dict(rows)
    found = {r["doc_id"]: r["ids"] for r in id_store.fetch_ids(spark, path, [7, 33, 80, 12345, -1]).collect()}
    assert found == {i: [*encode(texts[i] or "", add_special_tokens=False).ids, 2] for i in (7, 33, 80)}
    files = [bytes(r["content"]) for r in id_store._contents(spark, path).orderBy("file").collect()]
    assert len(files) > 1
    raw = b"".join(f[:2 * int(id_store.IdFile(f).starts[-1])] for f in files)
    assert np.frombuffer(raw, "<u2").tolist() == [t for i in sorted(texts) for t in [*encode(texts[i] or "", add_special_tokens=False).ids, 2]]
    with pytest.raises(ValueError):
        id_store.IdFile(b"something else, long enough to hold a trailer of that many bytes, and more")


def test_repeated_and_missing_ids_empty_tables(spark, encode):
    rows = [(5, f"text {i % 7}") for i in range(120)] + [(None, "no id"), (None, None), (1, ""), (9, "z")]
    found = rows_of(id_store.document_ids(frame(spark, rows), scratch_path(spark, "ids"), PATH))
    assert [r[0] for r in found] == [None] * 2 + [1] + [5] * 120 + [9]
    ends = [r[1] + r[2] for r in found]
    assert [r[1] for r in found] == [0, *ends[:-1]]
    assert sorted((str(r[0]), *r[2:]) for r in found) == sorted((str(r[0]), *r[2:]) for r in plain(rows, encode))
    assert id_store.document_ids(frame(spark, []), scratch_path(spark, "ids"), PATH).collect() == []
    text_keys = spark.createDataFrame([("b", "x"), ("a", "y")], "doc_id string, text string")
    assert [r[:3] for r in rows_of(id_store.document_ids(text_keys, scratch_path(spark, "ids"), PATH))] == [("a", 0, 2), ("b", 2, 2)]


def test_query(spark, encode):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert rows_of(op12_id_store(spark, SF)) == plain(rows, encode)
