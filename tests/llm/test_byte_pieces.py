"""The written sentencepiece model against the tokenizer's own library, and round trips."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from loadlens.llm import byte_pieces

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    ranks = byte_pieces.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tool():
    return byte_pieces.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def same(tool, own, text):
    ids = tool.encode(text)
    assert array("I", ids).tolist() == own.encode_ordinary(text), text[:80]
    assert tool.decode(ids) == text.encode()


def test_every_byte_has_its_own_letter():
    assert len(set(byte_pieces.byte_letters())) == 256


def test_every_code_point(tool, own):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lead in ("", "a", "1", " "):
        for at in range(0, len(points), 20_000):
            same(tool, own, "".join(lead + c for c in points[at : at + 20_000]))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sStdrelvm.1 \n\t\x00\x1c\x85 　é中я😀՘"), max_size=60))
def test_mixed_texts(tool, own, text):
    same(tool, own, text)


def test_long_texts(tool, own):
    rng = random.Random(1)
    same(tool, own, "a" * 30_000)
    same(tool, own, " " * 5_000 + "\n" * 5_000)
    words = " ".join(rng.choice(["alpha", "beta", "été", "слово", "12345", "x-y"]) for _ in range(300_000))
    same(tool, own, words)  # beyond AT_ONCE and several portions


def test_gaps_in_the_ranks(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 270}
    tool = byte_pieces.Tokenizer(byte_pieces.piece_model(ranks), public_tokenizers.PATTERN, {})
    assert array("I", tool.encode("abc ab")).tolist() == [270, 32, 300]  # a whole pre-token counts as one, whatever its merges
    with pytest.raises(ValueError):
        byte_pieces.piece_model({b"a": 0})


def test_query(spark, own):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = entry.queries()["op12_byte_bpe"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = own.encode_ordinary(texts[r.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, tool, own, monkeypatch):
    monkeypatch.setattr(byte_pieces, "BATCH_BYTES", 64)
    texts = [(1, "one two"), (1, "one two"), (None, "no id"), (2, None), (3, ""), (4, "x" * 3_000_000), (5, "\x0b \t")]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in texts], "doc_id long, text string, ids string, `decoded` string")
    back = byte_pieces.decode(byte_pieces.encode(docs, tool, ["doc_id"]), tool, ["doc_id"])
    assert back.columns == ["doc_id", "decoded"]
    got = sorted((r.doc_id or 0, bytes(r.decoded)) for r in back.collect())
    assert got == sorted((i or 0, (t or "").encode()) for i, t in texts)
    assert byte_pieces.encode(docs.limit(0), tool, ["doc_id"]).count() == 0
