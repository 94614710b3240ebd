import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tiergrain.llm import byte_bpe as B
from tiergrain.llm.byte_bpe import BytePairCodec, encode_documents, read_ranks

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return BytePairCodec(read_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(codec, text):
    packed = codec.encode_packed(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_single_pieces_match_the_library(codec, library):
    rng = random.Random(7)
    pool = [t for t in codec.tokens if 1 < len(t) < 8]
    for _ in range(4000):
        piece = b"".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))
        assert codec.encode_piece(piece) == library._encode_single_piece(piece)
    for alphabet in (b"ab", b"aeiou", b"ththe", b"\xc3\xa9\xc3", b"   \n"):
        for _ in range(300):
            piece = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
            assert codec.encode_piece(piece) == library._encode_single_piece(piece)


def test_every_vocabulary_token_twice(codec, library):
    for t in codec.tokens[::7]:
        assert codec.encode_piece(t + t) == library._encode_single_piece(t + t)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_matches_the_library(codec, library, text):
    assert ids(codec, text) == library.encode_ordinary(text)
    assert codec.decode_packed(codec.encode_packed(text)) == text.encode()


def test_long_pieces_and_texts(codec, library):
    for text in ("a" * 20_000, "ab" * 9_000, "été" * 5_000, "the quick fox " * 30_000):
        assert ids(codec, text) == library.encode_ordinary(text)


def test_frame_edges(spark, library):
    rows = [(1, "déjà vu 123", "x"), (2, None, "x"), (3, "", None), (None, "a\x00b", "x"), (1, "déjà vu 123", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode_documents(df, PATH, P.PATTERN).collect()
    assert len(out) == 5
    for (doc, text, _), r in zip(rows, out):
        want = library.encode_ordinary(text or "")
        assert r.doc_id == doc and r.n_tokens == len(want)
        assert bytes(r.ids) == struct.pack(f"<{len(want)}I", *want)
        assert bytes(r.decoded) == (text or "").encode()
    assert encode_documents(df.limit(0), PATH, P.PATTERN).count() == 0


def test_query_against_the_library(spark, library):
    from tiergrain.llm.registry import op4_byte_bpe

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op4_byte_bpe(spark, "/root/testdata/sf0.001").collect():
        want = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_other_operators_free_the_memo_tables():
    from tiergrain.llm import decontaminate
    from tiergrain.llm.common import only_memos_of
    codec = B._worker_codec(tuple(read_ranks(PATH)), P.PATTERN)
    ids = codec.encode_packed("some words, some more words")
    assert len(codec._pieces) > 0
    list(decontaminate.seeds(["some", "words"] * 10, decontaminate.MASKS))
    assert not codec._pieces and not codec._compatible and len(decontaminate._hashes) == 2
    assert B._worker_codec(tuple(read_ranks(PATH)), P.PATTERN).encode_packed("some words, some more words") == ids
    assert not decontaminate._hashes
    only_memos_of("toxicity")
    assert not codec._pieces


def test_a_text_is_encoded_once_and_results_leave_in_small_batches(spark, codec, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(B, "CODED_PER_BATCH", 400)
    calls, encode = [], codec.encode_packed
    monkeypatch.setattr(codec, "encode_packed", lambda t: calls.append(t) or encode(t))
    texts = ["a few plain words " * 5, None, "", "naïve 你好 \U0001f600"] * 20
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, *range(79)], pa.int64()), "text": pa.array(texts, pa.string())})
    parts = list(B.coded_batches(iter([batch]), codec))
    assert calls == [t or "" for t in texts] and len(parts) > 4
    assert all(sum(map(len, p.column(1).to_pylist()[:-1])) < 400 for p in parts)
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["doc_id"] for r in rows] == [None, *range(79)]
    assert [r["decoded"].decode() for r in rows] == calls[:80]
    coded = B.encode_documents(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), PATH, P.PATTERN)
    assert "decode(encode(" not in coded._jdf.queryExecution().executedPlan().toString()


def test_freed_memory_goes_back_at_a_change_of_operator(monkeypatch):
    from tiergrain.llm import common
    back = []
    monkeypatch.setattr(common, "_give_back", lambda: back.append(1))
    monkeypatch.setattr(common, "_ran", [])
    for operator in ("bpe", "toxicity", "toxicity", "simhash"):
        common.only_memos_of(operator)
    assert len(back) == 3
