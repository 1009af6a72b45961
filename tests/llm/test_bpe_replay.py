import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm.bpe_replay import byte_bpe, decode, encode, op9_byte_bpe
from conftest import SF

BPE = byte_bpe()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def own(texts):
    ids, starts = BPE.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aabé \n\t.'sB01\x01\x1c\x85\xa0\u3000"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_any_texts(texts):
    assert own(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["", " ", "a" * 301, "ab" * 77, "  \n\n  x  ", "".join(map(chr, range(1, 9))) + " a b", "<|endoftext|>", "x" * 20_000])
def test_hard_texts(text):
    assert own([text, "between", text]) == [LIBRARY.encode_ordinary(t) for t in (text, "between", text)]


def test_replay_with_ranks_that_come_late(tmp_path):
    """abc ranks before ab: after ab has merged, the pair with c has an earlier rank."""
    words = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"xa", b"ab", b"abab", b"cab", b"aba"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % i for i, w in enumerate(words)))
    bpe = byte_bpe(str(path))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    texts = ["ab", "abab", "ababc", "xabcab", "cabab", "abababab", "xabxab", "aabbaabcc"]
    ids, starts = bpe.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [library.encode_ordinary(t) for t in texts]


def test_round_trip_of_documents(spark, docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in op9_byte_bpe(spark, SF).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, odd, none):
    found = sorted((str(r.doc_id), r.decoded.decode()) for r in decode(encode(odd)).collect())
    assert found == sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert decode(encode(none)).collect() == []
    rows = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [0, 1], "z")], "k int, ids array<int>, more string")
    assert [(r.k, r.more, r.decoded) for r in decode(rows).orderBy("k").collect()] == [(1, "x", None), (2, "y", bytearray(b"")), (3, "z", bytearray(BPE.words[0] + BPE.words[1]))]
