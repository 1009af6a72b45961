import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from basketflow.llm.bpe_trie import _AGREED, TrieBpe, decode, encode, op11_trie_bpe

from .conftest import ODD, SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return TrieBpe(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pattern_agrees_on_every_character_it_is_used_for(bpe, library):
    wrong = []
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        if _AGREED.fullmatch(c):
            probe = f"a{c}1{c}{c} {c}.{c}  {c}'{c}s"
            if bpe.pattern.findall(probe) != [probe[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(probe)]:
                wrong.append(c)
    assert not wrong


def test_every_token_alone_and_random_pairs(bpe, library):
    vocab = {w: i for w, i in bpe.ids.items()}
    got = bpe.encode_words(vocab)
    assert all(got[w] == [i] for w, i in vocab.items())
    rng = random.Random(1)
    words = [w for w in vocab if w.isalpha()]
    pairs = [rng.choice(words) + rng.choice(words) for _ in range(5000)]
    got = bpe.encode_words(pairs)
    assert all(got[w] == ids(library, w.decode()) for w in pairs)


def test_prefixes_are_encoded_once(bpe):
    """Words that begin alike look up no token for the part they share."""
    whole, asked = bpe.ids, []

    class Asked(dict):
        def get(self, word, default=None):
            asked.append(word)
            return dict.get(self, word, default)

    def lookups(words):
        asked.clear()
        bpe.encode_words(words)
        return len(asked)

    bpe.ids = Asked(whole)
    try:
        longest = lookups([b"internationally"])
        assert lookups([b"inter", b"international", b"internationally", b"internal"]) == longest + lookups([b"internal"]) - lookups([b"interna"])
    finally:
        bpe.ids = whole


@pytest.mark.parametrize("seed", range(3))
def test_texts_equal_the_library(bpe, library, seed):
    rng = random.Random(seed)
    pool = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "\r\n", "é", "日本語", "aaaa", "the", " quick", "1234", "'s", "'S", "\x1c", "₏", "😀", "ß", "____", "\t", "\x01", "Ā", "ͻ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x10000, 0x30000)])) for _ in range(30)) for _ in range(300)]
    texts += ["".join(rng.choice("abehtrin ") for _ in range(300)) for _ in range(300)] + ["", "x" * 100_000, " " * 10_000, "日本" * 20_000]
    if seed == 2:  # every mark occurs
        texts.append("".join(map(chr, range(1, 9))))
    flat, starts = bpe.encode(pa.array(texts))
    got = [flat[a:b].tolist() for a, b in zip(starts, starts[1:])]
    assert got == [ids(library, t) for t in texts]
    assert bpe.decode(pa.array(got, pa.list_(pa.int32()))).to_pylist() == texts


def test_ids_of_no_valid_text(bpe, library):
    rng = random.Random(9)
    rows = [[rng.randrange(50_257) for _ in range(rng.randrange(12))] for _ in range(2000)]
    got = bpe.decode(pa.array([*rows, None], pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(r, skip_special_tokens=False) for r in rows] + [None]


def test_query_equals_the_library(spark, library):
    got = op11_trie_bpe(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        found = ids(library, r.text)
        text = library.decode(found, skip_special_tokens=False)
        want.add((r.doc_id, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    rows = got.collect()
    assert len(rows) == len(want) and set(map(tuple, rows)) == want


def test_odd_rows_and_clashing_columns(spark, odd, none, library):
    coded = encode(odd.withColumns({"ids": odd.salt, "decoded": odd.node}))
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=key) == sorted(((r.doc_id, ids(library, r.text)) for r in odd.collect()), key=key)
    back = decode(coded.withColumn("decoded", coded.doc_id))
    assert back.columns == ["doc_id", "ids", "decoded"]
    assert sorted(r.decoded for r in back.collect()) == sorted(r.text or "" for r in odd.collect())
    assert encode(none).count() == decode(encode(none)).count() == 0
    special = spark.createDataFrame([(1, "a  <|endoftext|> b<|endoftext|><|endoftext|>", None, None, None, "n", "d", 1, 7, 0, "r", True, 3)], ODD)
    assert encode(special).collect()[0].ids == ids(library, "a  <|endoftext|> b<|endoftext|><|endoftext|>")
