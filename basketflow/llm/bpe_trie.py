"""Byte-level BPE of a tokenizers file: distinct words hang in a trie, and every shared prefix is encoded once.

The encoding of a word is known from the last token of each of its prefixes: cut that token off, and what is left is a shorter prefix. The
last token of a prefix is the one token at its end that stands after the last token of the rest, that is, whose encoding together with
that token is the two of them. So a node of the trie holds one token, computed from its ancestors' tokens; words below it share it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Memo, documents, id_text, worker_state
from .word_bpe import _byte_letters, blocks

BYTE_BPE = "byte_bpe_50k.json"
BLOCK_BYTES = 6_000_000
WORDS_KEPT = 200_000
PAIRS_KEPT = 1_000_000
# Fixed value: how byte-level files of this kind part words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Where the pattern and the library agree on every character (a test asks for each); words of other texts are the library's.
_AGREED = regex.compile(r"[\x00-ӿ　-鿿]*")
# A space before something else than white space begins a word whatever stands before it. (These need not be all such.)
_CHUNK = r" [!-~\p{L}\p{N}]"
_MARKS = "".join(map(chr, range(1, 9)))


class TrieBpe:
    """Ids as the library gives them and back, for a file with byte-level words and merges in the order of their ids."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        model = json.loads(self.library.to_str())["model"]
        byte = {c: b for b, c in enumerate(_byte_letters())}
        added = self.library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.words = [b""] * self.library.get_vocab_size()
        for token, i in model["vocab"].items():
            self.words[i] = bytes(byte[c] for c in token)
        for content, i in self.special.items():
            self.words[i] = content.encode()
        vocab = model["vocab"]
        self.merged = {(vocab[a], vocab[b]): vocab[a + b] for a, b in model["merges"]}
        order = list(self.merged.values())
        halves = {t: p for p, t in self.merged.items()}
        if order != sorted(order) or len(halves) != len(order) or any(max(p) >= t for p, t in self.merged.items()):
            raise ValueError("merges must make one token each, in the order of their ids, from earlier tokens")
        self.ids = {w: i for i, w in enumerate(self.words) if w and i not in added}
        if any(i not in halves and len(w) > 1 for w, i in self.ids.items()):
            raise ValueError("every token must be a byte or made by a merge")
        # What stands at a token's right and left edge while it is merged together: the byte, ..., the token itself.
        self.right, self.left = [()] * len(self.words), [()] * len(self.words)
        for i in sorted(self.ids.values(), key=lambda i: len(self.words[i])):
            a, b = halves.get(i, (None, None))
            self.right[i], self.left[i] = ((i,), (i,)) if a is None else ((*self.right[b], i), (*self.left[a], i))
        # The longest token with these last three bytes.
        self.longest: dict[bytes, int] = {}
        for w in self.ids:
            if len(w) > 2:
                self.longest[w[-3:]] = max(len(w), self.longest.get(w[-3:], 0))
        self.pair = Memo(self._stays, PAIRS_KEPT)
        self.pattern = regex.compile(_WORDS)
        self.known: dict[str, bytes] = {}
        self.table = pa.array(self.words, pa.binary())
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.words))]

    def _stays(self, pair: int) -> bool:
        """Whether two tokens side by side stay as they are: no merge across their border comes before those that make them.

        Seen from the border, the left token grows through its right edge and the right token through its left edge, in the order of their merges;
        at equal rank the left one is first.
        """
        right, left = self.right[pair >> 32], self.left[pair & 0xFFFFFFFF]
        i = j = 0
        never = len(self.words)
        while True:
            next_i = right[i + 1] if i + 1 < len(right) else never
            next_j = left[j + 1] if j + 1 < len(left) else never
            across = self.merged.get((right[i], left[j]), never)
            if across < next_i and across <= next_j and across != never:
                return False
            if next_i == next_j == never:
                return True
            if next_i <= next_j:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of every distinct word.

        Sorted words are the trie in preorder: a word leaves the path of the one before where they begin to differ. `last` holds the tokens of
        the nodes on the present path; going down adds one per byte, going up drops them.
        """
        lookup, longest, sizes, pair = self.ids.get, self.longest.get, [len(w) for w in self.words], self.pair
        out: dict[bytes, list[int]] = {}
        last: list[int] = []
        before = b""
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared:]
            depth = shared
            for depth in range(shared + 1, len(word) + 1):
                start = depth - longest(word[depth - 3 : depth], 2) if depth > 3 else 0
                if start < 0:
                    start = 0
                while True:  # the longest token first; a single byte always is one
                    token = lookup(word[start:depth])
                    if token is not None and (not start or pair[last[start - 1] << 32 | token]):
                        break
                    start += 1
                last.append(token)
            found, depth = [], len(word)
            while depth:
                token = last[depth - 1]
                found.append(token)
                depth -= sizes[token]
            found.reverse()
            out[word] = found
            before = word
        return out

    def parted(self, chunk: str) -> list[str]:
        """The words of a chunk without special strings."""
        if chunk.isascii():
            if chunk[1:].isalpha() and chunk[0] == " ":
                return [chunk]
            if chunk[-1:] in (",", ".") and chunk[1:-1].isalpha() and chunk[0] == " ":
                return [chunk[:-1], chunk[-1]]
        elif not _AGREED.fullmatch(chunk):
            return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        return self.pattern.findall(chunk)

    def pieces(self, chunk: str) -> list[str]:
        """The words and special strings of a chunk."""
        return [w for part in self.cut.split(chunk) for w in ([part] if part in self.special else self.parted(part))]

    def learn(self, words: set[str]) -> None:
        ids = self.encode_words(map(str.encode, words))
        packed = self.packed.__getitem__
        self.known.update((w, b"".join(map(packed, ids[w.encode()]))) for w in words)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another; starts of the texts."""
        special = np.zeros(len(texts), bool)
        for content in self.special:
            special |= np.asarray(pc.match_substring(texts, content), bool)
        mark = next((m for m in _MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
        if mark:  # a text with special strings stays one chunk, since those part words too
            marked = pc.if_else(pa.array(special), texts, pc.replace_substring_regex(texts, _CHUNK, mark + r"\0"))
            split = pc.split_pattern(marked, mark)
        else:
            split = pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), texts)
        coded = split.flatten().dictionary_encode()
        offsets = np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()
        if special.any():
            chunks = [self.pieces(c) if self.cut.search(c) else self.parted(c) for c in coded.dictionary.to_pylist()]
        else:
            chunks = list(map(self.parted, coded.dictionary.to_pylist()))
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        for content, i in self.special.items():
            self.known[content] = self.packed[i]
        self.learn({w for words in chunks for w in words if w not in self.known})
        known = self.known
        made = [b"".join([known[w] for w in words]) for words in chunks]
        starts = np.zeros(len(made) + 1, np.int64)
        np.cumsum([len(m) // 4 for m in made], out=starts[1:])
        flat = np.frombuffer(b"".join(made), "<u4")
        ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.uint32())).take(coded.indices)
        return np.asarray(ids.flatten()).astype(np.int32), np.asarray(ids.offsets, np.int64)[offsets]

    def decode(self, ids: pa.Array) -> pa.Array:
        """The texts that lists of ids stand for; bytes that are no UTF-8 become replacement characters."""
        flat = self.table.take(ids.flatten())
        lengths = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), np.int64)
        stops = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
        bounds = stops[np.concatenate([[0], np.cumsum(lengths)])]
        data = flat.buffers()[2] or pa.py_buffer(b"")
        joined = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds.astype(np.int32)), data])
        joined = pc.if_else(ids.is_valid(), joined, pa.scalar(None, pa.binary()))
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if b is None else b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def trie_bpe(path: str | None = None) -> TrieBpe:
    """The tokenizer of a file, kept as long as the Python worker."""
    path = path or public_tokenizers.path(BYTE_BPE)
    return worker_state("trie-bpe", path, lambda: TrieBpe(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every row of docs: doc_id, ids (array of int) as the library gives them without added special tokens, truncation or padding.

    Special strings inside a text are the special tokens, as is the library's default. The trie holds the different words of a block of texts
    that no earlier block of the worker had; a block is bounded in bytes (or one text), and so are the words kept. Null and
    empty texts have no ids. Repeated rows and null doc_ids are encoded like others. No rows give no rows. Other columns are ignored.
    """

    def run(batches):
        bpe = trie_bpe(path)
        for batch in batches:
            for block in blocks([batch], limit=BLOCK_BYTES):
                ids, starts = bpe.encode(block.column("text"))
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """rows with `ids`: their other columns (but for one called `decoded`) and the text `decoded` with special tokens in it. Null ids give null."""
    kept = [f for f in rows.schema.fields if f.name.lower() != "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", decoded string"

    def run(batches):
        bpe = trie_bpe(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, bpe.decode(batch.column("ids"))], names=[*batch.schema.names, "decoded"])

    return rows.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def op11_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(documents(spark, sf_dir)))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
