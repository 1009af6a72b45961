"""The word-level BPE of a tokenizers file: ids and counts of whole texts, a block of texts at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import Memo, worker_state

WORD_BPE = "word_bpe_49k.json"
BLOCK_BYTES = 8_000_000
# Chunks of these characters are lower-cased and parted here; the library alone handles all others.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PRETOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1 (no space), else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordBpe:
    """Ids as the library gives them, for a file whose pattern drops white space.

    ASCII white space parts tokens whatever surrounds it, so the chunks between are encoded apart, each distinct one of a block once.
    `proven` holds the pre-tokens that are one token: every vocabulary string that ends a word, of which the library itself was
    asked whether it encodes alone as that very token. Only other pre-tokens are merged.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.proven = self._prove()
        self.memo = Memo(self._merge, 300_000)

    def _prove(self) -> dict[str, bytes]:
        byte = {c: b for b, c in enumerate(self.letters)}
        strings, ids = [], []
        for token, at in self.library.get_vocab(with_added_tokens=False).items():
            if token.endswith("</w>") and all(c in byte for c in token[:-4]):
                text = bytes(byte[c] for c in token[:-4]).decode("utf-8", "replace")
                if _PLAIN.fullmatch(text) and _PRETOKEN.findall(text) == [text]:
                    strings.append(text)
                    ids.append(at)
        found = self.library.encode_batch(strings, add_special_tokens=False)
        return {s: self.packed[i] for s, i, e in zip(strings, ids, found) if e.ids == [i]}

    def _merge(self, pretoken: str) -> bytes:
        if not pretoken.isascii():
            pretoken = "".join(map(self.letters.__getitem__, pretoken.encode()))
        packed = self.packed
        return b"".join([packed[t.id] for t in self.library.model.tokenize(pretoken)])

    def alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def chunk(self, text: str) -> bytes:
        """Ids of a chunk without white space."""
        if not text:
            return b""
        stem = text[:-1] if text[-1] in ",." else text
        if stem.isascii() and stem.isalpha():  # most chunks: a word, perhaps with a mark behind it
            word = stem.lower()
            ids = self.proven.get(word) or self.memo[word]
            return ids if stem is text else ids + (self.proven.get(text[-1]) or self.memo[text[-1]])
        if not _PLAIN.fullmatch(text) or self.special.search(text):
            return self.alone(text)
        out = b""
        for pretoken in _PRETOKEN.findall(text.lower()):
            out += self.proven.get(pretoken) or self.memo[pretoken]
        return out

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of the distinct chunks the ids one after another and their starts; each text's chunks, as codes, and their starts."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        made = [self.chunk(c) for c in coded.dictionary.to_pylist()]
        starts = np.zeros(len(made) + 1, np.int64)
        np.cumsum([len(m) // 4 for m in made], out=starts[1:])
        return np.frombuffer(b"".join(made), "<u4"), starts, coded.indices, np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text."""
        _, starts, codes, offsets = self.block(texts)
        total = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(np.diff(starts)[np.asarray(codes)], out=total[1:])
        return np.diff(total[offsets])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another; starts of the texts."""
        flat, starts, codes, offsets = self.block(texts)
        chunks = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.uint32())).take(codes)
        return np.asarray(chunks.flatten()), np.asarray(chunks.offsets, np.int64)[offsets]


def word_bpe(path: str | None = None) -> WordBpe:
    """The tokenizer of a file, kept as long as the Python worker."""
    path = path or public_tokenizers.path(WORD_BPE)
    return worker_state("word-bpe", path, lambda: WordBpe(path))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their texts exceed so many bytes; a longer text makes a block of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                pa.default_memory_pool().release_unused()
                start, held = i, 0
            held += int(size)
        if len(sizes) > start:
            yield batch.slice(start)
            pa.default_memory_pool().release_unused()
