"""Byte-level BPE by replaying the merges over all words of a block at once, and back to bytes."""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_text, worker_state
from .word_bpe import blocks

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_BYTES = 6_000_000
WORDS_KEPT = 200_000
# A space before something else than white space begins a word whatever stands before it. (These need not be all such.)
_CHUNK = r" [!-~\p{L}\p{N}]"
# Characters one of which a block of texts hardly has; it marks where chunks begin.
_MARKS = "".join(map(chr, range(1, 9)))


class ByteBpe:
    """Ranks of a file: bytes to ids and ids to bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.words[rank] = word
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted(
            (self.ranks[word[:i]] << 32 | self.ranks[word[i:]], rank)
            for word, rank in self.ranks.items()
            for i in range(1, len(word))
            if word[:i] in self.ranks and word[i:] in self.ranks
        )
        self.pair_keys = np.array([p for p, _ in pairs] + [2**62], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [-1], np.int64)
        self.known: dict[str, bytes] = {}

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, -1 if it isn't in the file."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word.

        All words lie one after another; every symbol knows its neighbours. The index leads from the rank of a pair to where it stands.
        Ranks are taken in order, least first, and a rank's merge is done wherever the index says; then the pairs with the
        neighbours of the merged symbols, and only those, are looked up and indexed.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        symbol = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbol)
        following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        following[ends - 1] = -1
        before[ends - sizes] = -1
        alive = np.ones(n, bool)
        pair = np.full(n, -1, np.int64)  # rank of the symbol joined with the following one
        at = np.flatnonzero(following >= 0)
        pair[at] = self.joined(symbol[at], symbol[following[at]])
        index: dict[int, list[np.ndarray]] = defaultdict(list)
        queue: list[int] = []

        def enter(at: np.ndarray) -> None:
            at = at[pair[at] >= 0]
            if not len(at):
                return
            ranks = pair[at]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            for rank, part in zip(ranks[starts].tolist(), np.split(at, starts[1:])):
                if not index[rank]:
                    heapq.heappush(queue, rank)
                index[rank].append(part)

        owner = None
        late: set[int] = set()
        enter(at)
        while queue:
            rank = heapq.heappop(queue)
            parts = index.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            at = at[pair[at] == rank]
            if not len(at):
                continue
            second = following[at]
            if len(at) > 1 and np.isin(second, at, assume_unique=True).any():  # as in aaa: from the left, without overlaps
                taken, used = [], set()
                for a, b in zip(at.tolist(), second.tolist()):
                    if a not in used:
                        taken.append(a)
                        used.add(b)
                at = np.array(taken)
                second = following[at]
            third = following[second]
            symbol[at] = rank
            alive[second] = False
            pair[second] = -1
            following[at] = third
            inner = third >= 0
            before[third[inner]] = at[inner]
            pair[at] = -1
            pair[at[inner]] = self.joined(symbol[at[inner]], symbol[third[inner]])
            left = before[at]
            left = left[left >= 0]
            pair[left] = self.joined(symbol[left], symbol[following[left]])
            touched = np.concatenate([at[inner], left])
            early = touched[(pair[touched] >= 0) & (pair[touched] < rank)]
            if len(early):  # its turn came before: such words are done again, one pair at a time
                owner = np.repeat(np.arange(len(words)), sizes) if owner is None else owner
                late.update(owner[early].tolist())
            enter(touched)
        left_over = np.flatnonzero(alive)
        counts = np.add.reduceat(alive, ends - sizes) if n else np.zeros(0, np.int64)
        packed = symbol[left_over].astype("<u4").tobytes()
        stops = np.cumsum(counts) * 4
        out = [packed[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
        for i in late:
            out[i] = np.array(self.one(words[i]), "<u4").tobytes()
        return out

    def one(self, word: bytes) -> list[int]:
        """Ids of a word, merging the leftmost pair of least rank again and again."""
        symbols = [bytes([b]) for b in word]
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(a + b, len(self.words)), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.words):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [self.ranks[s] for s in symbols]

    def learn(self, words: set[str]) -> None:
        """Ids of words not known yet; one that is a token whole is that token."""
        merged, raw = [], []
        for word in words:
            data = word.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is None:
                merged.append(word)
                raw.append(data)
            else:
                self.known[word] = whole.to_bytes(4, "little")
        if raw:
            self.known.update(zip(merged, self.replay(raw)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another; starts of the texts."""
        mark = next((m for m in _MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
        if mark:
            split = pc.split_pattern(pc.replace_substring_regex(texts, _CHUNK, mark + r"\0"), mark)
        else:  # every text is a chunk
            split = pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), texts)
        coded = split.flatten().dictionary_encode()
        offsets = np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()
        chunks = [self.pattern.findall(c) for c in coded.dictionary.to_pylist()]
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        self.learn({w for words in chunks for w in words if w not in self.known})
        known = self.known
        made = [b"".join([known[w] for w in words]) for words in chunks]
        starts = np.zeros(len(made) + 1, np.int64)
        np.cumsum([len(m) // 4 for m in made], out=starts[1:])
        flat = np.frombuffer(b"".join(made), "<u4")
        ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.uint32())).take(coded.indices)
        return np.asarray(ids.flatten()).astype(np.int32), np.asarray(ids.offsets, np.int64)[offsets]


def byte_bpe(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """The tokenizer of a file, kept as long as the Python worker."""
    path = path or public_tokenizers.path(RANKS)
    return worker_state("byte-bpe", f"{path} {pattern}", lambda: ByteBpe(path, pattern))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every row of docs: doc_id, ids (array of int).

    Each match of the pattern is encoded apart, special strings are ordinary text. Null and empty texts have no ids. Repeated rows and null
    doc_ids are encoded like others; equal texts have equal ids. No rows give no rows. Other columns are ignored.

    A block of texts is the corpus whose different words the merges are replayed over; a block is bounded in bytes (or one text).
    """

    def run(batches):
        bpe = byte_bpe(path)
        for batch in blocks(batches, limit=BLOCK_BYTES):
            ids, starts = bpe.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """rows with `ids`: their other columns and `decoded`, the bytes that the ids stand for. Null ids give null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", decoded binary"

    def run(batches):
        words = byte_bpe(path).words
        table = pa.array(words, pa.binary())
        for batch in batches:
            ids = batch.column("ids")
            flat = table.take(ids.flatten())
            # The taken words lie one after another, so a row's bytes are a stretch of them.
            data, ends = flat.buffers()[2], np.frombuffer(flat.buffers()[1], np.int32)[flat.offset :]
            lengths = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
            bounds = ends[np.concatenate([[0], np.cumsum(lengths)])]
            decoded = [data[a:b].to_pybytes() if ok else None for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), ids.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(documents(spark, sf_dir)))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
