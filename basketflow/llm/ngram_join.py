"""Similarity join on word n-grams: MinHash banding finds candidates, full n-gram sets verify them."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, gram_hashes, id_text, one_of_each, rows_of, stash, word_hashes

# Documents of a candidate component that one task compares with one another at a time.
BLOCK = 256


def banding(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that a pair at the threshold shares one with this probability."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def gram_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a text of fewer words is one gram, a text without words has none."""
    hashes = word_hashes(text)
    return np.unique(gram_hashes(hashes, min(n, len(hashes)))) if len(hashes) else np.empty(0, np.uint64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, node (128-bit key of the gram set, null without grams), bands (a hash per band)."""
    made = np.random.default_rng(20_240_601).integers(1, 2**63, (2, bands * rows), dtype=np.uint64)
    schema = "doc_id long, text_key long, node string, bands array<long>"

    def sign(batches):
        mul, add = made[0] * np.uint64(2) + np.uint64(1), made[1]
        with np.errstate(over="ignore"):
            for batch in batches:
                nodes, keys = [], []
                for (text,) in rows_of([batch], "text"):
                    grams = gram_set(text, n)
                    if not len(grams):
                        nodes.append(None)
                        keys.append(None)
                        continue
                    least = np.full(bands * rows, 2**64 - 1, np.uint64)
                    for i in range(0, len(grams), 2048):
                        least = np.minimum(least, (grams[i : i + 2048, None] * mul + add).min(0))
                    mixed = np.zeros(bands, np.uint64)
                    for column in least.reshape(bands, rows).T:
                        mixed = (mixed ^ column) * np.uint64(0xFF51AFD7ED558CCD)
                        mixed ^= mixed >> np.uint64(32)
                    nodes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).hexdigest())
                    keys.append(mixed.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.string()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "node", "bands"],
                )

    return id_text(docs, F.xxhash64("text").alias("text_key")).mapInArrow(sign, schema)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, root): the least node reachable. Nodes without an edge don't appear.

    Large-star and small-star rounds; each round is written down, and its groupings carry minima
    only, so a node with any number of neighbours is pre-aggregated and its join can be split.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if larger:
            least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
            moved = both.join(least.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            down = both.filter("b < a")
            least = down.groupBy("a").agg(F.min("b").alias("m"))
            moved = down.join(least.hint("merge"), "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.filter("a <> b").distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    pairs = stash(edges.select("a", "b").filter("a <> b").distinct(), "links")
    before = state(pairs)
    while before[0]:
        pairs = stash(star(star(pairs, True), False), "links")
        now = state(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, gram, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[gram] > 1  # a gram of one document adds to no intersection
    gram, owner = gram[shared], owner[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if len(gram):
        _, gram = np.unique(gram, return_inverse=True)
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
        for start in range(0, gram[-1] + 1, 8192):
            lo, hi = np.searchsorted(gram, [start, start + 8192])
            held = np.zeros((len(sets), 8192), np.float32)
            held[owner[lo:hi], gram[lo:hi] - start] = 1
            out += held @ held.T
    np.fill_diagonal(out, sizes)
    return out


def _similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard similarity reaches the threshold, without the diagonal."""
    sizes = np.array([len(s) for s in sets], np.float64)
    both = _overlaps(sets).astype(np.float64)
    near = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    np.fill_diagonal(near, False)
    return near


def _roots(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row of its component."""
    root = np.arange(len(near))
    while True:
        least = np.minimum(root, np.where(near, root[None, :], len(near)).min(1))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def gram_sets(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """node, size, grams of the members (node, doc_id, text_key): at least one row of each node, which rows of several tasks may repeat.

    Of rows with one doc_id and text a task sends one.
    """

    def once(batches):
        seen = set()
        for batch in batches:
            keys = list(zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()))
            new = []
            for i, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            yield batch if len(new) == len(keys) else batch.take(pa.array(new, pa.int32()))

    def grams(batches):
        for batch in batches:
            sets = [gram_set(t, n) for (t,) in rows_of([batch], "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "size", "grams"]
            )

    left = id_text(docs, F.xxhash64("text").alias("text_key")).mapInArrow(once, "doc_id long, text string, text_key long")
    named = members.select("node", F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"))
    texts = left.join(named.hint("merge"), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")))
    return texts.select("node", "text").mapInArrow(grams, "node string, size int, grams binary")


def narrowed(members: DataFrame, held: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """members (node, comp, copies) with the components of more than `block` members cut into finer ones, by an exact filter.

    With the grams of a component in one order, the rarest first, two sets whose similarity reaches the threshold share one of the first
    size - ceil(threshold * size) + 1 grams of each. What many texts have in common comes last in this order, so texts that share only
    boilerplate part. Members that share none of these grams with another one have no link and are left out.
    """
    counts = members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    large = counts.filter(F.col("n") > block).select("comp")
    if large.isEmpty():
        return members
    small = members.join(large, "comp", "left_anti")
    inside = stash(members.join(large, "comp").join(held, "node").groupBy("node", "comp").agg(F.first("size").alias("size"), F.first("grams").alias("grams")), "large-components")

    def one_by_one(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                grams = np.frombuffer(batch.column("grams")[i].as_py(), np.int64)
                fixed = [pa.array([batch.column(c)[i].as_py()] * len(grams), k) for c, k in (("comp", pa.string()), ("node", pa.string()), ("size", pa.int32()))]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(grams)], names=["comp", "node", "size", "gram"])

    single = inside.mapInArrow(one_by_one, "comp string, node string, size int, gram long")
    often = single.groupBy("comp", "gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = single.join(often.hint("merge"), ["comp", "gram"]).groupBy("comp", "node").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("shared"))
    first = F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1
    alone = F.col("size") - F.size("shared")  # grams of no other member come before all shared ones
    prefix = F.slice("shared", F.lit(1), F.greatest(first - alone, F.lit(0)).cast("int"))
    keys = stash(shared.select("comp", "node", F.explode(prefix).alias("p")).select("comp", "node", "p.gram"), "rare-grams")
    hubs = keys.groupBy("comp", "gram").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    finer = components(keys.join(hubs.hint("merge"), ["comp", "gram"]).select(F.col("node").alias("a"), F.col("hub").alias("b")))
    cut = members.drop("comp").join(finer.withColumnRenamed("root", "comp").hint("merge"), "node")
    return small.unionByName(cut)


def verified(held: DataFrame, members: DataFrame, threshold: float, block: int = BLOCK, partners: bool = False) -> DataFrame:
    """Verified links between members (node, comp, copies) of one comp with their gram sets: node, n_links, root, linked.

    A comp of more than about `block` members is cut into blocks and every pair of blocks compared, each as a group of its own.
    A row is a node with links in one such group: n_links counts the documents (copies included) it is linked to there, root is the least
    node that the group's links lead to, linked names the linked nodes if partners is set (at most two blocks), else it
    is null. Over all rows every link stands at both its ends, once.
    """
    sizes = members.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = members.join(sizes.hint("merge"), "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = held.join(placed.hint("merge"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "grams"
    )

    def verify(batches):
        def found(key, members):
            comp, i, j = key
            names = sorted(members)  # a repeated row counts once
            near = _similar([np.frombuffer(members[x][2], np.uint64) for x in names], threshold)
            if i != j:
                side = np.array([members[x][0] for x in names])
                near &= side[:, None] != side[None, :]
            copies, root = np.array([members[x][1] for x in names]), _roots(near)
            for at in np.flatnonzero(near.any(1)):
                yield names[at], int(copies[near[at]].sum()), names[root[at]], [names[k] for k in np.flatnonzero(near[at])] if partners else None

        def groups():
            key, members = None, {}
            for comp, i, j, own, node, copies, grams in rows_of(batches, "comp", "i", "j", "block", "node", "copies", "grams"):
                if (comp, i, j) != key:
                    if len(members) > 1:
                        yield from found(key, members)
                    key, members = (comp, i, j), {}
                members[node] = (own, copies, grams)
            if len(members) > 1:
                yield from found(key, members)

        kinds = {"node": pa.string(), "n_links": pa.int64(), "root": pa.string(), "linked": pa.list_(pa.string())}

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=[*kinds])

        rows = []
        for row in groups():
            rows.append(row)
            if len(rows) == 512:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return paired.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(verify, "node string, n_links long, root string, linked array<string>")


def links(docs: DataFrame, members: DataFrame, n: int, threshold: float, block: int = BLOCK, partners: bool = False) -> DataFrame:
    """As `verified`, for members (node, comp, doc_id, text_key, copies) of docs."""
    return verified(gram_sets(docs, members, n), members.select("node", "comp", "copies"), threshold, block, partners)


def classes(docs: DataFrame, n: int, threshold: float, recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of every row, and of every node its first row (doc_id, text_key), copies, root and n_links."""
    bands, rows = banding(threshold, recall)
    signed = stash(signatures(docs, n, bands, rows), "signatures")
    nodes = stash(
        signed.filter("node is not null").groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "text_key")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
        ).select("node", "rep.doc_id", "rep.text_key", "copies", "bands"),
        "nodes",
    )
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = keys.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).filter("members > 1").drop("members")
    near = keys.join(hubs.hint("merge"), ["band", "key"]).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    comps = components(near).withColumnRenamed("root", "comp")
    members = stash(nodes.drop("bands").join(comps.hint("merge"), "node"), "members")
    held = stash(gram_sets(docs, members, n), "gram-sets")
    linked = stash(verified(held, narrowed(members.select("node", "comp", "copies"), held, threshold, block), threshold, block), "verified")
    counts = linked.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.join(roots.hint("merge"), "node", "left").join(counts.hint("merge"), "node", "left").select("node", "doc_id", "text_key", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed, named


def ngram_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9995, block: int = BLOCK) -> DataFrame:
    """Every row of docs: doc_id, class_id, n_links, n_copies.

    Two documents are linked when the Jaccard similarity of their sets of word n-grams (lower-cased words) reaches the
    threshold. n_links counts the linked documents with another set, copies of them included; n_copies the documents with
    the same set; class_id is the least doc_id that links and copies lead to. A text of fewer than n words is one gram; a null or empty text or one
    without words links with nothing, and its class is its doc_id. Repeated rows count as copies. Null doc_ids are compared like others and
    come first among equals only if a class has no other. No rows give no rows. Other columns are ignored.

    Documents of one set are one node. Nodes that share a band hash fall in one candidate component, which holds
    every pair the bands propose. Large components are cut by their rarest grams, then all pairs inside are verified on the full sets, block by block.
    """
    signed, named = classes(docs, n, threshold, recall, block)
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    info = named.join(least.hint("merge"), "root").select("node", "class_id", "n_links", "copies")
    return signed.select("doc_id", "node").join(info.hint("merge"), "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies")
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """Pipeline stage: of each class of near duplicates exactly one row of the least doc_id, all columns of docs.

    Decided by doc_id and text, not by doc_id alone. Texts without words stay, one row of each doc_id and text.
    """
    signed, named = classes(docs, n, threshold, recall, BLOCK)
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "text_key")).alias("rep")).select("rep.doc_id", F.col("rep.text_key").alias("key"))
    wordless = signed.filter("node is null").select("doc_id", F.col("text_key").alias("key"))
    return one_of_each(docs, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), first.unionByName(wordless))
