"""Near-dedup with BagMinHash signatures of word shingles.

A text is the multiset of its runs of ``SHINGLE`` words (words as they stand, split at ASCII white space;
a text of fewer words is one shorter run). Texts are near copies when the weighted Jaccard similarity
of their multisets, sum of minima over sum of maxima, is ``LEAST`` or more.

*Signature.* Weights are discretised in unit cells, cells are grouped in dyadic ranges [0,1), [1,2),
[2,4), [4,8)..., and every (shingle, range) has a Poisson process of points, each with a place in time, a
signature component and a cell of the range. A point counts for a text when its cell is below the text's
weight of that shingle, so equal shingles with different weights share the points of the cells they share.
Component i is the first point that counts; two texts agree in it with exactly their weighted
Jaccard similarity. Processes are followed only until the text's components are (very likely) filled,
about ln(components) + 6 mean waiting times; texts with an open component are followed for twice as long.

*Candidates.* ``BANDS`` bands of ``ROWS`` components; at similarity 0.8 a pair shares a band with
probability above 0.9999. Texts with the same words are one node before banding. In each band bucket
all nodes are held against one hub, the node with the most bucket mates over all its bands, which in a
group of edited copies is the text they come from (a star, linear in the bucket); verified links are
contracted to components. Buckets that still hold several components are mostly texts that share passages
without being near copies. One minus the similarity is a distance with a triangle inequality, so a node outside of its hub's component at distance d
from the hub can only be a near copy of nodes at distance d - 0.2 or more: the nodes nearer to the hub, most of a large
family, leave the bucket without loss. The nodes that stay (if they are more than ``FEW``) get a second, sharper signature of ``SHARP_BANDS`` bands of
``SHARP_ROWS`` components (above 0.9998 at similarity 0.8, about 0.01 at 0.5), with stars again. Nodes that then still
share a bucket with another component are joined exactly with the nodes that stay in those buckets: near copies must share one
of their rarest elements (prefix filtering by frequency, a prefix for every band of sizes that a partner may have), and every pair that does is verified.

*Verification.* Exact multiset overlap of the candidates' texts, with 64-bit shingle hashes.

The result is one row per document with its class, the connected component of verified links. Null and
empty texts have no shingle and stay alone; repeated rows and texts with the same words share a class; null
doc_ids are allowed (the class is named by the smallest doc_id that is not null); empty tables give empty
results; other columns are carried by :func:`drop_near_copies` as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import documents, encode, hand_back, mix64, saved, starts_of, unit, whole, whole_row, word_hashes
from tidewater.llm.components import components
from tidewater.llm.quality_rules import blocks

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 32, 6
SHARP_BANDS, SHARP_ROWS = 192, 14
#: characters of text worked on at once (or one text): about 20 arrays of 8 bytes a shingle are alive
BLOCK = 2 << 20
#: sets of (doc_id, hash, node) keys up to this many rows (about 60 bytes each) may be broadcast
BROADCAST_KEYS = 300_000
#: with up to this many nodes in crowded buckets the exact join takes them as they are, without the sharper bands before it
FEW = 1000
#: ratio of the sizes at the ends of a band of the exact join
SIZE_STEP = 1.06
GOLDEN, STEP2, STEP3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingles(texts: list[str], size: int = SHINGLE):
    """(hash of every shingle, text index of every shingle, words per text), in text order."""
    flat, lens, words = encode(texts)
    starts = starts_of(lens)
    own = word_hashes(words)[flat] if len(words) else np.zeros(0, np.uint64)
    parts, docs = [], []
    if len(own) >= size:
        acc = np.zeros(len(own) - size + 1, np.uint64)
        for i in range(size):
            acc = mix64(acc * GOLDEN + own[i:len(own) - size + 1 + i])
        doc = np.repeat(np.arange(len(lens)), lens)
        inside = np.flatnonzero(doc[:len(acc)] == doc[size - 1:])
        parts.append(acc[inside])
        docs.append(doc[inside])
    for i in np.flatnonzero((lens > 0) & (lens < size)):
        acc = np.full(1, lens[i], np.uint64)
        for x in own[starts[i]:starts[i + 1]]:
            acc = mix64(acc * STEP2 + x)
        parts.append(acc)
        docs.append(np.full(1, i))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), lens
    h, doc = np.concatenate(parts), np.concatenate(docs)
    return h, doc, lens


def weighted(h: np.ndarray, doc: np.ndarray):
    """Distinct (text, shingle) with the number of its occurrences, sorted by text, then hash."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
    return h[first], np.diff(np.r_[first, len(h)]).astype(np.int64), doc[first]


def bag_minhash(h: np.ndarray, weight: np.ndarray, doc: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Signatures (texts x size): the time of the first point of each component; infinite for empty texts."""
    total = np.bincount(doc, weight, texts)
    out = np.full((texts, size), np.inf)
    follow, wait = total > 0, np.log(size) + 6
    while follow.any():
        pick = follow[doc]
        levels = np.ceil(np.log2(np.maximum(weight[pick], 1))).astype(np.int64) + 1
        first = starts_of(levels)
        at = np.repeat(np.flatnonzero(pick), levels)
        level = np.arange(first[-1]) - np.repeat(first[:-1], levels)
        low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
        width = np.maximum(low, 1)
        seed = mix64(h[at] + (level.astype(np.uint64) + np.uint64(1)) * STEP3)
        cell_limit, owner = weight[at], doc[at]
        limit = wait / np.maximum(total, 1)[owner]
        time, turn = np.zeros(len(at)), 0
        flat = out.reshape(-1)
        while len(time):
            turn += 1
            r = mix64(seed + np.uint64(turn * int(GOLDEN) & (1 << 64) - 1))
            time = time - np.log(unit(r)) / (size * width)
            on = np.flatnonzero(time <= limit)
            seed, time, width, low, cell_limit, owner, limit, r = (
                a[on] for a in (seed, time, width, low, cell_limit, owner, limit, r))
            r = mix64(r ^ STEP2)
            component = ((r >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
            cell = low + (((r & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            hit = cell < cell_limit
            np.minimum.at(flat, owner[hit] * size + component[hit].astype(np.int64), time[hit])
        follow &= np.isinf(out).any(1)
        wait *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts x bands) keys; the band's number is part of the key."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rows):
        acc = mix64(acc * GOLDEN + bits[:, :, i])
    return acc.view(np.int64)


def packed_bag(h: np.ndarray) -> bytes:
    """A multiset of hashes as a sorted set: the k-th occurrence of a hash is an element of its own."""
    h = np.sort(h)
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    k = np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))
    return np.sort(np.where(k > 0, mix64(h + k.astype(np.uint64) * STEP3), h)).tobytes()


def similarity(a, b) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


NODE = "node binary, shingles long, bands array<long>"


def _nodes_udf(size: int, bands: int, rows: int):
    import xxhash

    @F.arrow_udf(NODE)
    def node(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            names, sizes, keys = [], [np.zeros(0, np.int64)], [np.zeros((0, bands), np.int64)]
            for texts in blocks((v.as_py() for v in s), BLOCK):
                h, doc, lens = shingles(texts, size)
                distinct, weight, owner = weighted(h, doc)
                keys.append(band_keys(bag_minhash(distinct, weight, owner, len(texts), bands * rows), bands, rows))
                names += [xxhash.xxh3_128_digest(b" ".join(t.encode("utf-8", "surrogatepass").split())) for t in texts]
                sizes.append(np.bincount(doc, minlength=len(texts)))
            flat = pa.ListArray.from_arrays(np.arange(0, (len(names) + 1) * bands, bands, dtype=np.int32), np.concatenate(keys).ravel())
            yield pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(np.concatenate(sizes), pa.int64()), flat],
                                             names=["node", "shingles", "bands"])
        hand_back()

    return node


def _bag_udf(size: int):
    @F.arrow_udf("binary")
    def bag(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            out = []
            for texts in blocks((v.as_py() for v in s), BLOCK):
                h, doc, _ = shingles(texts, size)
                order = np.argsort(doc, kind="stable")
                cut = np.searchsorted(doc[order], np.arange(len(texts) + 1))
                h = h[order]
                out += [packed_bag(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.array(out, pa.binary())
        hand_back()

    return bag


def _sharp_udf(bands: int, rows: int):
    @F.arrow_udf("array<long>")
    def sharp(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            keys = [np.zeros((0, bands), np.int64)]
            for i in range(0, len(s), 64):
                own = [np.frombuffer(b.as_buffer(), np.uint64) for b in s.slice(i, 64)]
                h, doc = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
                signature = bag_minhash(mix64(h + GOLDEN), np.ones(len(h), np.int64), doc, len(own), bands * rows)
                keys.append(band_keys(signature, bands, rows))
            yield pa.ListArray.from_arrays(np.arange(0, (len(s) + 1) * bands, bands, dtype=np.int32), np.concatenate(keys).ravel())
        hand_back()

    return sharp


def _overlap_udf():
    @F.arrow_udf("double")
    def overlap(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in parts:
            yield pa.array([similarity(x.as_buffer(), y.as_buffer()) for x, y in zip(a, b)], pa.float64())
        hand_back()

    return overlap


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) with the similarity of their texts. A hub's many pairs are split by the skew join."""
    a = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    b = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(a, "a").join(b, "b")
    return both.select("a", "b", _overlap_udf()("bag_a", "bag_b").alias("sim"))


def _members(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, node, shingles) of the buckets with two nodes or more, (node, central)); bands: (node, shingles, bands)."""
    keys = bands.select("node", "shingles", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").count().where("count > 1")
    members = saved(keys.join(shared, "key"), "members")
    return members.select("key", "node", "shingles"), members.groupBy("node").agg(F.sum("count").alias("central"))


def _stars(members: DataFrame, central: DataFrame, bags: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """All nodes of every bucket against its hub: (the buckets with the hub and the least and the greatest distance to the
    hub that a node may have, the similarities of the pairs tried). Pairs whose sizes rule out ``least`` are not tried."""
    hub = members.join(central, "node").groupBy("key").agg(F.max(F.struct("central", "node", "shingles")).alias("hub"))
    at = members.join(saved(hub.select("key", F.col("hub.node").alias("hub"), F.col("hub.shingles").alias("hub_size")), "hubs"), "key")
    at = at.select("key", "node", "hub", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"),
                   (F.least("shingles", "hub_size") / F.greatest("shingles", "hub_size")).alias("ratio"))
    tried = at.where((F.col("node") != F.col("hub")) & (F.col("ratio") >= least)).select("a", "b").distinct()
    sims = saved(_similar(tried, bags), "similarities")
    at = at.join(sims, ["a", "b"], "left")
    own = F.when(F.col("node") == F.col("hub"), F.lit(0.0)).otherwise(1 - F.col("sim"))
    return at.select("key", "node", "hub", F.coalesce(own, 1 - F.col("ratio")).alias("near"), F.coalesce(own, F.lit(1.0)).alias("far")), sims


def _links(pairs: DataFrame, least: float) -> DataFrame:
    return pairs.where(F.col("sim") >= least).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _open(at: DataFrame, root: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(the buckets' nodes that are not in the component of their hub, those and the nodes that may be near copies of one of
    them) as (key, node, root), and (node, root), each once. A settled node is left out where the triangle inequality rules it out; the conditions
    are inside the joins, so settled rows are never made."""
    now = saved(at.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled")
    hubs = now.where("node = hub").select(F.col("key").alias("_k"), F.col("root").alias("hub_root"))
    outside = now.join(hubs, (F.col("key") == F.col("_k")) & (F.col("root") != F.col("hub_root")))
    outside = saved(outside.select("key", "node", "root", "hub_root", "near"), "outside")
    limit = outside.groupBy(F.col("key").alias("_k")).agg(F.first("hub_root").alias("hub_root"), F.min("near").alias("nearest"))
    may = (F.col("root") != F.col("hub_root")) | (F.col("far") >= F.col("nearest") - (1 - least) - 1e-9)
    open_ = now.join(limit, (F.col("key") == F.col("_k")) & may).select("node", "root").distinct()
    return outside, saved(open_, "open")


def _by_rare_elements(nodes: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of an outside node and any other node of another component that may be near copies: prefix filtering.

    Two sets of x and y elements with similarity ``least`` share at least ``need`` = least / (1 + least) * (x + y) elements. With the
    elements of each in one common order, the first one shared is among the first x - need + 1 and y - need + 1.
    The order is by frequency, rarest first, so passages that many texts share come last and form no pairs.
    """
    @F.pandas_udf("array<long>")
    def elements(bag: pd.Series) -> pd.Series:
        return bag.map(lambda b: np.frombuffer(b, np.int64))

    every = bags.select("node", "bag").join(nodes, "node").select("node", "root", "shingles", "_out", F.explode(elements("bag")).alias("e"))
    every = saved(every, "elements")
    often = every.groupBy("e").count()
    rank = F.row_number().over(Window.partitionBy("node").orderBy("count", "e")) - 1
    # nothing shares an element that occurs once; a partner has between least and 1 / least times the size
    first = every.join(often.where("count > 1"), "e", "left").withColumn("count", F.coalesce("count", F.lit(1))).withColumn("p", rank)
    first = first.where((F.col("count") > 1) & (F.col("p") <= (1 - least) * F.col("shingles") + 1))
    # one prefix for every band of partner sizes, with the least size of the band: texts of one size meet at their first ninth only
    steps = int(np.ceil(np.log(1 / least) / np.log(SIZE_STEP)))
    own = F.floor(F.log(F.col("shingles").cast("double")) / np.log(SIZE_STEP) + 1e-9).cast("int")
    first = first.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.col("own") - steps, F.col("own") + steps)))
    smallest = F.greatest(F.pow(F.lit(SIZE_STEP), F.col("other").cast("double")) * (1 - 1e-6), least * F.col("shingles"))
    first = first.where(F.col("p") <= F.col("shingles") - F.lit(least / (1 + least)) * (F.col("shingles") + smallest) + 1e-6)
    first = saved(first.select("node", "root", "shingles", "_out", "e", "p", "own", "other"), "prefixes")
    a = first.where("_out").select("e", F.col("own").alias("ba"), F.col("other").alias("bb"), F.col("node").alias("a"), F.col("root").alias("ra"),
                                   F.col("shingles").alias("na"), F.col("p").alias("pa"))
    b = first.select("e", F.col("other").alias("ba"), F.col("own").alias("bb"), F.col("node").alias("b"), F.col("root").alias("rb"),
                     F.col("shingles").alias("nb"), F.col("p").alias("pb"), F.col("_out").alias("ob"))
    need = F.lit(least / (1 + least)) * (F.col("na") + F.col("nb")) - 1e-6
    hit = (F.col("ra") != F.col("rb")) & (~F.col("ob") | (F.col("a") < F.col("b")))
    hit &= (F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb")) & (F.col("pa") <= F.col("na") - need) & (F.col("pb") <= F.col("nb") - need)
    pairs = a.join(b, ["e", "ba", "bb"]).where(hit)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, _nd_hash (of the text), node, class (its root node, null for texts
    without a word)."""
    docs = docs.select("doc_id", whole("text").alias("text")).withColumn("_nd_hash", F.xxhash64("text"))
    found = docs.select("doc_id", "_nd_hash", _nodes_udf(shingle, bands, rows)(F.col("text")).alias("n"))
    found = saved(found.select("doc_id", "_nd_hash", "n.*"), "nodes")
    nodes = (found.where("shingles > 0").groupBy("node")
             .agg(F.min(F.struct("doc_id", "_nd_hash")).alias("w"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles")))
    nodes = saved(nodes, "node-set")
    members, central = _members(nodes)

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    wanted = saved(wanted.select("node", "shingles", F.col("w.doc_id").alias("_w_id"), F.col("w._nd_hash").alias("_nd_hash")), "wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    texts = docs.join(side, "_nd_hash").where(F.col("doc_id").eqNullSafe(F.col("_w_id")))
    bags = saved(texts.select("node", "shingles", _bag_udf(shingle)(F.col("text")).alias("bag")).dropDuplicates(["node"]), "bags")

    at, tested = _stars(members, central, bags, least)
    root = components(_links(tested, least))
    outside, open_ = _open(at, root, least)
    many = open_.count()
    if many > FEW:
        # buckets that hold more than one component: the nodes that may still be linked again, in sharper bands
        tasks = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        sharp = bags.join(open_, "node", "left_semi").repartition(tasks, "node").select("node", "shingles", _sharp_udf(SHARP_BANDS, SHARP_ROWS)(F.col("bag")).alias("bands"))
        members, central = _members(saved(sharp, "sharp"))
        members = members.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
        members = saved(members.join(mixed, "key", "left_semi").select("key", "node", "shingles"), "mixed")
        at, more = _stars(members, central, bags, least)
        root = components(_links(more, least), root)
        outside, open_ = _open(at, root, least)
        many = open_.count()
    if not many:
        return _classed(found, root)

    # what is left lies in one bucket with others, but not in their component: an exact join of those nodes with
    # the nodes of these buckets that may be their near copies, by their rarest elements
    left = outside.select("node").distinct().withColumn("_out", F.lit(True))
    nodes = open_.join(bags.select("node", "shingles"), "node")
    nodes = nodes.join(left, "node", "left").withColumn("_out", F.coalesce("_out", F.lit(False)))
    pairs = _by_rare_elements(nodes, bags, least)
    return _classed(found, components(_links(_similar(pairs, bags), least), root))


def _classed(found: DataFrame, root: DataFrame) -> DataFrame:
    return found.join(root, "node", "left").select(
        "doc_id", "_nd_hash", "node", F.when(F.col("shingles") > 0, F.coalesce("root", "node")).alias("class"))


def near_copy_report(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its class), class_size, kept."""
    rows = saved(classes(docs, **how), "classes")
    sizes = (rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
             .where("class_size > 1"))
    out = rows.join(saved(sizes, "sizes"), "class", "left")     # a plain join: the rows of a large class are split
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
                      (F.col("class_id").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def drop_near_copies(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each class (its smallest doc_id), all columns unchanged. Documents that are
    alone in their class pass as they are; the others are grouped by class."""
    rows = saved(classes(docs, **how), "classes")
    crowd = rows.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("_nd_n")).where("_nd_n > 1")
    crowd = saved(rows.join(saved(crowd, "sizes"), "class").select(
        F.col("doc_id").alias("_id2"), F.col("_nd_hash").alias("_hash2"), "class").distinct(), "crowd")
    side = F.broadcast(crowd) if crowd.count() <= BROADCAST_KEYS else crowd
    row, order = whole_row(docs, "doc_id")
    at = docs.select(row.alias("row"), order.alias("order"), F.col("doc_id").alias("_id"), F.xxhash64(whole("text")).alias("_hash"))
    at = at.join(side, (F.col("_hash") == F.col("_hash2")) & F.col("_id").eqNullSafe(F.col("_id2")), "left")
    one = at.where("class is not null").groupBy("class").agg(F.min_by("row", "order").alias("row"))
    return at.where("class is null").select("row").unionAll(one.select("row")).select("row.*")


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_copy_report(documents(spark, sf_dir).select("doc_id", "text"))
