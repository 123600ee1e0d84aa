"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text becomes ``FEATURES`` (lengths, shares of character classes, repetition, distinct
words); labels, lang, source and doc_id are never inputs. The trees are grown level by level from
gradient histograms over ``BINS`` quantile bins with numpy, then flattened into arrays of complete
binary trees; a block of documents walks all trees at once, one vectorised step per level.

The trees learn from a bounded sample: the ``SAMPLE`` labelled doc_ids with the smallest hash, so
their statistics (SAMPLE x features numbers) fit the driver and their ids may be broadcast. Scoring
covers every row and is a map without a shuffle.

Null texts are empty and get a score like any other; a doc_id labelled twice counts as its larger
label; null labels and null doc_ids do not teach; without any labelled row every score is 1 (nothing
speaks against a text). Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import crc_mod, documents, encode, hand_back, saved, starts_of
from tidewater.llm.quality_rules import WHITE, _class_matrix, blocks, byte_histograms, repeated_words

SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, LEAST, RIDGE = 64, 80, 4, 0.15, 20, 1.0
#: characters of text worked on at once (or one text): about 20 arrays of 8 bytes a word are alive
BLOCK = 1 << 20
#: fixed value of the contract
ACCEPT = 0.7

FEATURES = ("log_words", "mean_word", "longest_word", "lower", "upper", "digit", "blank", "newline", "stop", "symbol", "other",
            "beyond", "exclaim", "bar", "distinct", "top_word", "same_as_last", "repeat3", "dup_lines", "log_line")


def features(texts: list[str]) -> np.ndarray:
    """One row of statistics per text."""
    hist = byte_histograms(texts).astype(float) if texts else np.zeros((0, 256))
    flat, lens, words = encode(texts)
    starts = starts_of(lens)
    n = np.maximum(lens, 1)
    chars = np.maximum(hist.sum(1) - hist[:, 0x80:0xC0].sum(1), 1)
    classes = hist @ _class_matrix() / chars[:, None]
    size = np.fromiter(map(len, words), np.int64, len(words))[flat] if len(words) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(lens)), lens)
    longest = np.zeros(len(lens))
    np.maximum.at(longest, doc, size)
    total = starts_of(size)
    key = np.sort(doc * np.int64(max(len(words), 1)) + flat)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(key)])
    owner = key[first] // max(len(words), 1) if len(key) else first
    distinct = np.bincount(owner, minlength=len(lens))
    top = np.zeros(len(lens))
    np.maximum.at(top, owner, times)
    again = np.zeros(len(flat), np.int64)
    if len(flat) > 1:
        again[1:] = (flat[1:] == flat[:-1]) & (doc[1:] == doc[:-1])
    again = starts_of(again)
    dup, line = np.zeros(len(lens)), np.zeros(len(lens))
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip(WHITE)]
        dup[i] = (len(lines) - len(set(lines))) / max(1, len(lines))
        line[i] = np.log1p(len(t) / max(1, len(lines)))
    return np.column_stack([
        np.log1p(lens), (total[starts[1:]] - total[starts[:-1]]) / n, np.log1p(longest), classes,
        hist[:, ord("!")] / chars, hist[:, ord("|")] / chars, distinct / n, top / n,
        (again[starts[1:]] - again[starts[:-1]]) / n, repeated_words(flat, lens, len(words)) / n, dup, line])


@dataclass
class Trees:
    """Complete binary trees of one depth, one row per tree: the children of node i are 2i+1, 2i+2."""

    feature: np.ndarray      # trees x inner nodes
    limit: np.ndarray        # go right where the value is over the limit
    leaf: np.ndarray         # trees x leaves
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x."""
        out = np.full(len(x), self.bias)
        if len(self.feature):
            inner = self.feature.shape[1]
            tree = np.arange(len(self.feature))[None, :]
            row = np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            while node.size and node[0, 0] < inner:
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.limit[tree, node])
            out += self.leaf[tree, node - inner].sum(1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees for the log-loss; the same rows in the same order give the same trees."""
    inner = 2 ** depth - 1
    none = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(y):
        return Trees(*none, bias=np.inf)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return Trees(*none, bias=bias)
    cols = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(cols)]
    code = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    offset = np.arange(cols) * bins
    usable = np.arange(bins)[None, :] < np.asarray([len(c) for c in cuts])[:, None]
    f, g = np.full(len(y), bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, base = 2 ** level, 2 ** level - 1
            at = (((node - base) * cols * bins)[:, None] + offset + code).ravel()
            shape = (width, cols, bins)
            G = np.bincount(at, np.repeat(grad, cols), width * cols * bins).reshape(shape).cumsum(2)
            H = np.bincount(at, np.repeat(hess, cols), width * cols * bins).reshape(shape).cumsum(2)
            N = np.bincount(at, minlength=width * cols * bins).reshape(shape).cumsum(2)
            allG, allH, allN = (v[:, :1, -1:] for v in (G, H, N))
            gain = G ** 2 / (H + RIDGE) + (allG - G) ** 2 / (allH - H + RIDGE) - allG ** 2 / (allH + RIDGE)
            gain = np.where(usable[None] & (N >= LEAST) & (allN - N >= LEAST), gain, -1.0).reshape(width, -1)
            best = gain.argmax(1)
            for k in np.flatnonzero(gain[np.arange(width), best] > 1e-9):
                j, b = divmod(int(best[k]), bins)
                feature[base + k], limit[base + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + RIDGE)
        f += value[leaf]
        g.append((feature, limit, value))
    return Trees(*(np.stack(v) for v in zip(*g)), bias=bias)


def _texts(values: pa.Array) -> Iterator[list[str]]:
    """The texts of an Arrow array in blocks; only one block at a time is made Python strings."""
    return blocks((v.as_py() for v in values), BLOCK)


def stats_udf():
    @F.arrow_udf("array<double>")
    def stats(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            rows = [features(b) for b in _texts(s)]
            yield pa.array([list(r) for x in rows for r in x], pa.list_(pa.float64()))
        hand_back()

    return stats


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the labelled rows whose crc32(doc_id as text) mod 4 is not 2."""
    known = (labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
             .where(crc_mod("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # one row per doc_id, however often it repeats: the text of smallest hash
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("_h"), "text"))["text"].alias("text"))
    rows = saved(rows.select("doc_id", "quality", stats_udf()(F.col("text")).alias("x")), "quality-sample").toPandas()
    x = np.asarray(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    order = np.lexsort([*x.T[::-1], rows["doc_id"].to_numpy()])
    return fit(x[order], rows["quality"].to_numpy(float)[order])


def with_score(docs: DataFrame, model: Trees, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of each text."""
    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            got = [model.score(features(b)) for b in _texts(s)]
            yield pa.array(np.concatenate(got) if got else np.zeros(0))
        hand_back()

    return docs.withColumn(name, score(F.col(text)))


def op6_quality_model(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = with_score(docs, model)
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
