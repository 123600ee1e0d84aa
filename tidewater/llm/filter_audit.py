"""Filter interaction audit by count-weighted decision diagrams.

Each document has a failure mask, one bit per filter. Per part, the counts of the masks (documents, good ones,
toxic ones) are a decision diagram with one level per filter: a node stands for all documents that share the
outcomes above it, its two edges for passing and failing the level's filter, and its weight is the sum below
it. Equal sub-diagrams are one node. Two neighbouring filters change places by an adjacent level swap, which
rebuilds only the nodes of these two levels; all orders are visited by such swaps alone (each differs from the last by
one, as in plain changes). In the diagram of an order the all-pass path tells what every step keeps (the passing
child) and removes (the failing child). With a filter at the top its failing child holds all its
failures; at the bottom of the all-pass path, the documents that fail it alone.

Filters of the query, over words ``[^\\x20\\x09-\\x0D]+``: A under 100 words; B 100 * distinct words < 80 * words;
C 100 * ``[A-Z]`` > 10 * code points; D any of ``#$%&*|``; E the same text stands in a row of smaller doc_id.

Defined cases: null texts are empty; a null lang is the part ''; a row with a null doc_id neither fails E nor makes another
row fail it, and has no label; repeated rows are counted each, and rows that share doc_id and text do not fail E by each
other; of several labels of one doc_id any 1 counts; empty tables give empty results; other columns are not looked at.

Rows meet in three places: digests of equal texts and labels (plain joins of written tables, so a hot key is
split), and the masks of a part, which are counted by a partial + final aggregate: at most 2^filters rows of
counts per part reach the function that holds its diagram.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import documents, saved, whole

#: Fixed values of the contract.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SYMBOLS = b"#$%&*|"

_ALL = bytes(range(256))
NOT_UPPER = bytes(b for b in _ALL if not 65 <= b <= 90)
NOT_SYMBOL = bytes(b for b in _ALL if b not in SYMBOLS)
CONTINUATION = bytes(range(0x80, 0xC0))


def text_mask(raw: bytes) -> int:
    """Failures of the filters A to D of a UTF-8 text, as bits 0 to 3."""
    words = raw.split()                                          # ASCII white space, as the contract's words
    points = len(raw.translate(None, CONTINUATION))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * len(raw.translate(None, NOT_UPPER)) > UPPER_PERCENT * points) << 2
            | (len(raw.translate(None, NOT_SYMBOL)) > 0) << 3)


def _masks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        masks, digests = [], []
        for value in b.column(2):                                # one text at a time
            raw = value.as_py()
            masks.append(text_mask(raw))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                                         names=["doc_id", "part", "mask", "digest"])


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every row, with the bits of all five filters."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), whole("text").cast("binary").alias("raw"))
    rows = saved(rows.mapInArrow(_masks_of, "doc_id long, part string, mask int, digest binary"), "masks")
    copies = (rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1 and _first is not null").select("digest", "_first"))
    rows = rows.join(saved(copies, "copies"), "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    return rows.select("doc_id", "part", (F.col("mask") + F.when(later, 1 << 4).otherwise(0)).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and failure mask; rows: (doc_id, part, mask)."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("_toxic"))
    known = saved(known.where("_good + _toxic > 0").withColumnRenamed("doc_id", "_id"), "labelled")
    at = rows.join(known, F.col("doc_id") == F.col("_id"), "left")
    zero = F.lit(0).cast("long")
    return at.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("_good", zero)).alias("good"), F.sum(F.coalesce("_toxic", zero)).alias("toxic"))


class Diagram:
    """Weights of failure masks as an ordered diagram; ``order[i]`` is the filter of level i."""

    def __init__(self, filters: int, weights: dict[int, tuple[int, ...]]):
        size = len(next(iter(weights.values()), (0,)))
        self.order = list(range(filters))
        self.weight: list[tuple[int, ...]] = []
        self.child: list[tuple[int, int] | None] = []
        self.levels: list[dict] = [{} for _ in range(filters + 1)]      # per level: (passing, failing) or weight -> node
        self.zero = (0,) * size
        self.root = self._build(0, weights)

    def _new(self, weight, child) -> int:
        self.weight.append(weight)
        self.child.append(child)
        return len(self.weight) - 1

    def _node(self, level: int, ok: int, bad: int) -> int:
        known = self.levels[level]
        if (ok, bad) not in known:
            known[ok, bad] = self._new(tuple(map(sum, zip(self.weight[ok], self.weight[bad]))), (ok, bad))
        return known[ok, bad]

    def _build(self, level: int, weights: dict[int, tuple[int, ...]]) -> int:
        if level == len(self.order):
            total = next(iter(weights.values()), self.zero)
            known = self.levels[level]
            if total not in known:
                known[total] = self._new(total, None)
            return known[total]
        sides = [{m: w for m, w in weights.items() if m >> self.order[level] & 1 == side} for side in (0, 1)]
        return self._node(level, self._build(level + 1, sides[0]), self._build(level + 1, sides[1]))

    def swap(self, level: int) -> None:
        """The filters of ``level`` and ``level + 1`` change places. Nodes above keep their place and meaning, so
        only the edges of the upper level and the nodes of the lower one are made anew."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for u in upper:
            ok, bad = self.child[u]
            (ok_ok, ok_bad), (bad_ok, bad_bad) = self.child[ok], self.child[bad]
            self.child[u] = (self._node(level + 1, ok_ok, bad_ok), self._node(level + 1, ok_bad, bad_bad))
            self.levels[level][self.child[u]] = u
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, weight kept, weight removed) of every step of the present order."""
        at = self.root
        for f in self.order:
            ok, bad = self.child[at]
            yield f, self.weight[ok], self.weight[bad]
            at = ok


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap with the next one so that n! - 1 swaps visit every order of n filters once: the largest filter
    sweeps through the places of the others, and the others change once at each end of a sweep."""
    if n < 2:
        return
    inner, down = plain_changes(n - 1), True
    while True:
        yield from reversed(range(n - 1)) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def audit(weights: dict[int, tuple[int, int, int]], names: Iterable[str]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders and steps."""
    names = list(names)
    diagram = Diagram(len(names), weights)
    orders, fails, alone, shapley = [], {}, {}, dict.fromkeys(range(len(names)), 0)

    def note():
        steps = list(diagram.all_pass())
        fails[steps[0][0]] = steps[0][2][0]
        alone[steps[-1][0]] = steps[-1][2][0]
        for f, _, removed in steps:
            shapley[f] += removed[0]
        orders.append(("".join(names[f] for f, _, _ in steps), steps))

    note()
    for level in plain_changes(len(names)):
        diagram.swap(level)
        note()
    return [(order, i + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], shapley[f])
            for order, steps in orders for i, (f, kept, removed) in enumerate(steps)]


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
          "toxic_lost long, shapley long")


def interactions(counts: DataFrame, names: Iterable[str] = FILTERS) -> DataFrame:
    """The audit of every part; counts: (part, mask, n, good, toxic), one row per part and mask."""
    names = list(names)
    columns = [c.split()[0] for c in RESULT.split(", ")]

    def of_part(pdf: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(pdf["mask"], pdf["n"], pdf["good"], pdf["toxic"])}
        return pd.DataFrame([(pdf["part"].iloc[0], *row) for row in audit(weights, names)], columns=columns)

    return counts.groupBy("part").applyInPandas(of_part, RESULT)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return interactions(mask_counts(failures(documents(spark, sf_dir)), labels))


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
  SELECT part, doc_id, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM words),
known AS (
  SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS m, count(*) AS n,
         coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, bit)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS o, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letter p, letter q, letter r, letter s, letter t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
    AND len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
steps AS (
  SELECT o, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before FROM orders, range(1, 6) AS g(k)),
done AS (
  SELECT part, o AS filter_order, step, bit,
    sum(CASE WHEN m & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN m & before > 0 AND m & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN m = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM done
"""
