"""Packing documents into sequences by cutting-stock column generation.

A document is its byte-BPE ids and a final id 1. It is cut at multiples of ``size`` from its start, so
its pieces have full length but for the last. Piece lengths are rounded up to ``step`` ids for planning,
which leaves at most size / step length classes: their histogram is all that reaches the driver. There
a linear program over patterns (how many pieces of each class share a sequence) is solved by column
generation: a revised simplex whose new columns come from a knapsack dynamic program over the dual
prices. Patterns are rounded down and the few pieces left over are filled first-fit decreasing. Every
piece gets a rank within its class, and (class, rank) decides its sequence and slot.

The rank comes from counts of about sqrt(n) hash ranges per class and a row number inside a range, so
no task orders a whole class. Tokenizing is a map; texts and ids are never shuffled. The tables that
are broadcast have a bound: classes x patterns, whatever the input.

Null texts are empty (their sequence piece is the id 1); null and repeated doc_ids are packed like
others, each row for itself; empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import arrow_blocks, binaries, documents, flat_bytes, hand_back, per_worker, saved, starts_of

SIZE, STEP, LAST_ID = 2048, 16, 1


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes: printable Latin-1 characters
    stand for themselves, the other bytes follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _fast(path: str):
    """The vocabulary of the tokenizer file as a tiktoken encoding, and the bytes of each id."""
    import public_tokenizers
    import tiktoken

    byte = _byte_of()
    vocabulary = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
    special = {t: i for t, i in vocabulary.items() if t.startswith("<|") and t.endswith("|>")}
    ranks = {t: i for t, i in ranks.items() if i not in special.values()}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(t) for t in ranks]
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def encoder(path: str, fast=None):
    """text -> ids, as ``tokenizers`` gives them for this file without special tokens. The vocabulary is handed
    to tiktoken, which is several times faster; texts that its splitter can't take go to ``tokenizers``."""
    fast, slow = fast or _fast(path)[0], []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except Exception:  # the splitter's backtracking limit; any error of the other way is raised
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(path))
                slow[0].encode_special_tokens = True
            return slow[0].encode(text, add_special_tokens=False).ids

    return encode


#: bytes of text that are encoded at once (or one text)
TEXTS = 4 << 20
#: stretches of text that a worker keeps with their ids (about 50 bytes each), and the bytes that they are shorter than
KEPT, LONGEST = 400_000, 64
#: first bytes of characters that are surely no white space: printable ASCII, and those of UTF-8 whose characters hold none
_VISIBLE = np.zeros(256, bool)
_VISIBLE[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True


def block_encoder(path: str):
    """texts (an Arrow array) -> (the ids of all texts one after the other, ids per text), as :func:`encoder` gives them.

    The splitter always begins a new piece at a blank that a visible character follows: a blank can only stand first in a piece of
    visible characters, and a run of white space before leaves its last blank to them. What comes before and after
    such a place is encoded alike apart, so texts are cut there, each distinct stretch is encoded once, all of a block in one
    call, and the ids are put together by position. Ends of stretches are checked against ends of ids; where one is missed,
    and for stretches that don't begin so (a text's first), each is encoded for itself. ``KEPT`` short stretches stay for later blocks.
    """
    fast, sizes = _fast(path)
    one = encoder(path, fast)
    kept, pool = pa.array([], pa.large_binary()), np.zeros(0, np.uint32)
    kept_start, kept_size = np.zeros((2, 0), np.int64)

    def joined(stretches: pa.Array):
        data, at = flat_bytes(stretches)
        try:
            ids = fast.encode_to_numpy(data.tobytes().decode("utf-8"), disallowed_special=())
        except Exception:  # as in encoder
            return None
        ends = starts_of(sizes[ids])
        cut = np.searchsorted(ends, at)
        return (ids, cut) if ends[-1] == at[-1] and (ends[cut] == at).all() else None

    def fresh(stretches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each stretch start, how many they are)."""
        data, at = flat_bytes(stretches)
        blank, long = np.zeros(len(stretches), bool), np.flatnonzero(np.diff(at) > 1)
        blank[long] = (data[at[long]] == 0x20) & _VISIBLE[data[at[long] + 1]]
        got = joined(stretches.filter(pa.array(blank)))
        if got is None:
            blank, got = np.zeros(len(stretches), bool), (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        single = [np.asarray(one(x.decode("utf-8")), np.uint32) for x in stretches.filter(pa.array(~blank)).to_pylist()]
        own = len(got[0]) + starts_of(np.asarray([len(x) for x in single], np.int64))
        start, size = np.zeros((2, len(stretches)), np.int64)
        start[blank], size[blank] = got[1][:-1], np.diff(got[1])
        start[~blank], size[~blank] = own[:-1], np.diff(own)
        return np.concatenate([got[0], *single]), start, size

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        nonlocal kept, pool, kept_start, kept_size
        data, at = flat_bytes(texts)
        begins = np.zeros(len(data), bool)
        begins[:-1] = (data[:-1] == 0x20) & _VISIBLE[data[1:]]
        held = at[:-1] < at[1:]
        begins[at[1:][held] - 1] = False                # the next byte is of another text
        begins[at[:-1][held]] = True
        begin = np.flatnonzero(begins)
        coded = binaries(data, np.append(begin, len(data))).dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary
        known = pc.index_in(distinct, kept).fill_null(-1).to_numpy()
        new = np.flatnonzero(known < 0)
        ids, first, many = fresh(distinct.take(pa.array(new)))
        every = np.concatenate([pool, ids])
        start, size = np.append(kept_start, 0)[known], np.append(kept_size, 0)[known]
        start[new], size[new] = len(pool) + first, many
        short = new[np.diff(flat_bytes(distinct)[1])[new] < LONGEST][:KEPT - len(kept)]
        if len(short):
            kept, pool = pa.concat_arrays([kept, distinct.take(pa.array(short))]), every
            kept_start, kept_size = np.append(kept_start, start[short]), np.append(kept_size, size[short])
        each = size[which]
        upto = starts_of(each)
        flat = every[np.repeat(start[which] - upto[:-1], each) + np.arange(upto[-1])]
        return flat, np.diff(upto[np.searchsorted(begin, at)])

    return encode


def ended(ids: np.ndarray, lens: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``last`` after those of each text, and the start of each text's ids and the end of the last."""
    return np.insert(ids, np.cumsum(lens), last), starts_of(lens + 1)


PIECE = "array<struct<start:long,length:long,ids_crc32:long,doc_tokens:long,ids:binary>>"


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids (little-endian)."""
    path = path or tokenizer_file()

    @F.arrow_udf(PIECE)
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = per_worker(("block encoder", path), lambda: block_encoder(path))
        for s in parts:
            rows, ends = [], [0]
            for texts in arrow_blocks(s, TEXTS):
                flat, at = ended(*encode(texts), LAST_ID)
                flat = flat.astype("<u4", copy=False)
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    ids = flat[a:b]
                    rows += [(i, len(p), zlib.crc32(p.tobytes()), len(ids), p.tobytes() if with_ids else None)
                             for i in range(0, len(ids), size) for p in (ids[i:i + size],)]
                    ends.append(len(rows))
            names = ["start", "length", "ids_crc32", "doc_tokens", "ids"]
            kinds = [pa.int64()] * 4 + [pa.binary()]
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(cols, names=names))
        hand_back()

    out = docs.select("doc_id", F.explode(cut(F.col("text"))).alias("p")).select("doc_id", "p.*")
    return out if with_ids else out.drop("ids")


def knapsack(value: np.ndarray, weight: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of items of integer weights that fits: (value, copies of each)."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c], fits = best[c - 1], weight <= c
        if fits.any():
            v = np.where(fits, best[c - np.minimum(weight, c)] + value, -1.0)
            k = int(v.argmax())
            if v[k] > best[c]:
                best[c], pick[c] = v[k], k
    copies, c = np.zeros(len(weight), np.int64), room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            copies[pick[c]] += 1
            c -= weight[pick[c]]
    return float(best[room]), copies


def inverted(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots. Plain array arithmetic: a driver that has forked (it starts the JVM)
    should not call threaded linear algebra."""
    k = len(basis)
    a = np.hstack([basis.astype(float), np.eye(k)])
    for i in range(k):
        pivot = i + int(np.abs(a[i:, i]).argmax())
        a[[i, pivot]] = a[[pivot, i]]
        a[i] /= a[i, i]
        factor = a[:, i].copy()
        factor[i] = 0
        a -= factor[:, None] * a[i]
    return a[:, k:]


def solve(count: np.ndarray, weight: np.ndarray, room: int, gap: float = 1e-3, most_steps: int = 2000):
    """The linear program: patterns (columns) and how often each is used, with patterns @ use == count.

    Columns are priced at a mean of the current dual prices and the best ones so far (which start at
    weight / room): they give a lower bound, and the search ends within ``gap`` of it. Ending
    early only costs padding, never a piece.
    """
    k = len(count)
    basis = np.diag(room // weight).astype(float)
    center, bound, keep = weight / room, float((count * weight).sum()) / room, 0.8
    for step in range(most_steps):
        if step % 64 == 0:
            inverse = inverted(basis)
            use = np.maximum((inverse * count).sum(1), 0)
        if use.sum() <= bound * (1 + gap) + 1:
            break
        price = inverse.sum(0)
        mixed = np.maximum(keep * center + (1 - keep) * price, 0)
        best, column = knapsack(mixed, weight, room)
        worth = float((count * mixed).sum()) / max(best, 1e-9)
        if worth > bound:
            bound, center = worth, mixed / best
        if (price * column).sum() <= 1 + 1e-9:          # no gain at the current prices
            if keep < 0.05:
                break
            keep *= 0.6
            continue
        keep = min(0.8, keep + 0.05)
        d = (inverse * column).sum(1)
        ratio = np.where(d > 1e-9, use / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        use = np.maximum(use - theta * d, 0)
        use[out] = theta
        inverse[out] /= d[out]
        rest = np.arange(k) != out
        inverse[rest] -= d[rest][:, None] * inverse[out]
        basis[:, out] = column
    return basis.astype(np.int64), np.maximum((inverted(basis) * count).sum(1), 0)


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each class in a sequence, number of such sequences)] that hold every piece exactly once."""
    classes = np.asarray(sorted(histogram), np.int64)
    count = np.asarray([histogram[c] for c in classes], np.int64)
    if not len(classes):
        return []
    patterns, use = solve(count.astype(float), classes, room)
    left, out = count.copy(), []
    for column, times in zip(patterns.T, np.floor(use + 1e-6).astype(np.int64)):
        held = column > 0
        times = min(int(times), int((left[held] // column[held]).min()))
        if times > 0:
            out.append(({int(c): int(n) for c, n in zip(classes[held], column[held])}, times))
            left -= column * times
    while left.any():           # first-fit decreasing, a sequence at a time
        free, pattern = room, {}
        for i in range(len(classes) - 1, -1, -1):
            n = int(min(left[i], free // classes[i]))
            if n:
                pattern[int(classes[i])] = n
                free -= n * int(classes[i])
        times = min(int(left[np.searchsorted(classes, c)]) // n for c, n in pattern.items())
        for c, n in pattern.items():
            left[np.searchsorted(classes, c)] -= n * times
        out.append((pattern, times))
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end of ranks, first sequence, copies per sequence)."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        for c, n in pattern.items():
            rows.append((c, used.get(c, 0), used.get(c, 0) + n * times, sequence, n))
            used[c] = rows[-1][2]
        sequence += times
    return rows


def placed(cut: DataFrame, size: int = SIZE, step: int = STEP) -> DataFrame:
    """The pieces with sequence_id and offset. ``cut`` is read several times: a written table, with a number of each row (_pk_place)."""
    spark = cut.sparkSession
    cut = cut.withColumn("_pk_class", F.ceil(F.col("length") / step).cast("int"))
    histogram = {r["_pk_class"]: r["count"] for r in cut.groupBy("_pk_class").count().collect()}
    table = slots(plan(histogram, size // step))
    ranges = F.create_map(*[F.lit(int(v)) for c, n in sorted(histogram.items()) for v in (c, np.ceil(np.sqrt(n)))]) \
        if histogram else F.create_map(F.lit(0), F.lit(1))
    cut = cut.withColumn("_pk_range", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "_pk_place"), ranges[F.col("_pk_class")]))
    before = Window.partitionBy("_pk_class").orderBy("_pk_range").rowsBetween(Window.unboundedPreceding, -1)
    base = (cut.groupBy("_pk_class", "_pk_range").count()
            .select("_pk_class", "_pk_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_pk_base")))
    inside = F.row_number().over(Window.partitionBy("_pk_class", "_pk_range").orderBy("doc_id", "start", "ids_crc32", "_pk_place"))
    ranked = cut.withColumn("_pk_in", inside).join(base, ["_pk_class", "_pk_range"])
    ranked = ranked.withColumn("_pk_rank", F.col("_pk_base") + F.col("_pk_in") - 1)
    slot = spark.createDataFrame(table or [(0, 0, 0, 0, 1)], "c int, lo long, hi long, first long, n long")
    out = ranked.join(F.broadcast(slot), (F.col("_pk_class") == F.col("c")) & (F.col("_pk_rank") >= F.col("lo"))
                      & (F.col("_pk_rank") < F.col("hi")))
    out = out.withColumn("sequence_id", F.expr("first + (_pk_rank - lo) div n"))
    out = out.withColumn("_pk_slot", F.expr("(_pk_rank - lo) % n"))
    upto = (Window.partitionBy("sequence_id").orderBy(F.desc("_pk_class"), "_pk_slot")
            .rowsBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("offset", F.coalesce(F.sum("length").over(upto), F.lit(0)))
    return out.drop("_pk_place", "_pk_class", "_pk_range", "_pk_in", "_pk_base", "_pk_rank", "_pk_slot", "c", "lo", "hi", "first", "n")


def packed(docs: DataFrame, size: int = SIZE, step: int = STEP, path: str | None = None, with_ids: bool = False) -> DataFrame:
    cut = pieces(docs.select("doc_id", "text"), size, path, with_ids)
    # the place tells repeated rows apart, so they are cut in ranges like any others; written once, it is the same in every later step
    return placed(saved(cut.withColumn("_pk_place", F.monotonically_increasing_id()), "pieces"), size, step)


def op8_pack(spark, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
