"""Token-id files as directly addressable codes.

*Code.* An id is cut into chunks of ``CHUNK`` = 8 bits, lowest first. Level 0 has one chunk per id, level
k + 1 one chunk for every id that needs more than k + 1 chunks; a bitmap per level (but the last) says which ids go
on. The chunk of an id at the next level stands at the rank (number of set bits before) of its bit, and a rank
directory (set bits before every ``BLOCK`` = 512 bits) gives it with at most one block of bits counted. So any id, and any run
of ids, is read without decoding anything before it.

*Layout of a segment* (little-endian): ``DAC1``, levels (u32), ids (u64), documents (u64); per level the
number of chunks (u64), the chunks, and, but for the last level, its bitmap and its directory (u64 each); then per document its
doc_id (i64), a byte that is 1 when doc_id is null, and the start of its ids in the segment (u64, one more for the end).
Every part starts at a multiple of eight bytes.

*Files.* Documents are sorted by doc_id over all files (:func:`write_tokens`): a range partition of the documents is one file of segments,
a segment holds whole documents, about ``SEGMENT`` ids or one document. The container is Parquet with a row per segment (shard, segment, base:
ids before it in its shard, n_ids, n_docs, code), so files go to any file system that Spark writes to, with its commit and
recovery. The first position of a shard is a prefix sum over one row per file.

*Reading.* :func:`read_documents` gives the ids of every document or a digest of them, :func:`tokens_at` the ids at given positions of the corpus.

Defined cases: null and empty texts have the end id alone; null doc_ids come first; rows that share a doc_id are in the
order of their text's hash, equal rows in any order (they are alike); an empty table gives no segment and empty results;
other columns are not looked at. Texts are encoded whole; a repeated doc_id is cut among files by the hash of text and row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import BATCH, BATCH_ROWS, CLEAN, arrow_blocks, documents, hand_back, per_worker, saved, settings, starts_of, whole
from tidewater.llm.packing import TEXTS, block_encoder, ended, tokenizer_file
from tidewater.session import scratch_path

MAGIC, CHUNK, BLOCK = b"DAC1", 8, 512
#: ids of a segment (or one document)
SEGMENT = 1 << 18
#: id after each document
END_ID = 0

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def _padded(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


def encoded(ids: np.ndarray, doc_ids: list, lens: list[int]) -> bytes:
    """A segment of the documents ``doc_ids`` with ``lens`` ids each, one after the other in ``ids``."""
    rest, levels = np.ascontiguousarray(ids, np.uint32), []
    while True:
        more = rest >> np.uint32(CHUNK)
        on = more > 0
        last = not on.any()
        levels.append(((rest & np.uint32((1 << CHUNK) - 1)).astype(np.uint8), None if last else on))
        if last:
            break
        rest = more[on]
    out = [MAGIC, struct.pack("<IQQ", len(levels), len(ids), len(doc_ids))]
    for chunks, on in levels:
        out += [struct.pack("<Q", len(chunks)), _padded(chunks.tobytes())]
        if on is not None:
            bits = np.packbits(on, bitorder="little")
            out.append(_padded(bits.tobytes()))
            blocks = np.add.reduceat(_ONES[bits].astype(np.int64), np.arange(0, len(bits), BLOCK // 8))
            out.append(starts_of(blocks)[:-1].astype("<u8").tobytes())
    out.append(np.asarray([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.append(_padded(np.asarray([d is None for d in doc_ids], np.uint8).tobytes()))
    out.append(starts_of(np.asarray(lens, np.int64)).astype("<u8").tobytes())
    return b"".join(out)


class Segment:
    """Read access to an encoded segment; nothing is decoded until it is asked for."""

    def __init__(self, code: bytes):
        if code[:4] != MAGIC:
            raise ValueError("not a token segment")
        n_levels, self.n_ids, self.n_docs = struct.unpack_from("<IQQ", code, 4)
        self.at, self.code, self.levels = 24, code, []
        for k in range(n_levels):
            n = int(self._part("<u8", 1)[0])
            chunks = self._part(np.uint8, n)
            if k + 1 < n_levels:
                self.levels.append((chunks, self._part(np.uint8, -(-n // 8)), self._part("<u8", -(-n // BLOCK))))
            else:
                self.levels.append((chunks, None, None))
        self.doc_id, self.doc_null = self._part("<i8", self.n_docs), self._part(np.uint8, self.n_docs)
        self.doc_start = self._part("<u8", self.n_docs + 1)

    def _part(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self.code, kind, n, self.at)
        self.at += out.nbytes + -out.nbytes % 8
        return out

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Set bits before bit i: the directory's count, and the bits of one block up to i."""
        if not len(directory):
            return 0
        block = min(i // BLOCK, len(directory) - 1)
        byte = i >> 3
        n = int(directory[block]) + int(_ONES[bits[block * BLOCK >> 3:byte]].sum())
        return n + int(_ONES[bits[byte] & ((1 << (i & 7)) - 1)]) if i & 7 else n

    def token(self, i: int) -> int:
        """The id at position i of the segment: one chunk and one rank per level that it has."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK * k)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bits, directory, i)
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions lo to hi (exclusive): a run of every level, found by two ranks."""
        out = where = None
        for k, (chunks, bits, directory) in enumerate(self.levels):
            part = chunks[lo:hi].astype(np.uint32) << np.uint32(CHUNK * k)
            if out is None:
                out = part
            else:
                out[where] |= part
            if bits is None or hi == lo:
                break
            on = np.flatnonzero(np.unpackbits(bits[lo >> 3:-(-hi // 8)], bitorder="little")[lo & 7:(lo & 7) + hi - lo])
            where, lo = on if where is None else where[on], self._rank(bits, directory, lo)
            hi = lo + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.doc_start[k]), int(self.doc_start[k + 1]))


SEGMENTS = "shard int, segment int, base long, n_ids long, n_docs long, code binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, segment: int = SEGMENT) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write segments below ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_file()
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("base", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int64()),
                        ("code", pa.binary())])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = per_worker(("block encoder", tokenizer), lambda: block_encoder(tokenizer))
        shard, number, base = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, held = [], [], 0

        def row():
            flat = np.concatenate(ids)
            code = encoded(flat, doc_ids, [len(x) for x in ids])
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (shard, number, base, len(flat), len(doc_ids), code), schema)], schema=schema)

        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            for texts in arrow_blocks(batch.column(1), TEXTS):
                flat, at = ended(*encode(texts), end_id)
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    if held and held + b - a > segment:
                        yield row()
                        number, base, held = number + 1, base + held, 0
                        ids, doc_ids = [], []
                    ids.append(flat[a:b])
                    doc_ids.append(next(names))
                    held += b - a
        if held:
            yield row()
        hand_back()

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = docs.select(F.col("doc_id").cast("long"), whole("text").alias("text"))
    # equal rows are alike, so any of them may come first: the row's place splits even one that makes up a third of the table
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(shards, "doc_id", "_hash", "_place").sortWithinPartitions("doc_id", "_hash", "_place")
    with settings(spark, **{CLEAN: "true", BATCH: BATCH_ROWS}):
        rows.select("doc_id", "text").mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_segments(spark: SparkSession, path: str, columns=("shard", "segment", "base", "n_ids", "n_docs", "code")) -> DataFrame:
    """The segments with ``start``, the position of their first id in the corpus. The shards' totals are one row per file."""
    rows = spark.read.schema(SEGMENTS).parquet(path)
    total = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = total.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    # one row per file, at most as many as the shuffle partitions of the writer: a broadcast, so the codes are not shuffled
    return rows.select(*dict.fromkeys(["shard", *columns, "base"])).join(F.broadcast(first), "shard").withColumn("start", F.col("_first") + F.col("base")).drop("_first")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, the
    ids (little-endian, 32 bits each)."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, code in zip(batch.column(0), batch.column(1)):       # one segment at a time
                s = Segment(code.as_py())
                at, raw, crc = s.doc_start.astype(np.int64), [], []
                every = memoryview(s.tokens(0, s.n_ids).astype("<u4", copy=False)).cast("B")    # levels are put together once, not for every document
                for a, b in zip((4 * at[:-1]).tolist(), (4 * at[1:]).tolist()):
                    crc.append(zlib.crc32(every[a:b]))
                    raw += [bytes(every[a:b])] * with_ids
                out = [pa.array(s.doc_id, pa.int64(), mask=s.doc_null.astype(bool)), pa.array(at[:-1] + start.as_py()),
                       pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(raw, pa.binary())] * with_ids, schema=pa.schema(fields))

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return read_segments(spark, path, ("code",)).select("start", "code").mapInArrow(read, schema)


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame, span: int = SEGMENT) -> DataFrame:
    """(position, token) for every row of ``wanted`` (column position); positions outside of the corpus and null ones have a null
    token. Positions and segments meet in stretches of ``span`` positions (an equi-join; a segment stands in every
    stretch that it touches), then every position is one random access."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, code, wants in zip(batch.column(0), batch.column(1), batch.column(2)):
                s, first, wants = Segment(code.as_py()), start.as_py(), wants.as_py()
                yield pa.RecordBatch.from_arrays([pa.array(wants, pa.int64()), pa.array([s.token(p - first) for p in wants], pa.int64())],
                                                 names=["position", "token"])

    head = read_segments(spark, path, ("segment", "n_ids")).select("shard", "segment", "start", "n_ids").where("n_ids > 0")
    head = head.withColumn("_stretch", F.explode(F.sequence(F.expr(f"start div {span}"), F.expr(f"(start + n_ids - 1) div {span}"))))
    want = wanted.select(F.col("position").cast("long").alias("position"))
    named = want.distinct().where("position >= 0").withColumn("_stretch", F.expr(f"position div {span}")).join(head, "_stretch")
    named = named.where("position >= start and position < start + n_ids")
    per = named.groupBy("shard", "segment").agg(F.collect_list("position").alias("wants"))      # at most the ids of a segment
    codes = read_segments(spark, path, ("segment", "code")).select("shard", "segment", "start", "code")
    got = codes.join(per, ["shard", "segment"]).select("start", "code", "wants").mapInArrow(pick, "position long, token long")
    got = saved(got, "picked").withColumnRenamed("position", "_p")
    return want.join(got, F.col("position") == F.col("_p"), "left").select("position", F.col("token").cast("int").alias("token"))


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-tokens")
    write_tokens(documents(spark, sf_dir), path)
    return read_documents(spark, path)
