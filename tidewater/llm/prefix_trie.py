"""The trie of conversation prefixes by whole-sequence collapse.

*Rebuilding.* The turns of a conversation stand in the order of turn (null first). Conversation c starts with the first h
turns of conversation c - c % ``GROUP`` (all if it has fewer, none if it is absent), h = crc32 of c in decimal, modulo ``HEADS``; its
own turns after its first h follow. This is the query's part (:func:`rebuilt`); the trie takes any sequences.

*Names of prefixes.* A turn is the SHA-256 of its depth, role and text, cut into four 32-bit numbers; a prefix is its depth
and the four sums over its turns. Sums can be made of parts, so a conversation with very many turns is cut in chunks like any
other running sum (``operators.running``), and no text is moved.

*Collapse.* Conversations with the same whole-sequence sums are one weighted sequence (weight, smallest conv_id, list of its
conversations' ids), before any prefix is formed. Sequences that are a proper prefix of another one are dropped by an
anti-join; the rest are the leaves. The weighted prefixes of the sequences are then aggregated to nodes.

*Subtree sums.* A node belongs to the leaf of smallest conv_id below it; the nodes of a leaf are the lower end of its path.
What a subtree saves is the sum, over the leaves below its top, of the leaf's own nodes from that depth on: a running sum from the end of
every leaf's path, added up per prefix. Everything is linear in the turns of distinct sequences.

The digest of a node's ends needs their ids in one text: they are joined in pieces of at most ``PIECE`` ids by all tasks; the pieces of one
node then meet in one row, as the contract's SHA-256 forces it.

Defined cases: null roles and texts are empty; rows with a null conv_id belong to no conversation; rows that share conv_id and
turn are in the order of the SHA-256 of role and text, each one a turn of its own; an empty table gives no row; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, saved
from tidewater.operators.running import DEFAULT_HOT_THRESHOLD, RunningSpec, row_chunk, running_aggregate

#: Fixed values of the contract.
GROUP, HEADS = 20, 4
#: conv_ids of a piece of an end list
PIECE = 4096
#: turns of a chunk of a conversation with more than ``HOT`` rows
CHUNK, HOT = 1 << 16, DEFAULT_HOT_THRESHOLD
LANES = [f"s{i}" for i in range(4)]


def _head(c: Column) -> Column:
    return (F.crc32(c.cast("string")) % HEADS).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, digest, words): the turns of every conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    ordered = running_aggregate(rows, keys=["conv_id"], order=[F.col("turn").asc_nulls_first(), "digest"],
                                chunk=F.coalesce(row_chunk("turn", CHUNK), F.lit(-(1 << 62))),
                                specs=[RunningSpec("rank", "count")], hot_threshold=HOT)
    return ordered.select("conv_id", "rank", "digest", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id) of every conversation, (conv_id, depth, digest, words) of its rebuilt turns)."""
    own = saved(turns(conversations), "turns")
    sizes = own.groupBy("conv_id").agg(F.least(F.count(F.lit(1)), F.lit(HEADS - 1)).alias("n"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), _head(F.col("conv_id")).alias("h"))
    base_size = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = saved(convs.join(base_size, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")),
                  "conversations")
    first = own.where((F.col("conv_id") % GROUP == 0) & (F.col("rank") < HEADS)).withColumnRenamed("conv_id", "base")
    head = convs.where("h > 0").join(first, "base").where("rank <= h").select("conv_id", F.col("rank").alias("depth"), "digest", "words")
    tail = own.where(F.col("rank") > _head(F.col("conv_id"))).join(convs.select(F.col("conv_id").alias("_c"), "h", "taken"), F.col("conv_id") == F.col("_c"))
    tail = tail.select("conv_id", (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"), "digest", "words")
    return convs.select("conv_id"), head.unionAll(tail)


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), *[x.cast("string") for x in lanes])))


def _with_lanes(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, depth, digest, words) with the four numbers of the turn."""
    named = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    rows = rows.withColumn("_h", named)
    return rows.select("conv_id", "depth", "words", *[
        F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long").alias(s) for i, s in enumerate(LANES)])


def _end_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256); members: (key, conv_id), each conversation once."""
    pieces = members.groupBy("key", F.expr(f"conv_id div {PIECE}").alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    # div rounds towards zero, so the ids on either side of it share a piece; the order of pieces is that of their ids all the same
    lists = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["ids"]), ",")
    return lists.select("key", F.sha2(text, 256).alias("ends_sha256"))


def trie(convs: DataFrame, rows: DataFrame, chunk: int = CHUNK, hot: int | None = HOT) -> DataFrame:
    """One row per distinct prefix of the sequences; convs: (conv_id), rows: (conv_id, depth from 1, digest, words)."""
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("words"), *[zero.alias(s) for s in LANES])
    rows = saved(_with_lanes(rows).unionAll(root), "sequence-turns")

    # whole sequences: identical ones become one, with a weight and a list of ends
    whole = rows.groupBy("conv_id").agg(F.max("depth").alias("len"), *[F.sum(s).alias(s) for s in LANES])
    members = saved(whole.select("conv_id", "len", _key(F.col("len"), [F.col(s) for s in LANES]).alias("key")), "members")
    sequences = saved(members.groupBy("key").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.max("len").alias("len")), "sequences")
    ends = saved(_end_digests(members.select("key", "conv_id")), "ends")

    # their weighted prefixes
    kept = rows.join(sequences.select(F.col("rep").alias("_rep"), "weight", "len"), F.col("conv_id") == F.col("_rep")).drop("_rep")
    sums = running_aggregate(kept, keys=["conv_id"], order=["depth"], chunk=row_chunk("depth", chunk),
                             specs=[RunningSpec(f"r{s}", "sum", s) for s in LANES], hot_threshold=hot)
    prefixes = saved(sums.select(
        "conv_id", "depth", "words", "weight", "len", _key(F.col("depth"), [F.col(f"r{s}") for s in LANES]).alias("key"),
        F.when(F.col("depth") > 0, _key(F.col("depth") - 1, [F.col(f"r{s}") - F.col(s) for s in LANES])).alias("parent")), "prefixes")

    # leaves: no other sequence goes on from them
    proper = prefixes.where("depth < len").select("key").distinct()
    leaves = saved(sequences.join(proper, "key", "left_anti").select(F.col("rep").alias("leaf")), "leaves")
    on_path = prefixes.join(leaves, F.col("conv_id") == F.col("leaf"), "left")
    nodes = saved(on_path.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"), F.sum("weight").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.count("leaf").alias("n_leaves"), F.min("leaf").alias("owner")), "nodes")

    # what subtrees save: every leaf's own nodes, summed from the end of its path
    own = nodes.select(F.col("owner").alias("_o"), F.col("depth").alias("_d"), ((F.col("n_convs") - 1) * F.col("words")).alias("cost"))
    path = prefixes.join(leaves, F.col("conv_id") == F.col("leaf"), "left_semi").select("conv_id", "depth", "key")
    path = path.join(own, (F.col("conv_id") == F.col("_o")) & (F.col("depth") == F.col("_d")), "left")
    path = path.select("conv_id", "depth", "key", F.coalesce("cost", zero).alias("cost"))
    below = running_aggregate(path, keys=["conv_id"], order=[F.col("depth").desc()], chunk=-row_chunk("depth", chunk),
                              specs=[RunningSpec("saved", "sum", "cost")], hot_threshold=hot)
    spared = saved(below.groupBy("key").agg(F.sum("saved").alias("saved_tokens")), "saved-tokens")

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("_p")).agg(F.count(F.lit(1)).alias("n_children"))
    out = nodes.join(spared, "key").join(ends, "key", "left").join(children, F.col("key") == F.col("_p"), "left")
    out = saved(out.select("key", "parent", "conv_id", "depth", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                           F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "trie")
    above = out.select(F.col("key").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    return out.join(above, F.col("parent") == F.col("_p"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie(*rebuilt(table))


#: crc32 is no function of that SQL: its table follows from the polynomial
SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(0, 256) AS g(i)),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, [unicode(x)::BIGINT for x in string_split(c::VARCHAR, '')]),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own), crc_table),
parts AS (
  SELECT convs.c, 0 AS side, r, role, text FROM convs JOIN own ON own.c = base WHERE r <= h
  UNION ALL SELECT convs.c, 1, r, role, text FROM convs JOIN own USING (c) WHERE r > h),
seqs AS (
  SELECT c, coalesce(list({'role': role, 'text': text} ORDER BY side, r) FILTER (r IS NOT NULL), []) AS s
  FROM convs LEFT JOIN parts USING (c) GROUP BY c),
prefixes AS (SELECT c, d, s[1:d] AS p, len(s) AS n FROM seqs, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS cost
  FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
subtree AS (
  SELECT v.p[1:a.d] AS p, sum(v.cost) AS saved, count(*) FILTER (NOT EXISTS (SELECT 1 FROM children WHERE children.p = v.p)) AS leaves
  FROM nodes v, LATERAL (SELECT unnest(range(0, v.d + 1)) AS d) a GROUP BY 1)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, subtree.leaves AS n_leaves,
  subtree.saved::BIGINT AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
FROM nodes JOIN subtree USING (p) LEFT JOIN children USING (p) LEFT JOIN nodes up ON up.p = nodes.p[1:nodes.d - 1] AND nodes.d > 0
"""
