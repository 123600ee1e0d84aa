"""The prefix trie against a plain one, over rebuilt conversations and any other sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidewater.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + seq[h:]
    return out


def plain_trie(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, spared = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids.get(p)
            spared[p[:d]] += cost
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, ())), leaves[p], spared[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in members.items())


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in df.collect())


def random_rows(seed, convs=90):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(0, 400), convs):
        for t in range(draw.choice([1, 1, 2, 2, 3, 4, 6])):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "a", "a b", "", " c\td\n"])))
    draw.shuffle(rows)
    return rows


AWKWARD = [
    (None, 0, "user", "lost"), (None, None, None, None), (0, None, "user", "first of all"), (0, 0, None, None), (0, 1, "user", ""), (0, 1, "user", ""),
    (1, 5, "user", "x"), (2, 0, "user", "x"), (2, 0, "assistant", "x"), (2, None, "user", "y"), (3, 0, "a", "b\x00c"), (4, 0, "ab", "\x00c"),
    (5, 0, "user", "z" * 20000), (5, 1, "user", "w " * 9000), (25, 0, "user", "base is absent"), (40, 0, "user", "x"), (41, 0, "user", "x"),
    (42, 0, "user", "x"), (43, 0, "user", "x"), (-3, 0, "user", "negative"), (-20, 0, "user", "x"), (7000, 0, "user", "far"), (7001, 1, "user", "far"),
]


def test_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA).withColumn("depth", F.lit("x")).withColumn("key", F.lit(1)).withColumn("words", F.lit(0.5))
    assert result(pt.trie(*pt.rebuilt(df))) == plain_trie(plain_rebuilt(AWKWARD))


def test_random_conversations(spark):
    for seed in (1, 2):
        rows = random_rows(seed)
        seqs = plain_rebuilt(rows)
        assert any(not s for s in seqs.values())          # turnless ones are members of the root
        assert result(pt.trie(*pt.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == plain_trie(seqs)


def test_long_conversations_are_cut_in_chunks(spark):
    """Sums over chunks of three turns name the same prefixes as whole ones."""
    seqs = {c: [("u", str(i)) for i in range(17)] + [("u", f"x{c % 3}")] * (c % 3) for c in range(9)}
    rows = [(c, d + 1, digest(r, t), len(t.split())) for c, s in seqs.items() for d, (r, t) in enumerate(s)]
    turns = spark.createDataFrame(rows, "conv_id long, depth long, digest string, words long")
    out = pt.trie(turns.select("conv_id").distinct(), turns, chunk=3, hot=5)
    assert result(out) == plain_trie(seqs)


def test_end_lists_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(-60, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(pt.trie(*pt.rebuilt(df))) == plain_trie(plain_rebuilt(rows))


def test_empty_table(spark, tables):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.op12_prefix_trie(spark, tables(conversations=empty)).count() == 0
    assert pt.op12_prefix_trie(spark, tables(conversations=spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))).count() == 0
