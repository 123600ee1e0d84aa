"""Near-dedup: signatures estimate the weighted similarity; classes equal brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD
from tidewater.llm import near_dedup
from tidewater.llm.components import components


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(out)


def family(seed=3, size=160):
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        rows += [edited(base, rng.choice([0, 0, 1, 2, 3, 5, 8]), rng) for _ in range(12)]
    rows += [" ".join(["a", "b", "c"] * n) for n in (30, 31, 33, 60, 400)]
    rows += ["one two", "one two", "one two three"]
    return [(i, t) for i, t in enumerate(rows)]


def classes_by_brute_force(rows):
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and weighted_jaccard(bags[i], bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(i)
    return list(out.values())


def test_signature_agreement_is_the_weighted_similarity():
    rng = random.Random(1)
    base = [f"w{rng.randrange(300)}" for _ in range(300)]
    texts = [" ".join(base), edited(base, 4, rng), edited(base, 20, rng), " ".join(base * 3), "a b " * 40, "a b " * 29, ""]
    h, doc, _ = near_dedup.shingles(texts)
    distinct, weight, owner = near_dedup.weighted(h, doc)
    s = near_dedup.bag_minhash(distinct, weight, owner, len(texts), 3000)
    for i, j in ((0, 1), (0, 2), (0, 3), (4, 5)):
        want = weighted_jaccard(bag(texts[i]), bag(texts[j]))
        assert (s[i] == s[j]).mean() == pytest.approx(want, abs=0.04)
        assert near_dedup.similarity(near_dedup.packed_bag(h[doc == i]), near_dedup.packed_bag(h[doc == j])) == pytest.approx(want)
    assert np.isinf(s[6]).all() and not np.isinf(s[:6]).any()


def test_signatures_do_not_depend_on_the_block():
    texts = [t for _, t in family()]
    h, doc, _ = near_dedup.shingles(texts)
    whole = near_dedup.bag_minhash(*near_dedup.weighted(h, doc), len(texts), 64)
    for i in (0, 40, len(texts) - 1):
        h, doc, _ = near_dedup.shingles([texts[i]])
        assert (near_dedup.bag_minhash(*near_dedup.weighted(h, doc), 1, 64)[0] == whole[i]).all()


def test_classes_equal_brute_force(docs_of):
    rows = family()
    got = {r.doc_id: r for r in near_dedup.near_copy_report(docs_of(rows)).collect()}
    for group in classes_by_brute_force(rows):
        ids = [rows[i][0] for i in group]
        for d in ids:
            assert (got[d].class_id, got[d].class_size, got[d].kept) == (min(ids), len(ids), d == min(ids))


def shared_passages(seed=11, per=20):
    """Families of one size whose texts share most of a template: similarities on both sides of 0.8."""
    rng = random.Random(seed)
    rows = []
    for g in range(3):
        base = [f"t{g}_{i}" for i in range(150)]
        rows += [edited(base, rng.choice([1, 2, 4, 5, 6, 7, 9, 12]), rng) for _ in range(per)]
        rows += [" ".join(base[:75] + [f"o{g}_{k}_{i}" for i in range(75)]) for k in range(12)]
        rows += [" ".join(base[:n]) for n in (120, 122, 135, 140)]
    return [(i, t) for i, t in enumerate(rows)]


def test_crowded_buckets_equal_brute_force(docs_of, monkeypatch):
    """Few, loose bands: families with many texts outside of their hub's component go through all three stages."""
    rows, seen = shared_passages(), []
    plain = near_dedup._by_rare_elements
    monkeypatch.setattr(near_dedup, "_by_rare_elements", lambda *a: seen.append(1) or plain(*a))
    got = {r.doc_id: r for r in near_dedup.near_copy_report(docs_of(rows)).collect()}
    for group in classes_by_brute_force(rows):
        ids = [rows[i][0] for i in group]
        assert {(got[d].class_id, got[d].class_size) for d in ids} == {(min(ids), len(ids))}
    assert seen


def names_by_brute_force(rows):
    return {rows[i][0]: min(rows[j][0] for j in group) for group in classes_by_brute_force(rows) for i in group}


def test_crowded_buckets_with_sharper_bands_first(docs_of, monkeypatch):
    """However few the nodes are: the sharper bands give the classes that the exact join alone gives."""
    rows = [*family(seed=5), *[(1000 + d, t) for d, t in shared_passages(per=8)]]
    want, seen = names_by_brute_force(rows), []
    plain = near_dedup._sharp_udf
    monkeypatch.setattr(near_dedup, "FEW", 0)
    monkeypatch.setattr(near_dedup, "_sharp_udf", lambda *a: seen.append(1) or plain(*a))
    got = {r.doc_id: r.class_id for r in near_dedup.near_copy_report(docs_of(rows)).collect()}
    assert seen and got == want


def test_few_crowded_nodes_take_few_steps(docs_of, monkeypatch):
    """Each written step costs a small input about as much as a large one."""
    from tidewater.llm import components as comp

    written, plain = [], near_dedup.saved
    for module in (near_dedup, comp):
        monkeypatch.setattr(module, "saved", lambda df, name: written.append(name) or plain(df, name))
    rows = shared_passages(per=8)
    got = {r.doc_id: r.class_id for r in near_dedup.near_copy_report(docs_of(rows)).collect()}
    assert got == names_by_brute_force(rows)
    assert "prefixes" in written and len([n for n in written if not n.endswith("-star")]) <= 17


def test_prefix_join_finds_every_pair_of_different_sizes(spark):
    rng = random.Random(8)
    bags = [rng.sample(range(400), rng.randrange(20, 60)) for _ in range(30)]
    for k in range(60):
        own = list(bags[rng.randrange(30)])
        for _ in range(rng.randrange(0, 9)):
            own.pop()
        bags.append(own + [1000 + 50 * k + i for i in range(rng.randrange(0, 9))])
    pack = [near_dedup.packed_bag(near_dedup.mix64(np.asarray(b, np.uint64))) for b in bags]
    frame = spark.createDataFrame([(bytes([i]), len(b), p) for i, (b, p) in enumerate(zip(bags, pack))], "node binary, shingles long, bag binary")
    nodes = frame.select("node", "shingles", frame["node"].alias("root"), (frame["shingles"] > 0).alias("_out"))
    got = {(r.a[0], r.b[0]) for r in near_dedup._by_rare_elements(nodes, frame, 0.8).collect()}
    want = {(i, j) for j in range(len(bags)) for i in range(j) if near_dedup.similarity(pack[i], pack[j]) >= 0.8}
    assert len(want) > 20 and want <= got


def test_maps_and_clashing_names_are_carried(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(AWKWARD).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name in ("_nd_hash", "_nd_class", "_id", "row", "order", "node", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r["_nd_hash"] == "_nd_hash" and r["a.b"] == "a.b" and r["m"] == {"k": r["doc_id"]} for r in rows) and len(rows) == len(AWKWARD) - 4


def test_dropping_keeps_one_of_a_class_with_all_columns(docs_of):
    rows = family()
    docs = docs_of(rows)
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(min(rows[i][0] for i in g) for g in classes_by_brute_force(rows))


def test_awkward_rows(docs_of):
    rows = near_dedup.near_copy_report(docs_of(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    size = {r.doc_id: r.class_size for r in rows}
    assert size[1] == size[2] == size[3] == 1 and size[4] == size[5] == size[None] == 4 and size[6] == size[7] == 2
    kept = near_dedup.drop_near_copies(docs_of(AWKWARD)).collect()
    assert sorted(r.text or "" for r in kept) == sorted([t or "" for d, t, *_ in AWKWARD if d not in (5, None, 7)])
    empty = docs_of(AWKWARD).where("false")
    assert near_dedup.near_copy_report(empty).count() == 0 and near_dedup.drop_near_copies(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}}


def test_components_of_more_links(spark):
    """Links in three portions give the components of all of them, whatever their order."""
    rng = random.Random(4)
    for seed in range(3):
        links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for u, v in links:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
        want = {x: find(x) for x in parent if find(x) != x}
        frame = lambda part: spark.createDataFrame(part, "u long, v long")
        root = components(frame(links[:15]))
        root = components(frame(links[15:30]), root)
        root = components(frame(links[30:]), root)
        root = components(frame([(u, v) for u, v in links[:9]]), root)          # nothing new
        assert {r.node: r.root for r in root.collect()} == want and root.count() == len(want)
