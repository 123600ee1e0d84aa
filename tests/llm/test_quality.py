"""Quality model and quality rules: features and counts by brute force, held-out accuracy, awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.conftest import AWKWARD
from tidewater.llm import quality_model, quality_rules
from tidewater.llm.common import arrow_blocks, arrow_words, encode, flat_bytes, lower


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {j for v in where.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_base_counts_and_verdicts(spark):
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = quality_rules.op10_quality_rules(spark, d).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = brute_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    clean = [r for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    poor = [r for r in rows if label.get(r.doc_id) == 0]
    assert all(r.kept for r in clean) and sum(r.kept for r in poor) <= 0.1 * len(poor)


def test_divergence_is_zero_for_equal_and_one_for_disjoint():
    p = np.array([[0.5, 0.5, 0, 0], [0, 0, 1, 0]])
    assert np.allclose(quality_rules.jensen_shannon(p, np.array([0.5, 0.5, 0, 0])), [0, 1])


def test_many_distinct_words_use_the_other_key():
    flat = np.array([5, 6, 7, 1, 5, 6, 7], np.int32)
    for size in (8, 1 << 22):
        assert quality_rules.repeated_words(flat, np.array([7]), size).tolist() == [6]
        assert quality_rules.repeated_words(flat, np.array([3, 0, 4]), size).tolist() == [0, 0, 0]


def test_rules_on_awkward_rows(spark, docs_of, tables):
    got = {r.doc_id: r for r in quality_rules.op10_quality_rules(spark, tables(documents=docs_of(AWKWARD))).collect()}
    for d, t, *_ in AWKWARD:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(t or "")
    assert quality_rules.op10_quality_rules(spark, tables(documents=docs_of(AWKWARD).where("false"))).count() == 0


def test_trees_follow_their_arrays():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 1] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality_model.fit(x, y, trees=40, depth=3)
    score = trees.score(x)
    for i in range(0, 2000, 400):
        total = trees.bias
        for f, limit, leaf in zip(trees.feature, trees.limit, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(x[i, f[node]] > limit[node])
            total += leaf[node - len(f)]
        assert abs(score[i] - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((score > 0.5) == y).mean() > 0.97


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = quality_model.op6_quality_model(spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.97 * len(held)


def test_classifier_on_awkward_rows(spark, docs_of, tables):
    labels = "doc_id long, quality int, toxic int, score string"
    some = spark.createDataFrame([(4, 1, 0, "x"), (8, 0, 0, "x"), (8, 1, 0, "x"), (None, 1, 0, "x"), (9, None, 0, "x")], labels)
    for lab in (some, some.where("false")):
        rows = quality_model.op6_quality_model(spark, tables(documents=docs_of(AWKWARD), labels=lab)).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 1 for r in rows)
    assert quality_model.op6_quality_model(spark, tables(documents=docs_of(AWKWARD).where("false"), labels=some)).count() == 0


def test_words_in_arrow_are_those_of_the_plain_split():
    texts = [None, "", "  \n", " lead", "trail ", "ab", "cd e", "\x0bé x y\x0c A a", "a b c a b c", "x\ny\nx\n \nX"]
    plain, lens, words = encode([t or "" for t in texts])
    for kind in (pa.string(), pa.large_string()):
        whole = pa.array(["cut off", *texts, "and this"], kind)
        data, at = flat_bytes(whole.slice(1, len(texts)))
        got, own = arrow_words(data, at)
        assert got.to_pylist() == [words[i] for i in plain] and own.tolist() == lens.tolist()
        assert lower(got).to_pylist() == [words[i].lower() for i in plain]
        assert [t for b in arrow_blocks(whole, 8) for t in b.to_pylist()] == whole.to_pylist()
        out = quality_rules.judge(whole.slice(1, len(texts)), {})
        rows = out[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].itertuples(index=False)
        assert [tuple(r) for r in rows] == [brute_counts(t or "") for t in texts]


def test_references_over_many_flushes(spark, docs_of, monkeypatch):
    monkeypatch.setattr(quality_rules, "HELD", 200)
    monkeypatch.setattr(quality_rules, "FLUSH_WORDS", 7)
    monkeypatch.setattr(quality_rules, "BLOCK", 64)
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{'W' if i % 3 else 'w'}{int(x)}é." for x in rng.zipf(1.5, 40) % 90), ["en", "de", None][i % 3]) for i in range(60)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, " \n", "fr")]
    got = quality_rules.references(docs_of(rows).repartition(3), common=20)
    assert set(got) == {"en", "de"}
    for lang, (chars, index, share) in got.items():
        text = " ".join(t for _, t, own in rows if own == lang and t)
        n = Counter(text.lower().encode().split())
        best = sorted(n.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert list(index) == [w for w, _ in best] and list(index.values()) == list(range(len(best)))
        want = [x for _, x in best] + [n.total() - sum(x for _, x in best)]
        assert np.allclose(share, np.asarray(want) / n.total())
        assert np.isclose(chars[quality_rules.CLASSES.index("beyond")], n.total() / (sum(len(t.replace(" ", "")) for _, t, own in rows if own == lang and t)
                                                                                      + sum((t or "").count(" ") for _, t, own in rows if own == lang)))
