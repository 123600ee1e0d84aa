"""Quality rules by distribution divergence.

Per language, all documents give two references: a histogram of character classes and one of
the ``COMMON`` commonest words (the other words are one class). A document is compared with every
reference by Jensen-Shannon distance (base 2, 0 to 1) and is held against the nearest one, so
its own ``lang`` is not looked at. It is rejected when its nearest distance of either kind is over
the limit for its length; documents under ``MIN_WORDS`` words or ``MIN_CHARS`` characters are too short
for a histogram and are not judged by it. The base rules of the contract come first.

Null texts are empty; rows with a null ``lang`` do not teach a reference but are judged; empty
tables give empty results; without any reference only the base rules hold; other columns are
not looked at. Texts are worked on whole, in blocks of at most ``BLOCK`` bytes (or one text).

Word counts for the references are combined within a task (flushed at ``FLUSH_WORDS`` counts) before
they are shuffled, then by a partial + final sum; the references (languages x ``COMMON`` numbers) go to the tasks in the closure.
Words are found and numbered in Arrow arrays; none becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import (BATCH, BATCH_ROWS, CLEAN, arrow_blocks, arrow_words, documents, flat_bytes, hand_back, lower, mix64,
                                  settings, starts_of)

BLOCK = 2 << 20
COMMON = 64
#: bytes of text that a task gathers before it counts their words by language, and counts it holds before it hands them on
HELD, FLUSH_WORDS = 16 << 20, 500_000
MIN_WORDS, MIN_CHARS = 50, 200
#: limits: a + b / sqrt(words), for character classes and for common words
CHAR_LIMIT = (0.16, 1.2)
WORD_LIMIT = (0.24, 1.8)

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

#: character classes over the bytes of UTF-8 text; a continuation byte counts nowhere
CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "symbol", "other", "beyond")


def _class_matrix() -> np.ndarray:
    m = np.zeros((256, len(CLASSES)))
    for b in range(256):
        c = chr(b)
        k = ("beyond" if b >= 0xC0 else None if b >= 0x80 else "lower" if c.islower() else "upper" if c.isupper()
             else "digit" if c.isdigit() else "newline" if c == "\n" else "blank" if c in WHITE
             else "stop" if c in ".,;:'\"()-?" else "symbol" if c in SYMBOLS + "!" else "other")
        if k:
            m[b, CLASSES.index(k)] = 1
    return m


def blocks(texts, limit: int = BLOCK) -> Iterator[list[str]]:
    """The texts in order, in lists of at most ``limit`` characters (or one text)."""
    part, n = [], 0
    for t in texts:
        t = "" if t is None else t
        if part and n + len(t) > limit:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def byte_histograms(texts: list[str]) -> np.ndarray:
    return np.stack([np.bincount(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) for t in texts])


def repeated_words(flat: np.ndarray, lens: np.ndarray, vocabulary: int) -> np.ndarray:
    """Per text: words that lie in a 3-word window found twice or more in that text."""
    starts = starts_of(lens)
    doc = np.repeat(np.arange(len(lens)), lens)
    if len(flat) < 3:
        return np.zeros(len(lens), np.int64)
    a, b, c = (flat[i:len(flat) - 2 + i].astype(np.int64) for i in range(3))
    if vocabulary < 1 << 21:
        key = (a << 42) | (b << 21) | c
    else:
        key = np.unique(a * vocabulary + b, return_inverse=True)[1] * vocabulary + c
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    key, at = key[inside], doc[inside]
    # a window whose hash, taken with its text, occurs once is there once: only the others are sorted and compared exactly
    h = mix64(key.view(np.uint64) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(h)
    seen = np.zeros(1 << 20, bool)
    seen[ordered[1:][ordered[1:] == ordered[:-1]] >> np.uint64(44)] = True
    some = np.flatnonzero(seen[h >> np.uint64(44)])
    inside, key, at = inside[some], key[some], at[some]
    order = np.argsort(key, kind="stable")          # equal windows stay in text order
    same = (key[order][1:] == key[order][:-1]) & (at[order][1:] == at[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(flat), bool)
    where = inside[order[twice]]
    for i in range(3):
        hit[where + i] = True
    total = starts_of(hit.astype(np.int64))
    return total[starts[1:]] - total[starts[:-1]]


def histograms(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text: how often each byte occurs, of texts as ``flat_bytes`` gives them."""
    return np.stack([np.zeros(256, np.int64), *(np.bincount(data[a:b], minlength=256) for a, b in zip(at[:-1], at[1:]))])[1:]


def base_counts(data: np.ndarray, starts: np.ndarray, hist: np.ndarray, flat, lens, vocabulary) -> pd.DataFrame:
    white = hist[:, [ord(c) for c in WHITE]].sum(1)
    chars = hist.sum(1) - hist[:, 0x80:0xC0].sum(1)
    dup, blank = [], WHITE.encode()
    for a, b in zip(starts[:-1], starts[1:]):
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip(blank)]
        dup.append(len(lines) - len(set(lines)))
    return pd.DataFrame({"n_words": lens, "word_chars": chars - white, "n_symbols": hist[:, [ord(c) for c in SYMBOLS]].sum(1),
                         "n_dup_lines": np.asarray(dup, np.int64), "n_repeat_words": repeated_words(flat, lens, vocabulary)})


def references(docs: DataFrame, common: int = COMMON) -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """By language: (class distribution, position of each common word, distribution of those and the rest)."""
    def count(batches):
        classes = _class_matrix()
        texts, size, tally = [], 0, []
        others: dict[str, np.ndarray] = {}          # characters by class, words

        def counted(rows: pa.Table) -> Iterator[pa.Table]:
            """The words of the rows with their numbers, a table for a language and block."""
            code = rows["lang"].combine_chunks().dictionary_encode()
            at, langs, text = code.indices.to_numpy(), code.dictionary.to_pylist(), rows["text"].combine_chunks()
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(len(langs) + 1))
            for lang, a, b in zip(langs, ends[:-1], ends[1:]):
                for part in arrow_blocks(text.take(pa.array(order[a:b])), BLOCK):
                    data, starts = flat_bytes(part)
                    words = lower(arrow_words(data, starts)[0])
                    found = words.value_counts()
                    chars = (np.bincount(data, minlength=256) @ classes).astype(np.int64)
                    others[lang] = others.get(lang, 0) + np.append(chars, len(words))
                    yield pa.table({"lang": pa.repeat(lang, len(found)), "name": found.field("values"), "n": found.field("counts")})

        def combined() -> pa.Table:
            own = pa.concat_tables(tally).group_by(["lang", "name"], use_threads=False).aggregate([("n", "sum")])
            return own.select(["lang", "name", "n_sum"]).rename_columns(["lang", "name", "n"])

        def rows(own: pa.Table) -> list[pa.RecordBatch]:
            kind = pa.array(["w"]).take(pa.array(np.zeros(len(own), np.int32)))
            own = pa.table([own["lang"], kind, own["name"].cast(pa.binary()), own["n"]], names=["lang", "kind", "name", "n"])
            return own.combine_chunks().to_batches()

        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("lang")))
            if texts and size + batch.nbytes > HELD:
                tally += counted(pa.Table.from_batches(texts))
                texts, size = [], 0
            texts.append(batch)
            size += batch.nbytes
            if sum(map(len, tally)) > 2 * FLUSH_WORDS:
                tally = [combined()]
                if len(tally[0]) > FLUSH_WORDS:
                    yield from rows(tally.pop())
        if texts:
            tally += counted(pa.Table.from_batches(texts))
        if tally:
            yield from rows(combined())
        names = [x.encode() for x in CLASSES] + [b""]
        for lang, n in others.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(["c"] * len(CLASSES) + ["all"]),
                                              pa.array(names, pa.binary()), pa.array(n, pa.int64())], ["lang", "kind", "name", "n"])
        hand_back()

    counts = (docs.select("lang", "text").mapInArrow(count, "lang string, kind string, name binary, n long")
              .groupBy("lang", "kind", "name").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))
    with settings(docs.sparkSession, **{CLEAN: "true", BATCH: BATCH_ROWS}):
        top = counts.withColumn("r", rank).where(F.col("r") <= common).collect()
    out = {}
    for lang, words in ((r["lang"], r["n"]) for r in top if r["kind"] == "all"):
        rows = [r for r in top if r["lang"] == lang]
        chars = np.zeros(len(CLASSES))
        for r in rows:
            if r["kind"] == "c":
                chars[CLASSES.index(bytes(r["name"]).decode())] = r["n"]
        names = sorted(((-r["n"], bytes(r["name"])) for r in rows if r["kind"] == "w"))
        share = np.asarray([-n for n, _ in names] + [words + sum(n for n, _ in names)], float)
        if words:
            out[lang] = (chars / chars.sum(), {w: i for i, (_, w) in enumerate(names)}, share / share.sum())
    return out


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distances (square roots of the divergence, base 2) of the rows of p to q."""
    m = (p + q) / 2

    def kl(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(1)

    return np.sqrt(np.clip((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0, 1))


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "char_distance double, word_distance double, kept boolean")


def judge(texts, refs: dict) -> pd.DataFrame:
    data, starts = flat_bytes(texts)
    hist = histograms(data, starts)
    words, lens = arrow_words(data, starts)
    coded = words.dictionary_encode()
    flat, words = coded.indices.to_numpy(), coded.dictionary
    out = base_counts(data, starts, hist, flat, lens, len(words))
    out["base_failed"] = (out.n_words < 50) | (100 * out.n_repeat_words > 50 * out.n_words)
    classes = hist @ _class_matrix()
    chars = classes / np.maximum(classes.sum(1, keepdims=True), 1)
    near_c, near_w = np.ones(len(lens)), np.ones(len(lens))
    # the words that are common in any language, found once for all of them
    union = {w: i for i, w in enumerate(dict.fromkeys(w for _, index, _ in refs.values() for w in index))}
    at = pc.index_in(lower(words), pa.array(list(union), pa.large_binary())).fill_null(-1).to_numpy()[flat]
    hit = np.flatnonzero(at >= 0)
    at, doc = at[hit], np.repeat(np.arange(len(lens)), lens)[hit]
    for ref_c, index, ref_w in refs.values():
        near_c = np.minimum(near_c, jensen_shannon(chars, ref_c))
        k = len(ref_w)
        own = np.full(len(union), k - 1)
        own[[union[w] for w in index]] = list(index.values())
        n = np.bincount(doc * k + own[at], minlength=len(lens) * k).reshape(len(lens), k)
        n[:, k - 1] = lens - n[:, :k - 1].sum(1)
        near_w = np.minimum(near_w, jensen_shannon(n / np.maximum(lens, 1)[:, None], ref_w))
    root = np.sqrt(np.maximum(lens, 1))
    judged = (lens >= MIN_WORDS) & (classes.sum(1) >= MIN_CHARS) & bool(refs)
    far = (near_c > CHAR_LIMIT[0] + CHAR_LIMIT[1] / root) | (near_w > WORD_LIMIT[0] + WORD_LIMIT[1] / root)
    out["char_distance"], out["word_distance"] = near_c, near_w
    out["kept"] = ~(out.base_failed | (judged & far))
    return out


def with_rules(docs: DataFrame, refs: dict, text: str = "text", name: str = "rules") -> DataFrame:
    """``docs`` with a struct column of the counts, the distances and the verdict."""
    def judged(texts) -> pa.StructArray:
        out = judge(texts, refs)
        return pa.StructArray.from_arrays([pa.array(out[c].to_numpy()) for c in out], names=list(out))

    @F.arrow_udf(RESULT)
    def rules(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in parts:
            yield pa.concat_arrays([judged(b) for b in arrow_blocks(s, BLOCK)] or [judged([])])
        hand_back()

    return docs.withColumn(name, rules(F.col(text)))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = with_rules(docs.select("doc_id", "text"), references(docs))
    return out.select("doc_id", "rules.*")
