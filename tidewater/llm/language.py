"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes of UTF-8. Two gated recurrent layers of ``HIDDEN`` units read
each window forwards and backwards, a softmax labels every position, and a document's probabilities
are the mean over all its positions. Trained here in numpy: back-propagation through time over whole
windows, Adam, gates with a clipped linear activation. Byte 0 leaves a state as it is, so padding is
neutral.

Training uses a bounded sample: about ``PER_LANG`` documents per language (those whose hash is below
the language's share), ``CUTS`` cuts of ``WINDOW`` characters from each at hashed places. Prediction reads
every byte of every text and is a map without a shuffle; inputs are bytes only.

A null text and one without a letter are ``und`` with score 0. Rows with a null lang do not teach; with no
learned language everything is ``und``. A null doc_id counts as the empty text in crc32. Empty tables
give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import crc_mod, documents, starts_of
from tidewater.llm.quality_rules import blocks

WINDOW, HIDDEN, BATCH = 128, 8, 2048
PER_LANG, CUTS, STEPS, TRAIN_WINDOW, TRAIN_BATCH = 400, 3, 300, 48, 96
UNDETERMINED = "und"


def windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows of bytes padded with 0, windows per text); an empty text has one empty window."""
    n = np.asarray([max(1, -(-len(t) // size)) for t in texts], np.int64)
    flat = b"".join(t.ljust(int(k) * size, b"\0") for t, k in zip(texts, n))
    return np.frombuffer(flat, np.uint8).reshape(-1, size), n


def init(hidden: int, classes: int, rng) -> dict[str, np.ndarray]:
    p = {}
    for d in "fb":
        for gate in "zrc":
            p[f"E{gate}{d}"] = rng.normal(0, 0.3, (256, hidden)) + (0.0 if gate == "c" else 0.5)
            p[f"U{gate}{d}"] = rng.normal(0, 0.3, (hidden, hidden))
        p[f"W{d}"] = rng.normal(0, 0.3, (hidden, classes))
    p["bias"] = np.zeros(classes)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    return still(p)


def still(p):
    for d in "fb":
        p[f"Ez{d}"][0] = -1e4       # byte 0 opens no gate: the state stays
    return p


def run_direction(p, d: str, x: np.ndarray, keep: bool = False):
    """States (positions x windows x hidden) of one direction; x: positions x windows of bytes."""
    length, n = x.shape
    hidden = p[f"Uz{d}"].shape[0]
    out = np.empty((length, n, hidden), np.float32)
    z, r, c, e = (np.empty((n, hidden), np.float32) for _ in range(4))
    h, trace = np.zeros((n, hidden), np.float32), []
    for t in (range(length) if d == "f" else range(length - 1, -1, -1)):
        at = x[t]
        if keep:
            z, r, c = (np.empty((n, hidden), np.float32) for _ in range(3))
        for gate, g in (("z", z), ("r", r)):
            np.matmul(h, p[f"U{gate}{d}"], out=g)
            g += np.take(p[f"E{gate}{d}"], at, axis=0, out=e, mode="clip")
            np.maximum(g, 0, out=g)
            np.minimum(g, 1, out=g)
        rh = r * h
        np.matmul(rh, p[f"Uc{d}"], out=c)
        c += np.take(p[f"Ec{d}"], at, axis=0, out=e, mode="clip")
        np.tanh(c, out=c)
        if keep:
            trace.append((t, h, z, r, c, rh))
        h = np.add(h, z * (c - h), out=out[t])
    return (out, trace) if keep else out


def softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(-1, keepdims=True))
    return a / a.sum(-1, keepdims=True)


def gradients(p, x: np.ndarray, y: np.ndarray):
    """Loss and gradients of the mean cross-entropy over all positions that are not padding."""
    states, traces = {}, {}
    for d in "fb":
        states[d], traces[d] = run_direction(p, d, x, keep=True)
    prob = softmax(states["f"] @ p["Wf"] + states["b"] @ p["Wb"] + p["bias"])
    real = (x > 0).astype(np.float32)
    n = max(1.0, float(real.sum()))
    picked = np.take_along_axis(prob, np.broadcast_to(y[None, :, None], (*x.shape, 1)), 2)[..., 0]
    loss = float(-(np.log(picked + 1e-9) * real).sum() / n)
    da = prob.copy()
    da[:, np.arange(len(y)), y] -= 1
    da *= (real / n)[..., None]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["bias"] = da.sum((0, 1))
    for d in "fb":
        g[f"W{d}"] = np.einsum("tnh,tnk->hk", states[d], da)
        into = da @ p[f"W{d}"].T
        carry = np.zeros_like(into[0])
        dx = {gate: np.empty_like(into) for gate in "zrc"}
        for t, h, z, r, c, rh in reversed(traces[d]):
            dh = into[t] + carry
            dc = dh * z * (1 - c * c)
            drh = dc @ p[f"Uc{d}"].T
            dz = dh * (c - h) * ((z > 0) & (z < 1))
            dr = drh * h * ((r > 0) & (r < 1))
            carry = dh * (1 - z) + drh * r + dz @ p[f"Uz{d}"].T + dr @ p[f"Ur{d}"].T
            g[f"Uc{d}"] += rh.T @ dc
            g[f"Uz{d}"] += h.T @ dz
            g[f"Ur{d}"] += h.T @ dr
            dx["z"][t], dx["r"][t], dx["c"][t] = dz, dr, dc
        for gate in "zrc":
            np.add.at(g[f"E{gate}{d}"], x.ravel(), dx[gate].reshape(-1, dx[gate].shape[-1]))
    return loss, g


def train(rows: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7):
    """(parameters, languages in order) from (text, lang) rows."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None, []
    rng = np.random.default_rng(seed)
    cut = [windows([t.encode("utf-8", "surrogatepass")], TRAIN_WINDOW)[0] for t, _ in rows]
    x = np.concatenate(cut)
    y = np.repeat([langs.index(lang) for _, lang in rows], [len(c) for c in cut])
    pools = [np.flatnonzero(y == k) for k in range(len(langs))]
    p = init(hidden, len(langs), rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(pool, max(1, TRAIN_BATCH // len(langs))) for pool in pools])
        _, g = gradients(p, np.ascontiguousarray(x[pick].T).astype(np.intp), y[pick])
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            a = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.99 * v[k] + 0.01 * a * a
            p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        still(p)
    return p, langs


def probabilities(p, texts: list[bytes]) -> np.ndarray:
    """Mean of the position probabilities of each text, over all its bytes."""
    x, per = windows(texts, WINDOW)
    total = np.empty((len(x), len(p["bias"])))
    for i in range(0, len(x), BATCH):
        part = np.ascontiguousarray(x[i:i + BATCH].T).astype(np.intp)
        a = run_direction(p, "f", part) @ p["Wf"]
        a += run_direction(p, "b", part) @ p["Wb"]
        a += p["bias"]
        a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
        a *= ((part > 0) / a.sum(-1))[..., None].astype(np.float32)
        total[i:i + BATCH] = a.sum(0, dtype=np.float64)
    summed = np.add.reduceat(total, starts_of(per)[:-1], axis=0) if len(texts) else total
    return summed / np.maximum(summed.sum(1, keepdims=True), 1e-12)


def sample(docs: DataFrame, per_lang: int = PER_LANG, cuts: int = CUTS) -> list[tuple[str, str]]:
    """Cuts of the training documents, at most about per_lang * cuts per language."""
    rows = docs.select("doc_id", "text", "lang").where((crc_mod("doc_id", 5) != 0) & F.col("lang").isNotNull())
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not n:
        return []
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(v) for lang, k in sorted(n.items()) for v in (lang, min(1.0, 2 * per_lang / k))])
    rows = rows.where((unit < share[F.col("lang")]) & F.col("text").isNotNull())
    # rows that share doc_id and text are one; no language sends more than per_lang rows to the driver
    best = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id", "text"))
    rows = rows.withColumn("_h", F.xxhash64("doc_id", "text")).dropDuplicates(["lang", "_h", "doc_id"]).withColumn("_r", best).where(F.col("_r") <= per_lang)
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    part = [F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int"), F.lit(WINDOW)) for k in range(cuts)]
    got = rows.select("doc_id", "lang", F.array(*part).alias("cuts")).collect()
    return sorted({(t, r["lang"]) for r in got for t in r["cuts"] if t})


RESULT = "lang_pred string, score double"


def with_language(docs: DataFrame, model, text: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct column (lang_pred, score)."""
    p, langs = model

    @F.pandas_udf(RESULT)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = np.asarray([*langs, UNDETERMINED], dtype=object)
        for s in parts:
            out = []
            for b in blocks(s):
                letters = np.asarray([any(map(str.isalpha, t)) for t in b])
                if langs:
                    prob = probabilities(p, [t.encode("utf-8", "surrogatepass") for t in b])
                    best, score = prob.argmax(1), np.where(letters, prob.max(1), 0.0)
                else:
                    best, score, letters = np.zeros(len(b), int), np.zeros(len(b)), np.zeros(len(b), bool)
                out.append(pd.DataFrame({"lang_pred": names[np.where(letters, best, len(langs))], "score": np.clip(score, 0, 1)}))
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"lang_pred": [], "score": []})

    return docs.withColumn(name, predict(F.col(text)))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = with_language(docs.select("doc_id", "text"), train(sample(docs)))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "language.*")
