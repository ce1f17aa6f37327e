"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts with label 1; the unlabelled web text is a sample of all texts of the training folds, whatever their label. Labels 0 are
not used. The class prior (the share of good texts among the unlabelled) is estimated first: a plain network tells positives from unlabelled texts on one half of the
sample, and on the other half the least ratio of the shares above a threshold, unlabelled to positive, each with its sampling error, bounds the prior from above. Then a network with one hidden layer
minimises the non-negative unbiased risk with logistic loss,

    prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0)),

by Adam; where the second part of a batch is below zero, the step goes against its gradient instead, as the method has it, so that the
network doesn't fit single unlabelled texts. The steps against the gradient leave its odds too flat, so a slope and an offset of the odds are fitted last, by the
unbiased risk over both whole samples, which is convex in these two. The score is the probability of label 1.

Inputs are made of the text alone: frequencies of pairs of byte classes over the whole text, and of its words and lines how many repeat, how long they are, how much is
capital, digit or symbol. The sample is bounded: about SAMPLE trusted positives and SAMPLE unlabelled texts, twice as many at most; only their inputs (INPUTS numbers each) are gathered.
All texts are scored.

Defined results: a null text counts as empty, and empty texts have a score like any other (all frequencies 0); without a trusted positive, or
without a text of the training folds, nothing is learned and every score is 0.5; a text whose labels differ is no trusted positive, labels that repeat
count once, null labels not at all; rows that repeat an id are scored each by its own text; a null id is of no fold (held_out is false) and takes no part in learning;
bytes that aren't UTF-8 are of the class of letters beyond ASCII; columns other than id and text are not read."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free, per_text

#: Most trusted positives and unlabelled texts that are gathered, on average; folds and the one that is held out; least score of label 1.
SAMPLE, FOLDS, HELD_OUT, LEAST = 6000, 5, 0, 0.3
#: Width of the hidden layer, epochs, texts of a batch, rate of steps, decay of weights, lower bound of the negative part of the risk.
HIDDEN, EPOCHS, BATCH, RATE, DECAY, BELOW = 24, 60, 2048, 0.006, 1e-4, 0.0
#: Weight of the odds' spread in the last fit.
RIDGE = 1e-3
#: Classes of bytes: letters small and capital, digits, blank, line end, kinds of punctuation and symbols, bytes beyond ASCII, others.
GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".", b",;:", b"!?", b"\"'`", b"()[]{}", b"<>|", b"#*$%&", b"-_+=~^", b"/\\@")
CLASSES = len(GROUPS) + 2
FACTS = 16
INPUTS = CLASSES * CLASSES + FACTS


def _class_of_bytes() -> np.ndarray:
    of = np.full(256, CLASSES - 1, np.intp)
    of[128:] = CLASSES - 2
    for k, group in enumerate(GROUPS):
        of[list(group)] = k
    return of


CLASS_OF = _class_of_bytes()


def inputs(text: bytes | None) -> np.ndarray:
    """INPUTS numbers of a whole text."""
    out = np.zeros(INPUTS, np.float32)
    if not text:
        return out
    of = CLASS_OF[np.frombuffer(text, np.uint8)]
    if len(of) > 1:
        out[: CLASSES * CLASSES] = np.sqrt(np.bincount(of[:-1] * CLASSES + of[1:], minlength=CLASSES * CLASSES) / (len(of) - 1))
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    met: dict[bytes, int] = {}
    for w in words:
        met[w] = met.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    share = np.bincount(of, minlength=CLASSES) / len(of)
    letters = max(1e-9, share[0] + share[1] + share[-2])
    squeezed = len(zlib.compress(text, 1)) / len(text)
    out[CLASSES * CLASSES :] = (
        np.log1p(len(text)) / 10, np.log1p(n) / 10, len(text) / n / 10, len(met) / n, max(met.values(), default=0) / n, pairs / max(1, n - 1), len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)) / 100, share[1] / letters, share[2], share[5:14].sum(), share[-1], min(squeezed, 2.0), sum(1 for w in met if len(w) > 20) / n,
        sum(map(eq, words, words[1:])) / max(1, n - 1), sum(1 for w in words if w[:1].isupper()) / n,
    )
    return out


@dataclass
class Network:
    """One hidden layer over scaled inputs; INPUTS numbers to the log-odds of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.weights
        return np.maximum(np.clip((x - self.mean) / self.scale, -8, 8) @ w + b, 0) @ v + c[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.odds(x) + self.offset, -30, 30)))

    def calibrate(self, good: np.ndarray, web: np.ndarray) -> None:
        """Slope and offset that minimise mean(log(1 + exp(web))) - prior * mean(good), the unbiased logistic risk, and a little of the odds' square, by damped Newton steps."""
        f, g, at = self.odds(web).astype(np.float64), float(self.odds(good).mean()), np.array([1.0, 0.0])
        ridge = RIDGE * float(f.var())
        risk = lambda a: np.logaddexp(0, a[0] * f + a[1]).mean() - self.prior * (a[0] * g + a[1]) + ridge * a[0] ** 2
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(at[0] * f + at[1], -30, 30)))
            steep = np.array([(p * f).mean() - self.prior * g + 2 * ridge * at[0], p.mean() - self.prior])
            q = p * (1 - p)
            bend = np.array([[(q * f * f).mean() + 2 * ridge, (q * f).mean()], [(q * f).mean(), q.mean()]]) + 1e-9 * np.eye(2)
            step, size = np.linalg.solve(bend, steep), 1.0
            while size > 1e-3 and risk(at - size * step) > risk(at):
                size /= 2
            at = at - size * step
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.offset = float(max(at[0], 1e-3)), float(at[1])


def _gradient(weights: list[np.ndarray], x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
    """Of sum(slope * odds) by the weights."""
    w, b, v, _ = weights
    h = np.maximum(x @ w + b, 0)
    back = slope[:, None] * v * (h > 0)
    return [x.T @ back, back.sum(axis=0), h.T @ slope, np.array([slope.sum()], np.float32)]


def train(good: np.ndarray, web: np.ndarray, prior: float | None, seed: int = 5, epochs: int = EPOCHS) -> Network:
    """A network that minimises the non-negative risk for a prior; without one, the plain logistic risk of positives against unlabelled."""
    rng = np.random.default_rng(seed)
    mean, scale = web.mean(axis=0), web.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float32) for x in (good, web))
    weights = [rng.normal(0, INPUTS**-0.5, (INPUTS, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    batches = max(1, -(-len(u) // BATCH))
    for epoch in range(epochs):
        parts = zip(np.array_split(rng.permutation(len(p)), min(batches, len(p))), np.array_split(rng.permutation(len(u)), min(batches, len(p))), strict=True)
        for a, b in parts:
            x, y = p[a], u[b]
            w, bias, v, c = weights
            fp, fu = np.maximum(x @ w + bias, 0) @ v + c[0], np.maximum(y @ w + bias, 0) @ v + c[0]
            if prior is None:
                slopes = (sigmoid(fp) - 1) / len(a), sigmoid(fu) / len(b)
            else:
                below = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
                as_zero, of_web = -prior * sigmoid(fp) / len(a), sigmoid(fu) / len(b)
                slopes = (prior * (sigmoid(fp) - 1) / len(a) + as_zero, of_web) if below >= BELOW else (-as_zero, -of_web)
            grads = [g + h for g, h in zip(_gradient(weights, x, slopes[0].astype(np.float32)), _gradient(weights, y, slopes[1].astype(np.float32)), strict=True)]
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8) + DECAY * weights[k])
    made = Network(mean, scale, weights, prior or 0.0)
    if prior is not None:
        made.calibrate(good, web)
    return made


def class_prior(good: np.ndarray, web: np.ndarray, seed: int = 5) -> float:
    """The share of good texts among the unlabelled, bounded by the least ratio of shares above a threshold on the half that was not trained on."""
    rng = np.random.default_rng(seed)
    p, u = good[rng.permutation(len(good))], web[rng.permutation(len(web))]
    i, j = max(1, len(p) // 2), max(1, len(u) // 2)
    told = train(p[:i], u[:j], None, seed, epochs=EPOCHS // 3)
    held_p, held_u = np.sort(told.odds(p[i:] if len(p) > 1 else p)), np.sort(told.odds(u[j:] if len(u) > 1 else u))
    at = np.quantile(held_p, np.linspace(0, 0.9, 91))
    above = lambda x: (len(x) - np.searchsorted(x, at)) / len(x)
    of_p, of_u = above(held_p), above(held_u)
    error = lambda share, n: np.sqrt(np.maximum(share * (1 - share), 1 / n) / n)
    bound = (of_u + error(of_u, len(held_u))) / np.maximum(of_p - error(of_p, len(held_p)), 1e-6)
    return float(np.clip(bound.min(), 0.02, 0.98))


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Network | None:
    """The network of the training folds. Ids of trusted positives are drawn first (at most twice the sample, so they are broadcast), then both samples come from one scan."""
    trains = lambda c: fold(c) != HELD_OUT
    draw = lambda c: F.pmod(F.xxhash64(c.cast("string")), F.lit(1 << 30)) / float(1 << 30)
    told = labels.where(labels[label_col].isNotNull() & trains(labels[id_col])).groupBy(labels[id_col].alias("_id")).agg(F.min(label_col).alias("_least"), F.max(label_col).alias("_most")).where("_least = 1 AND _most = 1")
    n_good, n = told.count(), docs.count()
    if not n_good or not n:
        return None
    ids = told.where(draw(F.col("_id")) < sample / n_good).select("_id").limit(2 * sample)
    rows = docs.where(trains(docs[id_col])).select(docs[id_col].alias("_of"), docs[text_col].alias("_text")).join(F.broadcast(ids), F.col("_of") == F.col("_id"), "left")
    rows = rows.select("_of", "_text", F.col("_id").isNotNull().alias("_good"), (F.xxhash64(F.lit(1), F.col("_of").cast("string")).bitwiseAND((1 << 30) - 1) / float(1 << 30) < sample / n).alias("_web"))
    made = per_text(rows.where("_good OR _web"), ["_good", "_web"], "_text", "x binary", lambda texts: [pa.array([inputs(t).tobytes() for t in texts], pa.binary())], as_bytes=True)
    found = [(r["_good"], r["_web"], bytes(r["x"])) for r in made.limit(4 * sample).collect()]
    side = lambda k: np.frombuffer(b"".join(sorted(r[2] for r in found if r[k])), np.float32).reshape(-1, INPUTS)
    good, web = side(0), side(1)
    if not len(good) or not len(web):
        return None
    return train(good, web, class_prior(good, web))


def with_quality(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row."""

    def work(texts: list) -> list:
        if network is None:
            return [np.full(len(texts), 0.5)]
        return [network.score(np.stack([inputs(t) for t in texts])).astype(np.float64) if texts else np.empty(0)]

    name = free(df, "id")
    scored = per_text(df.select(df[id_col].alias(name), df[text_col]), [name], text_col, "score double", work, as_bytes=True)
    return scored.select(F.col(name).alias(id_col), F.coalesce(fold(F.col(name)) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return with_quality(docs, learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
