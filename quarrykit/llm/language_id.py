"""Language identification by a bidirectional gated recurrent network over bytes.

The bytes of a text, cut into windows of WINDOW, are read by two gated recurrent layers, one in each direction; every
position gets a probability of each language, and a text's probability is the mean over all its positions. The gates
are piecewise linear, the candidate is a hyperbolic tangent. The network is trained here, in numpy, by back-propagation
through time on every position of a sample: up to PER_LANGUAGE texts (on average) of every label, fewer of each, but at least
LEAST_TEXTS, once that came to more than SAMPLE_TEXTS texts; SAMPLE_CHARS characters of each, picked by a hash of the row, at most twice as many.
With more labels than MANY the network has more states and steps. Prediction reads whole texts.

Defined results: `und` with score 0 if a text is null or has no letter, or if there is nothing to learn from;
bytes that aren't UTF-8 are read as U+FFFD; rows are independent, so ties, repeated rows and empty tables need nothing special; a null label or id is
not learned from; a table's own columns of the names of the language and score give way to them, all others pass through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_type, documents, slices, texts_of, without

WINDOW, HIDDEN, BLOCK = 96, 8, 4096
PER_LANGUAGE, SAMPLE_CHARS, SAMPLE_TEXTS, LEAST_TEXTS = 600, 768, 38_400, 8
#: More labels than these get states and steps of their own, and smaller blocks.
MANY = 64
STEPS, BATCH, RATE = 500, 256, 0.02
#: Texts of the sample, at most, of which the usual score is taken.
JUDGED = 512
PAD, OFF = 256, np.float32(-1e4)
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text) if text else False


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of WINDOW byte numbers, padded with PAD, and the text that each row is of."""
    size = np.array([len(t) for t in texts], np.int64)
    rows = -(-size // WINDOW)
    out = np.full(int(rows.sum()) * WINDOW, PAD, np.int16)
    start = (np.cumsum(rows) - rows) * WINDOW
    for t, s in zip(texts, start.tolist(), strict=True):
        out[s : s + len(t)] = np.frombuffer(t, np.uint8)
    return out.reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), rows)


class ByteNetwork:
    """table[d]: what each byte adds to update, reset and candidate of direction d; again[d]: what the state adds; bias[d]: of the candidate."""

    def __init__(self, languages: list[str], seed: int = 7, hidden: int = HIDDEN) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.languages, h = languages, hidden
        self.usual = 0.0  # the median score of texts that it was trained on
        self.table = [np.concatenate((draw(257, 2 * h, scale=0.1) + np.float32(0.5), draw(257, h, scale=0.5)), axis=1) for _ in range(2)]
        self.again = [draw(h, 3 * h, scale=0.5 / np.sqrt(h)) for _ in range(2)]
        self.bias = [np.zeros(h, np.float32) for _ in range(2)]
        self.out = draw(2 * h, len(languages), scale=0.3)
        self.level = np.zeros(len(languages), np.float32)
        self._pad()

    def _pad(self) -> None:
        for t in self.table:  # gates shut: the state at a pad is zero
            t[PAD, : 2 * len(t[0]) // 3] = OFF
            t[PAD, 2 * len(t[0]) // 3 :] = 0

    def weights(self) -> list[np.ndarray]:
        return [*self.table, *self.again, *self.bias, self.out, self.level]

    def _read(self, d: int, byte: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of direction d at each position: byte is positions x windows."""
        h = len(self.bias[d])
        n = byte.shape[1]
        states = np.empty((len(byte), n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        x = np.empty((n, 3 * h), np.float32)
        for t in range(len(byte)) if d == 0 else range(len(byte) - 1, -1, -1):
            np.take(self.table[d], byte[t], axis=0, out=x, mode="clip")
            a = state @ self.again[d]
            gates = a[:, : 2 * h] + x[:, : 2 * h]
            shut = np.clip(gates, 0, 1)
            back = a[:, 2 * h :] + self.bias[d]
            candidate = np.tanh(x[:, 2 * h :] + shut[:, h:] * back)
            if keep is not None:
                keep.append((t, state, gates, shut, back, candidate))
            state = candidate + shut[:, :h] * (state - candidate)
            states[t] = state
        return states

    def positions(self, byte: np.ndarray) -> np.ndarray:
        """Probability of each language at each position: positions x windows x languages."""
        h = len(self.bias[0])
        score = self._read(0, byte) @ self.out[:h]
        score += self._read(1, byte) @ self.out[h:]
        score += self.level
        score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=2, keepdims=True)
        return score

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probability over all positions of each text; texts must not be empty."""
        rows, of = windows(texts)
        total = np.zeros((len(texts), len(self.languages)))
        block = max(1, BLOCK * MANY // max(MANY, len(self.languages)))
        for at in range(0, len(rows), block):
            byte = np.ascontiguousarray(rows[at : at + block].T).astype(np.intp)
            p = (self.positions(byte) * (byte != PAD)[:, :, None]).sum(axis=0, dtype=np.float64)
            for k in range(p.shape[1]):
                total[:, k] += np.bincount(of[at : at + block], p[:, k], len(texts))
        return total / np.array([[len(t)] for t in texts])

    def gradient(self, byte: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions and its gradient for weights(), back through time."""
        h = len(self.bias[0])
        kept: tuple[list, list] = ([], [])
        states = [self._read(d, byte, kept[d]) for d in (0, 1)]
        both = np.concatenate(states, axis=2)
        score = both @ self.out + self.level
        score -= score.max(axis=2, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=2, keepdims=True)
        real = byte != PAD
        n = max(1, int(real.sum()))
        at = np.broadcast_to(label, byte.shape)
        loss = -np.log(np.take_along_axis(p, at[:, :, None], 2)[:, :, 0] + 1e-9)[real].sum() / n
        p[:, np.arange(len(label)), label] -= 1
        p *= (real / n).astype(np.float32)[:, :, None]
        d_out, d_level = np.tensordot(both, p, ((0, 1), (0, 1))), p.sum(axis=(0, 1))
        d_both = p @ self.out.T
        d_table, d_again, d_bias = [], [], []
        for d in (0, 1):
            again, g_again, g_bias = self.again[d], np.zeros_like(self.again[d]), np.zeros_like(self.bias[d])
            g_input = np.empty((*byte.shape, 3 * h), np.float32)
            later = np.zeros_like(states[d][0])
            for t, before, gates, shut, back, candidate in reversed(kept[d]):
                g = later + d_both[t, :, d * h : (d + 1) * h]
                update, reset = shut[:, :h], shut[:, h:]
                g_candidate = g * (1 - update) * (1 - candidate**2)
                g_gates = np.concatenate((g * (before - candidate), g_candidate * back), axis=1) * ((gates > 0) & (gates < 1))
                g_back = g_candidate * reset
                g_all = np.concatenate((g_gates, g_back), axis=1)
                later = g * update + g_all @ again.T
                g_again += before.T @ g_all
                g_bias += g_back.sum(axis=0)
                g_input[t, :, : 2 * h], g_input[t, :, 2 * h :] = g_gates, g_candidate
            flat = byte.ravel()
            d_table.append(np.stack([np.bincount(flat, g_input[:, :, k].ravel(), 257) for k in range(3 * h)], axis=1))
            d_again.append(g_again)
            d_bias.append(g_bias)
        return float(loss), [*d_table, *d_again, *d_bias, d_out, d_level]

    def train(self, texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = 7) -> ByteNetwork:
        """Adam on batches that hold as many windows of each language as of any other, or one of each of BATCH languages in turn."""
        rng = np.random.default_rng(seed)
        rows, of = windows(texts)
        label = np.array(labels)[of]
        pools = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        pools = [p for p in pools if len(p)]
        mean, square = ([np.zeros_like(w, dtype=np.float64) for w in self.weights()] for _ in range(2))
        for step in range(1, steps + 1):
            turn = pools if len(pools) <= BATCH else [pools[k] for k in rng.choice(len(pools), BATCH, replace=False)]
            pick = np.concatenate([rng.choice(p, -(-BATCH // len(turn))) for p in turn])
            _, grads = self.gradient(np.ascontiguousarray(rows[pick].T).astype(np.intp), label[pick])
            rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
            for w, g, m, s in zip(self.weights(), grads, mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            self._pad()
        return self


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train_network(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, seed: int = 7) -> ByteNetwork | None:
    """A network from the labelled rows that aren't held out; None if there are none."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), df[lang_col].alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return None
    per_language = min(per_language, max(LEAST_TEXTS, SAMPLE_TEXTS // len(counts)))
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))))
    chance = F.pmod(F.xxhash64("id", F.substring("text", 1, 64)), F.lit(1 << 30)) / float(1 << 30)
    start = 1 + F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1)
    bound = 2 * per_language * len(counts)  # hashes that repeat don't make the sample any larger
    sample = rows.where(chance < F.coalesce(share[F.col("lang")], F.lit(0.0))).select("id", "lang", F.col("text").substr(start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text")).limit(bound)
    picked = sorted((str(r["id"]), r["lang"], r["text"]) for r in sample.collect() if has_letter(r["text"]))
    languages = sorted({lang for _, lang, _ in picked})
    if not languages:
        return None
    number, times = {lang: k for k, lang in enumerate(languages)}, -(-len(languages) // MANY)
    network = ByteNetwork(languages, seed, HIDDEN * min(4, times))
    network.train([t.encode("utf-8", "surrogatepass") for *_, t in picked], [number[lang] for _, lang, _ in picked], STEPS * times, seed)
    network.usual = float(np.median(predictions(network, [t for *_, t in picked[:: -(-len(picked) // JUDGED)]])[1]))
    return network


def predictions(network: ByteNetwork | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    told = [k for k, t in enumerate(texts) if network and has_letter(t)]
    if told:
        p = network.pooled([texts[k].encode("utf-8", "surrogatepass") for k in told])
        for k, best, own in zip(told, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
            lang[k], score[k] = network.languages[best], min(1.0, own)
    return lang, score


def with_language(df: DataFrame, network: ByteNetwork | None, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """df with the predicted language and its score as last columns, which take the place of columns of those names."""
    kept = without(df.columns, [lang_name, score_name])
    schema = ", ".join([*(f"`{c}` {column_type(df, c)}" for c in kept), f"`{lang_name}` string", f"`{score_name}` double"])
    names = [*kept, lang_name, score_name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = predictions(network, texts_of(batch.column(len(kept))))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names)

    return df.select(*(df[c] for c in kept), df[text_col]).mapInArrow(run, schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    told = with_language(docs.select("doc_id", "text"), train_network(docs))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
