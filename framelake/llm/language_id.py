"""Language by a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

A text's UTF-8 bytes are cut into windows of ``STEPS`` bytes. One recurrent layer reads each window forwards and one
backwards; from both states every byte gets a probability for each language, and a document's probabilities are the
means over all its bytes. All windows of many documents advance together, a byte a step.

The network learns from windows of about ``FIT_ROWS`` documents outside the held-out quarter, as many of each language
(``LEAST_OF_LANGUAGE`` at least, if it has them), those of lowest hash of their key; documents without a letter are no
sample. Of each it reads ``FIT_WINDOWS`` x ``STEPS`` characters from a place set by a hash. Language, source and key are no inputs of a prediction.

Texts that are null or have no letter are "und" with score 0, as are all texts if nothing can be learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import counted, slices, table
from framelake.session import share_code

HIDDEN, STEPS = 8, 48
#: The bounded sample: documents, and windows of each.
FIT_ROWS, LEAST_OF_LANGUAGE, FIT_WINDOWS = 3000, 20, 4
MARGIN = 8
ROUNDS, BATCH, RATE = 500, 256, 0.02
#: Windows that advance together; their states fit a core's cache.
TOGETHER = 2048
LETTER = re.compile(r"[^\W\d_]")
PAD = 0x20


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 4 == 2


@dataclass
class Network:
    """``cells`` holds for each direction (input rows by byte, recurrent weights, recurrent bias of the candidate)."""

    languages: list[str]
    cells: list[list[np.ndarray]] = field(default_factory=list)
    out: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def start(languages: list[str], hidden: int = HIDDEN, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        cells = [[draw(3 * hidden, 256, s=0.3), draw(3 * hidden, hidden, s=0.3), np.zeros((hidden, 1), np.float32)] for _ in range(2)]
        for e, _, _ in cells:
            e[:hidden] += 1.0  # update gates start half closed, so that states last
        return Network(languages, cells, [draw(len(languages), 2 * hidden, s=0.3), np.zeros((len(languages), 1), np.float32)])

    # states are (hidden, windows); gates are sigmoids as tanh(x / 2) / 2 + 1 / 2; z keeps the old state

    def _run(self, cell: list[np.ndarray], x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step for bytes (steps, windows), and what backpropagation needs."""
        rows, weights, bias = cell
        n = weights.shape[1]
        steps, width = x.shape
        states, saved = np.empty((steps, n, width), np.float32), []
        h = np.zeros((n, width), np.float32)
        half = np.float32(0.5)
        for t in range(steps):
            g = rows.take(x[t], axis=1)
            u = weights @ h
            gates = g[: 2 * n]
            gates += u[: 2 * n]
            gates *= half
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            z, r = gates[:n], gates[n:]
            c = u[2 * n :]
            c += bias
            raw = c.copy() if keep else None
            c *= r
            c += g[2 * n :]
            np.tanh(c, out=c)
            before = h
            h = states[t]
            np.subtract(before, c, out=h)
            h *= z
            h += c
            if keep:
                saved.append((before, z, r, c, raw))
        return states, saved

    def logits(self, x: np.ndarray) -> np.ndarray:
        """(steps, languages, windows)."""
        forth, _ = self._run(self.cells[0], x, False)
        back, _ = self._run(self.cells[1], x[::-1], False)
        n = HIDDEN if not self.cells else self.cells[0][1].shape[1]
        w, b = self.out
        return w[:, :n] @ forth + w[:, n:] @ back[::-1] + b

    def learn(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all bytes of windows (steps, windows) with languages ``y``, and its gradient."""
        steps, width = x.shape
        n = self.cells[0][1].shape[1]
        runs = [self._run(self.cells[0], x, True), self._run(self.cells[1], x[::-1], True)]
        both = np.concatenate([runs[0][0], runs[1][0][::-1]], axis=1)
        w, b = self.out
        logit = w @ both + b
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=1, keepdims=True)
        scale = weight / (weight.sum() * steps)
        loss = float(-(np.log(p[:, y, np.arange(width)] + 1e-9) * scale).sum())
        p[:, y, np.arange(width)] -= 1
        p *= scale.astype(np.float32)
        d_out = [np.einsum("tlw,thw->lh", p, both, optimize=True), p.sum(axis=(0, 2))[:, None]]
        d_both = w.T @ p
        grads: list[np.ndarray] = []
        for direction, (_, saved) in enumerate(runs):
            rows, weights, _ = self.cells[direction]
            d_states = d_both[:, :n] if direction == 0 else d_both[::-1, n:]
            seen = x if direction == 0 else x[::-1]
            d_rows, d_weights, d_bias = np.zeros_like(rows), np.zeros_like(weights), np.zeros((n, 1), np.float32)
            d_h = np.zeros((n, width), np.float32)
            for t in range(steps - 1, -1, -1):
                before, z, r, c, raw = saved[t]
                d_h = d_h + d_states[t]
                d_c = d_h * (1 - z) * (1 - c * c)
                d_raw = d_c * r
                d_g = np.concatenate([d_h * (before - c) * z * (1 - z), d_c * raw * r * (1 - r), d_c])
                d_u = np.concatenate([d_g[: 2 * n], d_raw])
                np.add.at(d_rows.T, seen[t], d_g.T)
                d_weights += d_u @ before.T
                d_bias += d_raw.sum(axis=1, keepdims=True)
                d_h = d_h * z + weights.T @ d_u
            grads += [d_rows, d_weights, d_bias]
        return loss, grads + d_out

    def parameters(self) -> list[np.ndarray]:
        return [*self.cells[0], *self.cells[1], *self.out]

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the bytes of each text (none empty)."""
        lengths = np.array([len(t) for t in texts])
        windows = -(-lengths // STEPS)
        joined = b"".join(t + b" " * (int(k) * STEPS - len(t)) for t, k in zip(texts, windows, strict=True))
        x = np.frombuffer(joined, np.uint8).reshape(-1, STEPS)
        sums = np.empty((len(x), len(self.languages)), np.float64)
        last = np.zeros(len(x), np.int64)
        ends = np.cumsum(windows)
        last[ends - 1] = windows * STEPS - lengths  # bytes of padding
        for a in range(0, len(x), TOGETHER):
            part = x[a : a + TOGETHER]
            p = self.logits(np.ascontiguousarray(part.T).astype(np.intp))
            p -= p.max(axis=1, keepdims=True)
            np.exp(p, out=p)
            p /= p.sum(axis=1, keepdims=True)
            for i in np.flatnonzero(last[a : a + TOGETHER]):
                p[STEPS - last[a + i] :, :, i] = 0
            sums[a : a + TOGETHER] = p.sum(axis=0).T
        return np.add.reduceat(sums, np.concatenate(([0], ends[:-1])), axis=0) / lengths[:, None]


def fit(texts: list[str], languages: list[str], seed: int = 5) -> Network | None:
    """A network trained on windows of the texts, by Adam."""
    names = sorted(set(languages))
    rng = np.random.default_rng(seed)
    windows, y = [], []
    for text, lang in zip(texts, languages, strict=True):
        data = text.encode("utf-8", "replace")
        if lang not in names or not LETTER.search(text):
            continue
        for _ in range(min(FIT_WINDOWS, -(-len(data) // STEPS))):
            at = int(rng.integers(0, max(1, len(data) - STEPS + 1)))
            windows.append(data[at : at + STEPS].ljust(STEPS))
            y.append(names.index(lang))
    if not windows:
        return None
    net = Network.start(names, seed=seed)
    x, y = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, STEPS).astype(np.intp), np.array(y)
    # rare languages weigh more, by the root of their share
    weights = 1 / np.sqrt(np.maximum(1, np.bincount(y, minlength=len(names))))
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, ROUNDS + 1):
        some = rng.integers(0, len(x), min(BATCH, len(x)))
        _, grads = net.learn(np.ascontiguousarray(x[some].T), y[some], weights[y[some]])
        rate = RATE * min(1.0, 2 * (1 - (k - 1) / ROUNDS))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            p -= rate * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.99**k)) + 1e-6)
    return net


def train(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Fits on a sample of rows with text and language that aren't held out, as many of each language."""
    n = FIT_WINDOWS * STEPS
    # of each text only so much as its windows need, from a place set by its hash
    at = F.pmod(F.xxhash64("q_text"), F.greatest(F.lit(1), F.length("q_text") - n)) + 1
    usable = documents.select(F.col(key).alias("q_key"), F.col(lang).alias("q_lang"), F.col(text).alias("q_text")).where(F.col("q_key").isNotNull() & F.col("q_lang").isNotNull() & ~held_out(F.col("q_key")))
    sizes = counted(usable.groupBy(F.col("q_lang").alias("q_name")).agg(F.count("*").alias("q_n")))
    most = max(LEAST_OF_LANGUAGE, FIT_ROWS // max(1, sizes.count()))
    # of a large language, rows of low hash alone, MARGIN times as many as are wanted; so what meets in a task is bounded
    h = F.xxhash64(F.col("q_key").cast("string"))
    low = (h.cast("double") + 2.0**63) * F.col("q_n") < 2.0**64 * MARGIN * most
    usable = usable.join(sizes, F.col("q_lang") == F.col("q_name")).where(low)
    usable = usable.select("q_key", "q_lang", F.substring("q_text", at.cast("int"), F.lit(n)).alias("q_part")).where(F.col("q_part").rlike(r"\p{L}"))
    order = Window.partitionBy("q_lang").orderBy(h, "q_key", "q_part")
    rows = sorted(usable.withColumn("q_rank", F.row_number().over(order)).where(F.col("q_rank") <= most).select("q_key", "q_part", "q_lang").collect())
    return fit([r["q_part"] for r in rows], [r["q_lang"] for r in rows])


def predict(documents: DataFrame, net: Network | None, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the likeliest language and its probability; columns of those names are replaced."""
    share_code(documents.sparkSession)
    keep = [c for c in documents.columns if c not in (into, score)]
    rows = documents.select(*keep)
    at = keep.index(text)
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.StringType()), T.StructField(score, T.DoubleType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(at).to_pylist()
            known = [i for i, t in enumerate(texts) if net is not None and t and LETTER.search(t)]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if known:
                p = net.probabilities([texts[i].encode("utf-8", "replace") for i in known])
                for i, best, value in zip(known, p.argmax(axis=1), p.max(axis=1), strict=True):
                    names[i], scores[i] = net.languages[best], float(min(1.0, value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, into, score])

    return rows.mapInArrow(label, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by what the documents outside the held-out quarter teach."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(documents.select("doc_id", "text"), train(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
