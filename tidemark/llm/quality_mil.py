"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded from the bytes it is made of and
from how its words repeat; a gated attention layer, learned from document labels alone, weighs the passages, and a
logistic layer scores the weighted mean of their encodings.

The network is small and fitted in numpy on a bounded sample of labelled documents. All documents are then scored
where they lie, whole slices at a time, without a shuffle; nothing about a row but its text enters the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices

PASSAGE_WORDS = 48
HIDDEN, GATE = 16, 12
PREDICT_FROM = 0.7
#: Labelled documents that the network is fitted on.
SAMPLE_DOCUMENTS = 3000


def _classes() -> tuple[np.ndarray, int]:
    """Class of each byte: every ASCII sign by itself, all capitals, all digits, all lower-case letters, all others."""
    out, known = np.zeros(256, np.int64), 4
    for b in range(128):
        c = chr(b)
        if c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif c.islower():
            out[b] = 3
        elif 32 < b < 127:
            out[b], known = known, known + 1
    return out, known


CLASS, CLASSES = _classes()
LENGTHS = 12
WIDTH = CLASSES + LENGTHS + 5


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, one after another, and where each text's passages begin.

    A text without words is one passage of zeros, so every text has a score.
    """
    lists = [t.split() for t in texts]
    count = np.array([len(x) for x in lists], np.int64)
    words = [w for x in lists for w in x]
    number, _ = codes(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    per = np.maximum((count + PASSAGE_WORDS - 1) // PASSAGE_WORDS, 1)
    bounds = np.concatenate([[0], np.cumsum(per)])
    begin = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(texts)), count)
    inside = np.arange(len(words)) - begin[doc]
    passage = bounds[:-1][doc] + inside // PASSAGE_WORDS
    n = int(bounds[-1])
    signs = np.frombuffer(b"".join(words), np.uint8)
    made = np.bincount(np.repeat(passage, size) * CLASSES + CLASS[signs], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float32)
    chars = np.maximum(made.sum(axis=1, keepdims=True), 1)
    in_passage = np.maximum(np.bincount(passage, minlength=n), 1).astype(np.float32)
    lengths = np.bincount(passage * LENGTHS + np.minimum(size, LENGTHS) - 1, minlength=n * LENGTHS).reshape(n, LENGTHS) / in_passage[:, None]
    same = np.zeros(len(words), bool)
    same[1:] = (number[1:] == number[:-1]) & (inside[1:] > 0)
    key = np.sort(passage * (int(number.max()) + 1 if len(number) else 1) + number)
    fresh = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    distinct = np.bincount(fresh // (int(number.max()) + 1 if len(number) else 1), minlength=n) / in_passage
    more = np.stack([np.bincount(passage, weights=same, minlength=n) / in_passage, 1 - distinct, np.log1p(in_passage), chars[:, 0] / in_passage / 8, np.log1p(np.repeat(count, per)) / 8], axis=1)
    return np.concatenate([np.sqrt(made / chars), lengths, more], axis=1, dtype=np.float32), bounds


@dataclass
class Network:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the scorer (c, d), and the scale of features."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    NAMES = ("w", "b", "v", "u", "a", "c", "d")

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> tuple:
        h = np.tanh(((x - self.mean) / self.scale) @ self.w + self.b)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * s) @ self.a
        start, sizes = bounds[:-1], np.diff(bounds)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), sizes))
        weight = e / np.repeat(np.add.reduceat(e, start), sizes)
        z = np.add.reduceat(h * weight[:, None], start, axis=0)
        return h, t, s, weight, z, 1 / (1 + np.exp(-np.clip(z @ self.c + self.d[0], -30, 30)))

    def score(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.forward(x, bounds)[-1] if len(bounds) > 1 else np.zeros(0)

    def gradient(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of documents."""
        h, t, s, weight, z, p = self.forward(x, bounds)
        sizes = np.diff(bounds)
        dp = (p - y) / len(y)
        dz = np.repeat(dp[:, None] * self.c, sizes, axis=0)
        dw = (dz * h).sum(axis=1)
        de = weight * (dw - np.repeat(np.add.reduceat(weight * dw, bounds[:-1]), sizes))
        dg = de[:, None] * self.a
        dv, du = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (dz * weight[:, None] + dv @ self.v.T + du @ self.u.T) * (1 - h * h)
        return {"w": ((x - self.mean) / self.scale).T @ dh, "b": dh.sum(axis=0), "v": h.T @ dv, "u": h.T @ du, "a": (t * s).T @ de, "c": z.T @ dp, "d": dp.sum(keepdims=True)}

    @classmethod
    def fit(cls, bags: list[np.ndarray], y: np.ndarray, rounds: int = 40, batch: int = 128, rate: float = 5e-3, decay: float = 1e-4, seed: int = 1) -> Network:
        """Adam on batches of documents; the same input gives the same network. Without documents all score 0.5."""
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
        shapes = {"w": (WIDTH, HIDDEN), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE)}
        start = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
        net = cls(every.mean(axis=0), np.maximum(every.std(axis=0), 0.02), b=np.zeros(HIDDEN), a=rng.normal(0, 0.1, GATE), c=np.zeros(HIDDEN), d=np.zeros(1), **start)
        m, v, step = {k: 0.0 for k in cls.NAMES}, {k: 0.0 for k in cls.NAMES}, 0
        for _ in range(rounds if len(bags) else 0):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                own, step = order[i : i + batch], step + 1
                bounds = np.concatenate([[0], np.cumsum([len(bags[k]) for k in own])])
                for k, g in net.gradient(np.concatenate([bags[j] for j in own]), bounds, y[own]).items():
                    g = g + decay * getattr(net, k)
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
        return net


def remainder(id_col: str):
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: int = 2, documents: int = SAMPLE_DOCUMENTS) -> Network:
    """Fit on at most ``documents`` labelled documents of ``docs`` that are not held out, chosen by the hash of their id,
    all passages of each. Of labels that disagree the lower counts; null labels are left out. Of texts that share an id
    one counts, the same in every run."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chosen = labels.where(F.col(label_col).isNotNull() & (remainder(id_col) != held_out)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = chosen.join(texts.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in slices(batches):
            x, bounds = encode(own)
            made = [x[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(made, pa.binary())], ["id", "label", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.join(chosen, "id").select("id", "label", "text").mapInArrow(run, f"id {kind}, label int, features binary")
    one = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("features").alias("features"))
    found = sorted((r.id, r.label, bytes(r.features)) for r in one.collect())  # bounded by documents
    bags = [np.frombuffer(f, np.float32).reshape(-1, WIDTH) for _, _, f in found]
    return Network.fit(bags, np.array([float(y > 0) for _, y, _ in found]))


def score_documents(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = PREDICT_FROM) -> DataFrame:
    """(id, score, predicted, n_passages): one row per row of ``docs``, the score from 0 to 1.

    Null, empty and blank texts are one empty passage and get its score. Repeated rows each get a row, null ids are
    passed on, very long texts are read whole. No documents give no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            x, bounds = encode(texts)
            p = network.score(x, bounds)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p.astype(np.float64)), pa.array((p >= threshold).astype(np.int32)), pa.array(np.diff(bounds))], ["id", "score", "predicted", "n_passages"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int, n_passages long")
