"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Each line with a word has a few features. The field gives a score to a line being content and to two labels following
each other; Viterbi decoding finds the best sequence of labels for a whole document. A document is kept if enough of
its words stand on content lines and if two plain rules hold, on the number of words and on repeated word windows.

The field is fitted by gradient ascent on its exact log-likelihood (forward-backward) on a bounded sample of labelled
documents, whole texts. Only documents have labels, not lines: lines of documents labelled good count as content, except
those seen before in the document, lines of other documents as boilerplate. A document would then never change its
label, and the field would learn that labels never change. So it also reads mixed documents, lines of a good one
between lines of a bad one, from which it learns how one label follows another and that a line's own features decide.
All documents are then decoded where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 10, 20
REPEAT_WINDOW = 5
CONTENT_SHARE = 0.5
#: Labelled documents that the field is fitted on.
SAMPLE_DOCUMENTS = 2000
#: Lines of a sequence in the fit; longer documents are several sequences.
SEQUENCE_LINES = 120
UPPER, DIGITS, SPACE = bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\v\f\r"
FEATURES = ("bias", "seen before", "symbols per word", "capitals", "digits", "pipes per word", "exclamations per word", "words repeat the one before", "few distinct words", "ends a sentence", "one or two words", "twelve or more words", "first line", "long words")


def repeated_words(number: np.ndarray, bounds: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text: words in windows of ``window`` words found twice or more in that text, the first included.

    Windows are numbered exactly, by pairing numbers of shorter ones; no hash is involved.
    """
    n = len(number)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if n < window:
        return np.zeros(len(bounds) - 1, np.int64)
    at = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    value, width = number.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        top = int(value.max()) + 1 if len(value) else 1
        value = value[: len(value) - step] * top + value[step:]
        width += step
        if width < window:
            value = np.unique(value, return_inverse=True)[1]
    value = np.unique(value[at], return_inverse=True)[1]
    key = doc[at] * (int(value.max()) + 1 if len(value) else 1) + value
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[count[place] > 1]
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + window, -1)
    return np.bincount(doc[np.cumsum(step[:n]) > 0], minlength=len(bounds) - 1)


def line_features(text: bytes) -> tuple[np.ndarray, list[int], int]:
    """Features of the lines with a word, their numbers of words, and how many equal an earlier line."""
    rows, sizes, seen, again = [], [], set(), 0
    for line in text.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        old = line in seen
        seen.add(line)
        again += old
        full = len(line)
        before = sum(a == b for a, b in zip(words, words[1:], strict=False)) if len(set(words)) < n else 0
        rows.append((1.0, old, min(2.0, (full - len(line.translate(None, SYMBOLS))) / n), (full - len(line.translate(None, UPPER))) / full, (full - len(line.translate(None, DIGITS))) / full, min(1.0, line.count(b"|") / n), min(2.0, line.count(b"!") / n), before / n, 1 - len(set(words)) / n, words[-1][-1] in b".!?\"'", n <= 2, n >= 12, not sizes, full / n > 12))
        sizes.append(n)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES)), sizes, again


class Field:
    """Weights of the content label, and scores of one label following another (rows: before; 0 boilerplate)."""

    def __init__(self, weights: np.ndarray, follow: np.ndarray) -> None:
        self.weights, self.follow = weights, follow

    def decode(self, features: np.ndarray) -> list[int]:
        """The best labels of one document's lines; of equally good ones content, from the end backwards."""
        if not len(features):
            return []
        gain = (features @ self.weights).tolist()
        (t00, t01), (t10, t11) = self.follow.tolist()
        s0, s1, back = 0.0, gain[0], []
        for g in gain[1:]:
            a, b, c, d = s0 + t00, s1 + t10, s0 + t01, s1 + t11
            back.append((b >= a, d >= c))
            s0, s1 = (b if b >= a else a), (d if d >= c else c) + g
        label = int(s1 >= s0)
        out = [label]
        for pair in reversed(back):
            label = int(pair[label])
            out.append(label)
        return out[::-1]

    @classmethod
    def fit(cls, documents: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Field:
        """``documents``: features and labels of each. Exact gradients, Adam steps; same result for the same input."""
        documents = sorted((d for d in documents if len(d[0])), key=lambda d: -len(d[0]))
        k = len(FEATURES)
        theta = np.zeros(k + 4)
        if not documents:
            theta[0] = 1.0  # nothing to learn from: all is content
            return cls(theta[:k], theta[k:].reshape(2, 2))
        longest = max(len(x) for x, _ in documents)
        x = np.zeros((len(documents), longest, k))
        y = np.full((len(documents), longest), -1)
        for i, (f, labels) in enumerate(documents):
            x[i, : len(f)], y[i, : len(f)] = f, labels
        real = y >= 0
        both = real[:, 1:]
        live = real.sum(axis=0).tolist()  # documents are by length: the first so many have a line there
        doc, line = np.nonzero(real)
        before, at = np.nonzero(both)
        rows, last = x[real], real.sum(axis=1) - 1
        counts = np.zeros((2, 2))
        np.add.at(counts, (y[:, :-1][both], y[:, 1:][both]), 1)
        observed = np.concatenate([y[real] @ rows, counts.ravel()])
        m, v, total = np.zeros_like(theta), np.zeros_like(theta), real.sum()
        for step in range(1, rounds + 1):
            follow = theta[k:].reshape(2, 2)
            emit = np.zeros((*y.shape, 2))
            emit[doc, line, 1] = rows @ theta[:k]
            forward, backward = emit.copy(), np.zeros(emit.shape)
            for t in range(1, longest):
                old = forward[: live[t], t - 1]
                forward[: live[t], t] += np.logaddexp(old[:, :1] + follow[0], old[:, 1:] + follow[1])
            norm = np.logaddexp.reduce(forward[np.arange(len(last)), last], axis=1)
            for t in range(longest - 2, -1, -1):
                ahead = (emit[:, t + 1] + backward[:, t + 1])[: live[t + 1]]
                backward[: live[t + 1], t] = np.logaddexp(ahead[:, :1] + follow[:, 0], ahead[:, 1:] + follow[:, 1])
            chance = np.exp(forward[doc, line, 1] + backward[doc, line, 1] - norm[doc])
            pair = forward[before, at, :, None] + follow + (emit + backward)[before, at + 1, None, :] - norm[before, None, None]
            pairs = np.exp(np.minimum(pair, 0.0)).sum(axis=0)
            gradient = (observed - np.concatenate([chance @ rows, pairs.ravel()])) / total - decay * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(theta[:k], theta[k:].reshape(2, 2))


def sequences(documents: list[tuple[np.ndarray, int]], lines: int = SEQUENCE_LINES, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of lines: all lines of all documents (features and label of each), in sequences of at most
    ``lines``, and per sequence of a bad document a mixed one, lines of a good document put between its lines."""
    pure = []
    for x, label in documents:
        y = np.where(x[:, 1] > 0, 0, int(label > 0))
        pure += [(x[k : k + lines], y[k : k + lines], label > 0) for k in range(0, len(x), lines)]
    good, bad = [p for p in pure if p[2]], [p for p in pure if not p[2]]
    rng, mixed = np.random.default_rng(seed), []
    first = FEATURES.index("first line")
    for x, y, _ in bad if good else []:
        other, labels, _ = good[rng.integers(len(good))]
        begin, cut = rng.integers(len(other)), rng.integers(len(x) + 1)
        end = begin + 1 + rng.integers(len(other) - begin)
        rows = np.concatenate([x[:cut], other[begin:end], x[cut:]])
        rows[:, first] = 0
        rows[0, first] = 1
        mixed.append((rows, np.concatenate([y[:cut], labels[begin:end], y[cut:]])))
    return [(x, y) for x, y, _ in pure] + mixed


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", documents: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit the field on at most ``documents`` labelled documents of ``docs``, chosen by the hash of their id, whole texts.

    Of labels that disagree the lower counts; null labels are left out. Of texts that share an id one counts, the same
    in every run.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = chosen.join(texts.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in slices(batches):
            made = [line_features(t)[0].astype(np.float32).tobytes() for t in own]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(made, pa.binary())], ["id", "label", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.join(chosen, "id").select("id", "label", "text").mapInArrow(run, f"id {kind}, label int, features binary")
    one = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("features").alias("features"))
    found = sorted((r.id, r.label, bytes(r.features)) for r in one.collect())  # bounded by documents
    return Field.fit(sequences([(np.frombuffer(blob, np.float32).reshape(-1, len(FEATURES)).astype(np.float64), label) for _, label, blob in found]))


def measure(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """Counts and verdict of every document; one row per row of ``docs``.

    Returns (id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_content_lines,
    content_words, base_failed, kept). Words are runs of other characters than ASCII white space; lines are split at
    \\n and count if they have a word.

    Null, empty and blank texts have no words, fail the plain rules and are not kept. Repeated rows each get a row,
    null ids are passed on, very long texts are read whole. No documents give no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines", "content_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows, lists = [], [t.split() for t in texts]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            repeats = repeated_words(codes([w for x in lists for w in x])[0], bounds).tolist()
            for text, chars, words, repeat in zip(texts, batch.column("chars").to_pylist(), lists, repeats, strict=True):
                features, sizes, again = line_features(text)
                labels = field.decode(features)
                rows.append((len(words), chars - (len(text) - len(text.translate(None, SPACE))), len(text) - len(text.translate(None, SYMBOLS)), again, repeat, len(sizes), sum(labels), sum(n for n, y in zip(sizes, labels, strict=True) if y)))
            columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
            failed = (columns[0] < MIN_WORDS) | (100 * columns[4] > MAX_REPEATED * columns[0])
            kept = ~failed & (columns[7] >= share * columns[0])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), *map(pa.array, columns), pa.array(failed), pa.array(kept)], ["id", "text_hash", *names, "base_failed", "kept"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.length(text).alias("chars"), text.alias("text"))
    return rows.mapInArrow(run, f"id {kind}, text_hash long, {', '.join(n + ' long' for n in names)}, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, field: Field, text_col: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass and without a join."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_col):
            good = []
            bounds = np.concatenate([[0], np.cumsum([len(t.split()) for t in texts])]).astype(np.int64)
            repeats = repeated_words(codes([w for t in texts for w in t.split()])[0], bounds)
            for text, n, repeat in zip(texts, np.diff(bounds).tolist(), repeats.tolist(), strict=True):
                ok = n >= MIN_WORDS and 100 * repeat <= MAX_REPEATED * n
                if ok:
                    features, sizes, _ = line_features(text)
                    ok = sum(s for s, y in zip(sizes, field.decode(features), strict=True) if y) >= share * n
                good.append(ok)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
