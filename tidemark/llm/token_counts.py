"""Token counts under a unigram model, with scores shared along a trie of pre-tokens.

A pre-token is a word of the text with a space before it. Its tokens are the division into pieces of a public
vocabulary with the best total score; a piece scores the logarithm of its share under Zipf's law at its rank in the
vocabulary's file, so nothing is trained. All single bytes are pieces, so every text has a division.

The distinct pre-tokens of a slice of documents are laid into a trie, level by level and all words at once. The best
score up to a node depends on its prefix alone, so it is worked out once per node, for all words below it; the pieces
that end at a node are followed down a trie of the vocabulary at the same time. What is kept is the number of tokens
of each word, at the node where it ends. Slices are counted where they lie, without a shuffle; counts of words are
remembered from slice to slice up to a bound.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices, word_lists

#: Words whose counts a worker remembers.
MEMORY_WORDS = 1_000_000
#: Bytes of all words that are laid into one trie.
TRIE_BYTES = 1 << 20


class Vocabulary:
    """Pieces of a rank file (base64 of the bytes, then the rank) as a trie, with their scores."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        pieces = {p: r for p, r in ranks.items() if not any(c in b" \t\n\v\f\r" for c in p[1:]) and p[:1] not in (b"\t", b"\n", b"\v", b"\f", b"\r")}
        self.longest = max(map(len, pieces))
        total = np.log(sum(1 / (r + 1) for r in ranks.values()))
        self.score_of = {p: float(-np.log(r + 1) - total) for p, r in pieces.items()}
        nodes: dict[int, int] = {}
        scores = [-np.inf]
        for p in sorted(self.score_of):
            at = 0
            for b in p:
                key = at * 256 + b
                if key not in nodes:
                    nodes[key] = len(scores)
                    scores.append(-np.inf)
                at = nodes[key]
            scores[at] = self.score_of[p]
        keys = np.array(sorted(nodes), np.int64)
        self.keys, self.to = keys, np.array([nodes[k] for k in keys.tolist()], np.int64)
        self.scores = np.array(scores)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Node of the vocabulary's trie after one more byte; 0 where there is none."""
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], 0)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def memory(path: str) -> dict[bytes, int]:
    """One memory per worker process, which serves many tasks."""
    return {}


def trie_counts(words: list[bytes], vocab: Vocabulary) -> np.ndarray:
    """Number of tokens of each of the distinct ``words``, which must be sorted. Of equally good divisions the one
    with the longest last piece wins, at every node.

    A node is known by the first word below it. ``best`` and ``count`` hold, per word and depth, what its node at that
    depth has; they are worked out for first words only and copied to the others.
    """
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    depth = int(sizes.max())
    grid = np.zeros((n, depth), np.int64)
    grid[np.repeat(np.arange(n), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.frombuffer(b"".join(words), np.uint8)
    same = (grid[1:] == grid[:-1]) & (np.arange(depth) < np.minimum(sizes[1:], sizes[:-1])[:, None])
    shared = np.concatenate([[0], np.where(same.all(axis=1), depth, np.argmin(same, axis=1))])
    best, count = np.zeros((n, depth + 1)), np.zeros((n, depth + 1), np.int64)
    reach = min(vocab.longest, depth)
    # piece[:, k]: node of the vocabulary's trie for the last k bytes; 0 where they begin no piece
    piece = np.zeros((n, reach + 1), np.int64)
    rows = np.arange(n)
    for d in range(1, depth + 1):
        rows = rows[sizes[rows] >= d]
        new = rows[shared[rows] < d]
        byte = grid[new, d - 1]
        fresh = np.zeros((len(new), reach + 1), np.int64)
        top = min(d, reach)
        old = piece[new, :top]
        live = old > 0
        live[:, 0] = True
        i, k = np.nonzero(live)
        fresh[i, k + 1] = vocab.step(old[i, k], byte[i])
        score = np.full((len(new), top), -np.inf)
        i, k = np.nonzero(fresh[:, 1 : top + 1])
        score[i, top - 1 - k] = best[new[i], d - 1 - k] + vocab.scores[fresh[i, k + 1]]  # longest piece first
        choice = np.argmax(score, axis=1)
        at = np.arange(len(new))
        owner = np.cumsum(shared[rows] < d) - 1
        piece[rows] = fresh[owner]
        best[rows, d] = score[at, choice][owner]
        count[rows, d] = (count[new, d - top + choice] + 1)[owner]
    return count[np.arange(n), sizes]


def learn(words: list[bytes], known: dict[bytes, int], vocab: Vocabulary) -> None:
    """Put the counts of new words into ``known``. Words of like length share tries of bounded size."""
    new = sorted((b" " + w for w in words if w not in known), key=lambda w: (len(w) > 24, len(w) if len(w) > 24 else 0, w))
    begin = 0
    while begin < len(new):
        end, longest = begin, 0
        while end < len(new) and (end - begin + 1) * max(longest, len(new[end])) <= max(TRIE_BYTES, len(new[begin])):
            longest = max(longest, len(new[end]))
            end += 1
        own = sorted(new[begin:end])
        known.update((w[1:], c) for w, c in zip(own, trie_counts(own, vocab).tolist(), strict=True))
        begin = end


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, n_pretokens, n_tokens): one row per row of ``docs``.

    White space is that of ASCII and is itself no token. Null, empty and blank texts have no tokens; the characters of
    a null text are 0. Repeated rows each get a row, null ids are passed on, very long texts and words are read whole.
    No documents give no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(vocabulary_path), memory(vocabulary_path)
        for batch, texts in slices(batches):
            words, bounds = word_lists(texts)
            number, distinct = codes(words)
            if len(known) + len(distinct) > MEMORY_WORDS:
                known.clear()
            learn(distinct, known, vocab)
            sums = np.concatenate([[0], np.cumsum(np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))[number])])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_chars"), pa.array(np.diff(bounds)), pa.array(np.diff(sums[bounds]))], ["id", "n_chars", "n_pretokens", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"), text.alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_chars long, n_pretokens long, n_tokens long")
