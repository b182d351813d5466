"""Packing of token streams into training sequences by order-preserving dynamic programming.

The documents of a block are laid end to end. A cut may fall where a document ends, where a sentence ends, or, inside
a stretch without either that is longer than a sequence, at every full sequence from the stretch's start. A choice of
cuts costs the padding of its sequences plus a penalty for each cut inside a document. The cheapest choice up to a cut
is the least over the earlier cuts within one sequence length; as padding is linear in that cut's position, a monotone
queue holds the only earlier cuts that can still win, and each cut enters and leaves it once.

A sequence whose length is a power of two needs no padding; such steps back from a cut are looked up apart, at a small
fixed price each, so that short sequences are used for the rest of a block and not instead of full ones.

Blocks are bounded in tokens and end at a document, so a task holds one block; only the last sequence of a block can
come out much shorter than the others. There is no shuffle: each task packs the documents it reads, in their order.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices, word_lists

LENGTH = 2048
END_ID = 1
#: Padding tokens that a cut at a sentence end, or within a sentence, weighs as much as.
SENTENCE_PENALTY = 4.0
BROKEN_PENALTY = 64.0
#: The same for a sequence shorter than the full length that needs no padding.
SHORT_PENALTY = 48.0
BLOCK_TOKENS = 4 << 20
#: Words whose ids a task remembers.
MEMORY_WORDS = 700_000
#: Last bytes of a word that ends a sentence: full stop, exclamation and question mark.
STOPS = frozenset(b".!?")
#: Signs that end up apart from the letters before them.
SIGNS = b".,!?%&*$#;:|"
#: Words that the merge list alone divides: lower-case letters that no normalisation changes.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
WORD_END = b"\xff"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def merger(path: str):
    """(function, ids): merges the bytes of one plain lower-case word by the vocabulary's own merge list.

    Several times faster than the tokenizer and without its call overhead. The word's end is written as a byte that no
    UTF-8 text holds; ``ids`` holds the vocabulary's id, packed, of each rank that the function returns.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    shown = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    suffix = model["end_of_word_suffix"]

    def raw(token: str) -> bytes:
        return bytes(shown[c] for c in token.removesuffix(suffix)) + WORD_END * token.endswith(suffix)

    ids = {raw(token): i for token, i in model["vocab"].items()}
    ranks = {bytes([b]): b for b in range(256)}
    merged = (raw("".join(x if isinstance(x, list) else x.split(" "))) for x in model["merges"])
    for token in (*(x for x in ids if len(x) == 2 and x.endswith(WORD_END)), *merged):
        ranks.setdefault(token, len(ranks))
    table = [ids.get(token, 0).to_bytes(4, "little") for token in ranks]
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece, table


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One memory per worker process, which serves many tasks."""
    return WordIds(path)


class WordIds(dict):
    """Packed ids (unsigned 32-bit) by word, remembered up to a bound.

    The vocabulary's tokenizer splits at white space and drops it, so a text's ids are its words' ids one after
    another. A run of letters and a run of signs after it are apart for the tokenizer, too. White space of other kinds
    within a word, and all words but plain ones, are left to the tokenizer. ASCII capitals are lowered before the
    lookup, as the tokenizer does itself, unless the text may hold the string of a special token.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        self.merge, self.table = merger(path)

    def __missing__(self, word: bytes) -> bytes:
        head = word.rstrip(SIGNS)
        if head == word or not head:
            ids = self._ids(word)
        else:
            tail = word[len(head) :]
            ids = self[head] + self[tail] if PLAIN.fullmatch(head.decode("utf-8", "replace")) else self._ids(word)
        self[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text):
            return b"".join([self.table[i] for i in self.merge(word + WORD_END)])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, and after how many of them its sentences end."""
        if len(self) > MEMORY_WORDS:
            self.clear()
        words, bounds = word_lists([x if b"<|" in x else x.lower() for x in texts])
        number, distinct = codes(words)
        packed = list(map(self.__getitem__, distinct))
        size = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        flat, first = np.frombuffer(b"".join(packed), "<u4"), np.cumsum(size) - size
        sizes = size[number]
        done = np.cumsum(sizes)
        ids = flat[np.repeat(first[number] - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)]
        stops = np.fromiter((w[-1] in STOPS for w in distinct), bool, len(distinct))[number]
        done = np.concatenate([[0], done])
        ends, at = done[1:][stops], done[bounds]
        some = np.searchsorted(np.flatnonzero(stops), bounds)
        return [(ids[at[i] : at[i + 1]], ends[some[i] : some[i + 1]] - at[i]) for i in range(len(texts))]


def cut_points(doc_ends: np.ndarray, sentence_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may fall, 0 first, and the penalty of each."""
    soft = np.unique(np.concatenate([[0], doc_ends, sentence_ends])).astype(np.int64)
    gaps = np.diff(soft)
    far = np.flatnonzero(gaps > length)
    hard = [np.arange(soft[i] + length, soft[i + 1], length) for i in far.tolist()]
    at = np.unique(np.concatenate([soft, *hard])).astype(np.int64)
    penalty = np.full(len(at), BROKEN_PENALTY)
    penalty[np.isin(at, sentence_ends)] = SENTENCE_PENALTY
    penalty[np.isin(at, doc_ends)] = 0.0
    penalty[0] = 0.0
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """Indices into ``at`` of the cuts of the cheapest division; the first and the last place are always cut.

    Of equally cheap divisions the one with the earlier previous cut, so the longer sequence, wins.
    """
    n = len(at)
    powers = [p for p in (1 << k for k in range(length.bit_length())) if p < length]
    steps = []
    for p in powers:  # for each cut, the cut just p before it
        j = np.searchsorted(at, at - p)
        steps.append(np.where((at - p >= 0) & (at[np.minimum(j, n - 1)] == at - p), j, -1))
    short = np.stack(steps, axis=1) if steps else np.full((n, 1), -1)
    has_short = (short >= 0).any(axis=1).tolist()
    place, price = at.tolist(), penalty.tolist()
    best, back = [0.0] * n, [0] * n
    queue, values, head = [0], [0.0], 0  # cuts by rising place and rising best + place
    for j in range(1, n):
        here = place[j]
        low = here - length
        while place[queue[head]] < low:
            head += 1
        cost, previous = values[head] + length - here, queue[head]
        if has_short[j]:
            for i in short[j].tolist():
                if i >= 0 and best[i] + SHORT_PENALTY < cost:
                    cost, previous = best[i] + SHORT_PENALTY, i
        cost += price[j]
        best[j], back[j] = cost, previous
        value = cost + here
        while len(queue) > head and values[-1] > value:
            queue.pop()
            values.pop()
        queue.append(j)
        values.append(value)
        if head > 4096:
            del queue[:head], values[:head]
            head = 0
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def pack_block(ids: list[np.ndarray], sentence_ends: list[np.ndarray], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """(document, start, length, crc32, sequence, offset) of each piece of a block of documents, each with its end id."""
    sizes = np.array([len(x) for x in ids], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at, penalty = cut_points(ends, np.concatenate([e + s for e, s in zip(sentence_ends, starts.tolist(), strict=True)]), length)
    cuts = at[best_cuts(at, penalty, length)]
    edges = np.union1d(cuts, ends)
    edges = edges[edges > 0]
    begins = np.concatenate([[0], edges[:-1]])
    doc = np.searchsorted(ends, begins, side="right")
    sequence = np.searchsorted(cuts, begins, side="right") - 1
    rows = []
    for a, b, d, s in zip(begins.tolist(), edges.tolist(), doc.tolist(), sequence.tolist(), strict=True):
        x = int(starts[d])
        rows.append((d, a - x, b - a, zlib.crc32(ids[d][a - x : b - x].astype("<u4").tobytes()), s, a - int(cuts[s])))
    return rows


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens (a power of two).

    Returns (id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece. ``vocabulary`` is the
    path of a tokenizer file whose words are separated by white space that it drops. A document is its text's ids and
    then the end id; each of its ids lies in exactly one piece. Sequence ids are unique over the result and are
    numbered within each task.

    A null or empty text is its end id alone. Repeated rows and repeated or null ids are packed as documents of their
    own. A text longer than a block is a block. No documents give no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sequence = word_ids(vocabulary), TaskContext.get().partitionId() << 40
        owners, ids, ends, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal sequence
            rows = pack_block(ids, ends, length)
            sizes = [len(ids[r[0]]) for r in rows]
            columns = list(zip(*rows, strict=True))
            owner = pa.concat_arrays(owners).take(pa.array(columns[0], pa.int64()))
            arrays = [owner, *(pa.array(columns[k], pa.int64()) for k in (1, 2, 3)), pa.array(sizes, pa.int64()), pa.array([sequence + s for s in columns[4]], pa.int64()), pa.array(columns[5], pa.int64())]
            sequence += rows[-1][4] + 1
            return pa.RecordBatch.from_arrays(arrays, ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch, texts in slices(batches):
            owners.append(batch.column("id"))
            for own, sentences in words.encode(texts):
                ids.append(np.append(own, np.uint32(END_ID)))
                ends.append(sentences)
                held += len(own) + 1
            if held >= BLOCK_TOKENS:
                yield block()
                owners, ids, ends, held = [], [], [], 0
        if ids:
            yield block()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
