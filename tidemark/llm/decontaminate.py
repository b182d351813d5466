"""Benchmark decontamination by greedy string tiling.

Words are compared in lower case (A-Z) without signs around them; words made of signs alone count on neither side. A
document and a test item that share a seed, a run
of ``least`` words, are tiled: the longest run of words common to both and not yet marked is marked in both, again and
again, until none of ``least`` words is left. The share of the item's words under tiles is its coverage. As tiles may
lie in any order, passages that were cut up and put together anew are found, too.

The items are a stated query set: blocks of them, bounded in words, are sent to every task, and each document is read
once per block where it lies. So no document is shuffled, and a passage in a third of all documents costs each of
them the same. Seeds are looked up for a whole slice of documents at once; only pairs that share one are tiled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices, spare, word_lists

LEAST = 5
COVERAGE = 0.6
#: Words of test items in one block.
BLOCK_WORDS = 1_000_000
SIGNS = b".,;:!?\"'()[]{}<>|#*$%&-"
BASE = np.uint64(0x9E3779B97F4A7C15)
PRIME, RADIX = (1 << 61) - 1, 1_000_003


def plain(word: bytes) -> bytes:
    return word.strip(SIGNS)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for k in range(1, size):
        out *= BASE
        out += values[k : k + n]
    return out


def spread(numbers: np.ndarray) -> np.ndarray:
    """Numbers of words as well-mixed 64-bit values."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


class Items:
    """A block of test items, with their seeds."""

    def __init__(self, rows: list[tuple], least: int) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.words, self.size = [], [], []
        seeds: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in rows:
            words = [w for w in map(plain, text.lower().split()) if w]
            if not words:
                continue
            own = np.array([self.number.setdefault(w, len(self.number)) for w in words])
            size, item = min(least, len(own)), len(self.ids)
            for h in rolling(spread(own), size).tolist():
                seeds[size][h].add(item)
            self.ids.append(item_id)
            self.words.append(own.tolist())
            self.size.append(size)
        #: per seed length: sorted seeds, and the items of each
        self.seeds = {}
        for size, by_hash in seeds.items():
            keys = sorted(by_hash)
            self.seeds[size] = (np.array(keys, np.uint64), [sorted(by_hash[k]) for k in keys])

    def matches(self, texts: list[bytes], coverage: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, coverage, tiles, longest tile) of pairs with enough coverage."""
        words, bounds = word_lists([x.lower() for x in texts])
        number, distinct = codes(words)
        bare = [plain(w) for w in distinct]
        known = np.fromiter((self.number.get(w, -1) for w in bare), np.int64, len(bare))
        there = np.fromiter(map(bool, bare), bool, len(bare))[number]
        values = known[number][there]
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))[there]
        strays = np.concatenate([[0], np.cumsum(values < 0)])
        mixed = spread(np.maximum(values, 0))
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size, (keys, owners) in self.seeds.items():
            at = np.flatnonzero((strays[size:] == strays[:-size])[: max(len(values) - size + 1, 0)]) if len(values) >= size else np.zeros(0, np.int64)
            at = at[doc[at] == doc[at + size - 1]]
            if not len(at):
                continue
            hashes = rolling(mixed, size)[at]
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[place] == hashes
            for k, p in zip(at[hit].tolist(), place[hit].tolist(), strict=True):
                for item in owners[p]:
                    found[int(doc[k]), item].append(k)
        for (text, item), at in sorted(found.items()):
            tiles = tile(self.words[item], segments(values, at, self.size[item]), self.size[item])
            share = sum(tiles) / len(self.words[item])
            if share >= coverage:
                yield text, item, share, len(tiles), max(tiles)


def segments(values: np.ndarray, at: list[int], size: int) -> list[list[int]]:
    """The stretches of a document that its seeds cover; every common run of ``size`` words lies in one of them."""
    out, begin, end = [], at[0], at[0] + size
    for k in at[1:]:
        if k >= end - size + 2:  # not the next seed: no common run crosses this place
            out.append(values[begin:end].tolist())
            begin = k
        end = k + size
    return [*out, values[begin:end].tolist()]


def tile(item: list[int], parts: list[list[int]], least: int) -> list[int]:
    """Lengths of the tiles of ``item`` and a document given in parts, longest first in each round.

    Running Karp-Rabin: windows of a search length are hashed over unmarked words and looked up; matches are extended,
    and the search length shrinks from the longest possible to ``least``. Of equally long matches the one earlier in
    the item, then in the document, is marked first.
    """
    free_item, free = [True] * len(item), [[True] * len(p) for p in parts]
    tiles: list[int] = []
    size = max(least, min(len(item), max(map(len, parts))))
    while True:
        found = scan(item, free_item, parts, free, size)
        if found and found[0][0] > 2 * size:
            size = found[0][0]
            continue
        cut = False
        for length, i, p, j in found:
            if all(free_item[i : i + length]) and all(free[p][j : j + length]):
                free_item[i : i + length] = [False] * length
                free[p][j : j + length] = [False] * length
                tiles.append(length)
            else:
                cut = True
        if cut:
            continue  # what is left of matches cut short is found with the same length
        if size == least or not any(free_item):
            return tiles
        size = max(least, size // 2)


def windows(words: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of every window of unmarked words, the hash rolling along."""
    drop, value, run = pow(RADIX, size, PRIME), 0, 0
    for k, w in enumerate(words):
        if not free[k]:
            value = run = 0
            continue
        value = value * RADIX + w + 1
        if run == size:
            value -= (words[k - size] + 1) * drop
        else:
            run += 1
        value %= PRIME
        if run == size:
            yield value, k - size + 1


def scan(item: list[int], free_item: list[bool], parts: list[list[int]], free: list[list[bool]], size: int) -> list[tuple[int, int, int, int]]:
    """(length, item start, part, start) of all maximal matches of at least ``size`` unmarked words, longest first."""
    table = defaultdict(list)
    for h, i in windows(item, free_item, size):
        table[h].append(i)
    out = []
    for p, words in enumerate(parts):
        for h, j in windows(words, free[p], size):
            for i in table.get(h, ()):
                if i and j and free_item[i - 1] and free[p][j - 1] and item[i - 1] == words[j - 1]:
                    continue  # part of a match that begins earlier
                n = 0
                while i + n < len(item) and j + n < len(words) and item[i + n] == words[j + n] and free_item[i + n] and free[p][j + n]:
                    n += 1
                if n >= size:
                    out.append((n, i, p, j))
    return sorted(out, key=lambda m: (-m[0], *m[1:]))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, item, coverage, n_tiles, longest_tile): documents that hold at least ``coverage`` of an item's words.

    An item of fewer than ``least`` words must be held whole, as one tile. Items without words, null or empty texts on
    either side never match. Repeated rows on either side each give their pairs; null ids are passed on. Very long
    texts are read whole. Empty tables give no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    item_text = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    items = benchmark.select(F.col(item_col).alias("item"), item_text.alias("text")).where("length(text) > 0")
    total = items.select(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = max(1, math.ceil(total / 5 / block_words))
    schema = f"id {kind}, item {item_kind}, coverage double, n_tiles long, longest_tile long"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # bounded by block_words
        held = spark.sparkContext.broadcast(Items([(r["item"], r["text"].encode()) for r in own], least))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches):
                pairs = list(held.value.matches(texts, coverage))
                if pairs:
                    text, item, *rest = zip(*pairs, strict=True)
                    ids = [held.value.ids[i] for i in item]
                    yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(pa.array(text)), "item": ids, **dict(zip(("coverage", "n_tiles", "longest_tile"), rest, strict=True))})

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns. Rows that share an id go or stay together;
    rows with a null id are judged as one. The ids that go are distinct before the join."""
    name = spare(docs, "_bad")
    bad = contaminated_pairs(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias(name)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
