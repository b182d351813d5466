"""Exact repeats of word sequences across documents, found by difference-cover anchors.

A difference cover D of a period p holds, for every distance, two residues at that distance. So for any two equal
stretches there is a shift below p that brings both their positions onto residues of D at once. Hashing short windows
at positions whose residue lies in D is therefore enough: two equal windows of ``window`` words share an anchor of
``window - p + 1`` words at the same place, wherever they lie. With p = 13 and D = {0, 1, 3, 9} that is 4 positions
out of 13.

1. Anchors: each task hashes the anchors of its documents and sends them, packed by hash bucket, to the bucket's task,
   which returns the positions whose anchor occurs again.
2. Extension: only windows that hold such a position are hashed in full, in 128 bits, and sent to the task of their
   bucket, which finds the first place of each window and returns all later ones.
3. The words under returned windows go.

What repeats within one slice of documents is merged before it is sent, so a passage in a third of all documents
arrives once per slice, not once per document. Hits go to buckets by id and text together, so copies of one text spread
over all of them, and the number of buckets grows with the bytes of text. No pairs of documents are formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bucket_count, codes, prepare, slices, word_lists

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text whose repeats are merged before they are sent.
MERGE_BYTES = 8 << 20
#: Bytes of text for each bucket of an exchange, on average.
BUCKET_BYTES = 8 << 20
#: Stands for a null id, which so comes first.
NO_ID = -(1 << 63)
PACKED = "bucket int, docs binary, counts binary, starts binary, hashes binary, others binary"


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    number, distinct = codes(words)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))[number]


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words, at the place of the first."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= BASE
        out += hashes[k : k + n]
    return out ^ (out >> np.uint64(29))


def local_starts(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts laid end to end: text and global position of each window of ``size`` words within one text."""
    count = np.maximum(np.diff(bounds) - size + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    return doc, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + bounds[:-1][doc]


def pack(bucket: np.ndarray, n_buckets: int, docs: np.ndarray, starts: np.ndarray, *hashes: np.ndarray) -> pa.RecordBatch:
    """One row per bucket, without hashes for positions that are known to be hits.

    ``docs`` (two numbers each) are stored once per run, ``starts`` as 32 bits.
    """
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    rows = []
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[k] : edges[k + 1]]
        d = docs[own]
        run = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]).any(axis=1)]))
        blobs = [d[run], np.diff(np.append(run, len(own))).astype(np.uint32), starts[own].astype(np.uint32), *(h[own] for h in hashes)]
        rows.append((k, *(x.tobytes() for x in blobs), *[b""] * (2 - len(hashes))))
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    kinds = [pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in PACKED.split(", ")])


def unpack(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """docs (two numbers each) and starts of a bucket's rows together."""
    docs, counts, starts = (b"".join(group.column(c).to_pylist()) for c in ("docs", "counts", "starts"))
    return np.repeat(np.frombuffer(docs, np.int64).reshape(-1, 2), np.frombuffer(counts, np.uint32), axis=0), np.frombuffer(starts, np.uint32)


def sent_and_known(group: pa.Table) -> tuple[pa.Table, pa.Table]:
    known = pc.equal(pc.binary_length(group.column("hashes")), 0)
    return group.filter(pc.invert(known)), group.filter(known)


def hash_array(group: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(column).to_pylist()), kind)


def by_document(docs: np.ndarray, starts: np.ndarray) -> pa.Table:
    """(id, key, starts): positions packed by document."""
    order = np.lexsort((starts, docs[:, 1], docs[:, 0]))
    docs, starts = docs[order], starts[order].astype(np.uint32)
    run = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]).any(axis=1)])) if len(docs) else np.zeros(0, np.int64)
    ends = np.append(run[1:], len(docs))
    return pa.table({"id": pa.array(docs[run, 0], pa.int64()), "key": pa.array(docs[run, 1], pa.int64()), "starts": pa.array([starts[a:b].tobytes() for a, b in zip(run, ends, strict=True)], pa.binary())})


def keys_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "key")])


def homes(docs: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of each document, by its id and key together: copies under different ids do not share one."""
    x = (docs[:, 0].astype(np.uint64) * BASE) ^ docs[:, 1].astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) % np.uint64(n_buckets)


def one_each(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[pa.RecordBatch, list[bytes]]:
    """A slice with one of the rows that repeat an id and a text; none of them is earlier than the other."""
    _, first = np.unique(keys_of(batch), axis=0, return_index=True)
    if len(first) == len(texts):
        return batch, texts
    first.sort()
    return batch.take(pa.array(first)), [texts[k] for k in first.tolist()]


def anchor_rows(batch: pa.RecordBatch, texts: list[bytes], window: int, n_buckets: int) -> list[pa.RecordBatch]:
    """Anchors of a slice, packed: one of those equal within the slice with its hash, all that repeat as known hits."""
    words, bounds = word_lists(texts)
    size = window - PERIOD + 1
    doc, at = local_starts(bounds, size)
    keep = np.isin((at - bounds[:-1][doc]) % PERIOD, COVER)
    doc, at = doc[keep], at[keep]
    hashes = rolling(word_hashes(words, 7), size)[at]
    docs, starts = keys_of(batch)[doc], at - bounds[:-1][doc]
    _, first, number, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    first.sort()
    hit = count[number] > 1
    bucket = (hashes[first] >> np.uint64(32)) % np.uint64(n_buckets)
    return [pack(bucket, n_buckets, docs[first], starts[first], hashes[first].astype(np.uint32)), pack(homes(docs[hit], n_buckets), n_buckets, docs[hit], starts[hit])]


def shared_anchors(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of a bucket's anchors that occur again."""
    sent, known = sent_and_known(group)
    docs, starts = unpack(sent)
    _, number, count = np.unique(hash_array(sent, "hashes", np.uint32), return_inverse=True, return_counts=True)
    hit = count[number] > 1
    more, others = unpack(known)
    return np.concatenate([docs[hit], more]), np.concatenate([starts[hit], others])


def candidate_windows(starts: list[bytes], bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and global position of the windows that hold one of the anchors."""
    total = int(bounds[-1])
    step = np.zeros(total + 1, np.int64)
    for i, blob in enumerate(starts):
        anchors = np.frombuffer(blob, np.uint32).astype(np.int64)
        low, last = int(bounds[i]), int(bounds[i + 1]) - window
        if last < low:
            continue
        np.add.at(step, np.maximum(anchors - (PERIOD - 1), 0) + low, 1)
        np.add.at(step, np.minimum(anchors + low, last) + 1, -1)
    inside = np.cumsum(step[:total]) > 0
    doc, at = local_starts(bounds, window)
    keep = inside[at]
    return doc[keep], at[keep]


def not_first(one: np.ndarray, two: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks windows that begin later than an equal one."""
    order = np.lexsort((starts, docs[:, 0], two, one))
    new = np.concatenate([[True], (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)]) if len(order) else np.zeros(0, bool)
    head = np.empty_like(order)
    head[order] = order[new][np.cumsum(new) - 1]
    return (docs[head, 0] != docs[:, 0]) | (starts[head] != starts)


def window_rows(batch: pa.RecordBatch, texts: list[bytes], window: int, n_buckets: int) -> list[pa.RecordBatch]:
    """Candidate windows of a slice, packed: the first of those equal within the slice with its hash, all others,
    which surely are not first, as known hits."""
    words, bounds = word_lists(texts)
    doc, at = candidate_windows(batch.column("starts").to_pylist(), bounds, window)
    one, two = (rolling(word_hashes(words, seed), window)[at] for seed in (11, 13))
    docs, starts = keys_of(batch)[doc], at - bounds[:-1][doc]
    later = not_first(one, two, docs, starts)
    head = ~later
    bucket = (one[head] >> np.uint64(32)) % np.uint64(n_buckets)
    return [pack(bucket, n_buckets, docs[head], starts[head], one[head], two[head]), pack(homes(docs[later], n_buckets), n_buckets, docs[later], starts[later])]


def later_windows(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of a bucket's windows that begin earlier elsewhere."""
    sent, known = sent_and_known(group)
    docs, starts = unpack(sent)
    later = not_first(hash_array(sent, "hashes", np.uint64), hash_array(sent, "others", np.uint64), docs, starts)
    more, others = unpack(known)
    return np.concatenate([docs[later], more]), np.concatenate([starts[later], others])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def places(packed: DataFrame, find, n_buckets: int) -> DataFrame:
    """(id, key, starts): what ``find`` returns of each bucket, one row per document.

    A bucket returns one packed row for each bucket of documents, not one for each document.
    """

    def found(key: tuple, group: pa.Table) -> pa.Table:
        docs, starts = find(group)
        return pa.Table.from_batches([pack(homes(docs, n_buckets), n_buckets, docs, starts)])

    def merged(key: tuple, group: pa.Table) -> pa.Table:
        return by_document(*unpack(group))

    return packed.groupBy("bucket").applyInArrow(found, PACKED).groupBy("bucket").applyInArrow(merged, "id long, key long, starts binary")


def later_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, key, starts): word positions where a window begins whose words also begin earlier, packed as unsigned
    32-bit numbers; one row per document that has some; ``key`` is the hash of the text."""
    if window < PERIOD:
        raise ValueError(f"windows need at least {PERIOD} words")
    spark = docs.sparkSession
    prepare(spark)
    rows = keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = max(bucket_count(spark), math.ceil(size / BUCKET_BYTES))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=MERGE_BYTES):
            yield from anchor_rows(*one_each(batch, texts), window, n)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=MERGE_BYTES):
            yield from window_rows(*one_each(batch, texts), window, n)

    found = places(rows.mapInArrow(anchors, PACKED), shared_anchors, n)
    return places(rows.join(found, ["id", "key"]).mapInArrow(windows, PACKED), later_windows, n)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove the words under every window of ``window`` words that also begins earlier.

    Earlier means a smaller id, or the same id and an earlier start. Returns (id, n_words, n_removed, kept): one row
    per row of ``docs``, the kept words joined by one space.

    A null text, an empty text and one of white space have no words and an empty result. Texts shorter than the
    window keep all words. Rows that repeat an id are judged by the same order: of equal windows at the same start
    under the same id none is earlier than the other, so both stay unless an earlier one exists. Null ids come first
    and count as one id; they are returned as null. No documents give no rows. Other columns are not looked at.
    """
    later = later_repeats(docs, id_col, text_col, window)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids, n_words, n_removed, kept = batch.column("id"), [], [], []
            for text, blob in zip(texts, batch.column("starts").to_pylist(), strict=True):
                words = text.split()
                n_words.append(len(words))
                if blob:
                    starts = np.frombuffer(blob, np.uint32).astype(np.int64)
                    step = np.bincount(starts, minlength=len(words) + 1) - np.bincount(np.minimum(starts + window, len(words)), minlength=len(words) + 1)
                    gone = np.cumsum(step[: len(words)]) > 0
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([pc.if_else(pc.equal(ids, NO_ID), None, ids), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])

    return keyed(docs, id_col, text_col).join(later, ["id", "key"], "left").mapInArrow(clean, "id long, n_words long, n_removed long, kept string")


def removed_by_definition(docs: list[tuple[int, str]], window: int = WINDOW) -> dict[int, str]:
    """The kept text of each document by the definition itself, for tests on small inputs."""
    words = {i: (t or "").encode().split() for i, t in docs}
    first: dict[tuple, tuple[int, int]] = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), (i, s))
    out = {}
    for i, w in words.items():
        gone = {k for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] != (i, s) for k in range(s, s + window)}
        out[i] = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
    return out
