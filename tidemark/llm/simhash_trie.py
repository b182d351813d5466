"""Near duplicates by SimHash: a binary trie joined with itself.

Fingerprints of 64 bits come from word shingles. Their trie is not stored: a sorted array of fingerprints is one, a
node being a range of it. The join walks pairs of nodes from the top, one bit at a time, adds up the bits in which the
two paths differ and drops a pair as soon as the sum exceeds the budget.

The join is spread over the cluster by bits that agree: with a budget of three, of four parts of a fingerprint at least
one is equal on both sides of a link. Each fingerprint goes to four groups, one for each part and its value, and each
group is a trie joined with itself. The number of copies does not grow with the data. A group that is too large for
a task is divided the same way by the bits that are still open, so only its own fingerprints are copied again. A task
takes many groups at once; pairs of nodes are held in blocks of bounded size. It keeps a union-find over its
fingerprints and returns one edge for each fingerprint it could link, not all links; equal fingerprints meet as one
row before the join. The components over all tasks are found by joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, prepare, slices, spare, word_lists
from tidemark.session import staged

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints of one group beyond which it is divided again.
GROUP_LIMIT = 1 << 18
#: Copies of fingerprints that a task takes, on average.
TASK_ROWS = 1 << 20
#: Pairs of nodes a task expands at a time.
BLOCK = 1 << 20


def fingerprints(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprint of each text as an unsigned number.

    A-Z become lower case; shingles of ``shingle`` words count as often as they occur; a shorter text is one shingle,
    a text without words has fingerprint zero. A bit is set if it is set in over half the shingle hashes.
    """
    words, bounds = word_lists([x.lower() for x in texts])
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(words) else ends
    first, counts = [], np.zeros(len(texts), np.int64)
    lengths = np.diff(bounds)
    full = np.maximum(lengths - shingle + 1, np.minimum(lengths, 1))
    counts[:] = full
    some = np.flatnonzero(full)
    if not len(some):
        return out
    # shingle numbers: begin at word i, end at word i + shingle - 1 or at the text's last word
    begin = np.repeat(bounds[some] - np.concatenate([[0], np.cumsum(full[some])[:-1]]), full[some]) + np.arange(full[some].sum())
    last = np.minimum(begin + shingle - 1, np.repeat(bounds[some + 1] - 1, full[some]))
    first = starts[begin].tolist()
    until = ends[last].tolist()
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, until, strict=True)), np.uint64, len(first))
    at = np.concatenate([[0], np.cumsum(full[some])[:-1]])
    raw = hashes.view(np.uint8).reshape(-1, 8)
    sums = np.empty((len(some), BITS), np.int64)
    for byte in range(8):  # little-endian: byte 0 holds the lowest bits
        bits = np.unpackbits(raw[:, byte : byte + 1], axis=1, bitorder="little")
        sums[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    over = 2 * sums > full[some][:, None]
    out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, key, fp): one row per document, the fingerprint as a signed long; key is the hash of the text."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(fingerprints(texts, shingle).view(np.int64))], ["id", "key", "fp"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text")).mapInArrow(run, f"id {kind}, key long, fp long")


class Links:
    """Union-find over the positions of an array, fed with blocks of links."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def flat(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return up
            self.root = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.flat()
            ra, rb = root[a], root[b]
            keep = ra != rb
            lo, hi = np.minimum(ra[keep], rb[keep]), np.maximum(ra[keep], rb[keep])
            a, b = hi, lo
            np.minimum.at(self.root, hi, lo)


def trie_join(left: np.ndarray, right: np.ndarray | None, depth: int, budget: int, spent: int, links: Links, offset: int, nodes: tuple[np.ndarray, np.ndarray] | None = None) -> None:
    """Walk two subtries together and link what lies within the budget.

    ``left`` and ``right`` are sorted and distinct, each below one node of ``depth`` bits whose paths differ in
    ``spent`` bits. With ``right`` None the subtrie is joined with itself. ``offset`` is where right's positions begin.
    ``nodes`` gives the ranges of ``left`` that are such subtries, each joined with itself only.
    """
    own = right is None
    right = left if own else right
    if not len(left) or not len(right):
        return
    lo, hi = nodes if nodes is not None else (np.array([0]), np.array([len(left)]))
    # a node is a range [lo, hi) of its array; a block holds pairs of nodes of one depth
    blocks = [(depth, lo[i : i + BLOCK], hi[i : i + BLOCK], *((lo[i : i + BLOCK], hi[i : i + BLOCK]) if own else (np.array([0]), np.array([len(right)]))), np.full(len(lo[i : i + BLOCK]), spent)) for i in range(0, len(lo), BLOCK)]
    while blocks:
        level, a0, a1, b0, b1, diff = blocks.pop()
        if level == BITS:
            links.add(a0, b0 + offset)
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - level)
        a_mid, b_mid = middle(left, a0, a1, bit), (middle(right, b0, b1, bit))
        out = []
        for xa, ya, xb, yb, step in ((a0, a_mid, b0, b_mid, 0), (a_mid, a1, b_mid, b1, 0), (a0, a_mid, b_mid, b1, 1), (a_mid, a1, b0, b_mid, 1)):
            keep = (xa < ya) & (xb < yb) & (diff + step <= budget)
            if own:  # of two mirrored pairs only the one whose first node comes first; a lone leaf with itself is done
                keep &= (xa < xb) | ((xa == xb) & (ya - xa > 1))
            out.append([x[keep] for x in (xa, ya, xb, yb)] + [diff[keep] + step])
        parts = [np.concatenate(x) for x in zip(*out, strict=True)]
        for i in range(0, len(parts[0]), BLOCK):
            blocks.append((level + 1, *(x[i : i + BLOCK] for x in parts)))


def middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """In each range, where the keys that have the bit begin."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        has = (keys[mid] & bit) != 0
        hi[open_[has]] = mid[has]
        lo[open_[~has]] = mid[~has] + 1


def join_groups(masks: np.ndarray, fps: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between fingerprints that agree in the bits of one mask, one for each linked one."""
    value = fps & masks
    order = np.lexsort((fps, value, masks))
    masks, value, fps = masks[order], value[order], fps[order]
    new = np.concatenate([[True], (masks[1:] != masks[:-1]) | (value[1:] != value[:-1])])[: len(fps)]
    stay = new | np.concatenate([[True], fps[1:] != fps[:-1]])[: len(fps)]
    fps, new = fps[stay], new[stay]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(fps))
    some = ends - starts > 1
    links = Links(len(fps))
    trie_join(fps, None, 0, budget, 0, links, 0, (starts[some], ends[some]))
    root = links.flat()
    own = np.flatnonzero(root != np.arange(len(fps)))
    return fps[own], fps[root[own]]


def divided(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` parts of its open bits added, each in turn."""
    bits = [b for b in range(BITS) if not mask >> b & 1]
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in bits[x:y]) for x, y in zip(edges, edges[1:], strict=False)]


def signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def grouped_by_parts(distinct: DataFrame, n: int, budget: int, limit: int) -> DataFrame:
    """(fp, mask): the groups of each fingerprint, a group being a mask and the bits under it.

    Two fingerprints within the budget share at least one group. Groups above ``limit`` are divided by their open
    bits until none is left, or so few bits are open that the group cannot be large.
    """
    parts = budget + 1

    def copied(rows: DataFrame, masks: list[int]) -> DataFrame:
        children = F.create_map(*[F.lit(x) for m in masks for x in (signed(m), [signed(c) for c in divided(m, parts)])])
        return rows.select("fp", F.explode(F.element_at(children, F.col("mask"))).alias("mask"))

    masks = [0]
    rows = copied(distinct.select("fp", F.lit(0).cast("long").alias("mask")), masks)
    masks = divided(0, parts)
    settled = None
    while n > limit and (open_ := sorted({m for m in masks if BITS - m.bit_count() > 2 * parts})):
        sizes = rows.where(F.col("mask").isin([signed(m) for m in open_])).groupBy("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")).count()
        hot = staged(sizes.where(F.col("count") > limit).select(F.col("mask").alias("hot_mask"), "value"), "hot-groups")
        if hot.isEmpty():
            break
        same = (F.col("mask") == F.col("hot_mask")) & (F.col("fp").bitwiseAND(F.col("mask")) == F.col("value"))
        rest = rows.join(hot, same, "left_anti")
        settled = rest if settled is None else settled.unionByName(rest)
        rows = staged(copied(rows.join(hot, same, "left_semi"), open_), "divided-groups")
        masks = [c for m in open_ for c in divided(m, parts)]
    return rows if settled is None else settled.unionByName(rows)


def linked(distinct: DataFrame, n: int, budget: int = 3, limit: int = GROUP_LIMIT) -> DataFrame:
    """(a, b): edges that connect just what fingerprints within ``budget`` differing bits connect.

    ``distinct`` has one column fp and ``n`` rows. Groups of more than ``limit`` fingerprints are divided.
    """
    spark = distinct.sparkSession
    prepare(spark)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * (budget + 1) // TASK_ROWS))

    def run(group: pa.Table) -> pa.Table:
        masks, fps = (group.column(c).to_numpy().view(np.uint64) for c in ("mask", "fp"))
        a, b = join_groups(masks, fps, budget)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    task = F.pmod(F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))), F.lit(tasks))
    rows = grouped_by_parts(distinct, n, budget, limit).withColumn("task", task)
    return rows.repartition(tasks, "task").groupBy("task").applyInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, budget: int, shingle: int) -> DataFrame:
    """(id, key, fp, root, component): key is the hash of the text, root the smallest fingerprint of the group."""
    marked = staged(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    edges = linked(distinct.select("fp"), distinct.count(), budget)
    found = components(edges).withColumnRenamed("node", "fp")
    named = distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    return marked.join(named.join(names, "root").select("fp", "root", "component"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Group documents whose fingerprints are linked by steps of at most ``budget`` bits.

    Returns (id, fp, component): one row per row of ``docs``; the component is its smallest id.

    Null texts, empty texts and texts without words have fingerprint zero and are linked like any other. Repeated rows
    stay repeated. A null id is kept and never names a component unless all ids of the component are null. Very long
    texts are hashed in parts of bounded size. No documents give no rows. Other columns are not looked at.
    """
    return _grouped(docs, id_col, text_col, budget, shingle).select("id", "fp", "component")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group stays: the row with the smallest id, with all its columns.

    A null id comes last; of rows with one id the one with the smaller hash of the text stays, of rows that repeat
    both the first in the order of all their columns.
    """
    groups = _grouped(docs, id_col, text_col, budget, shingle)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    leader, leader_key, rank = (spare(docs, x) for x in ("_leader", "_leader_key", "_rank_in_id"))
    leaders = first.select(F.col("first.id").alias(leader), F.col("first.key").alias(leader_key))
    text_key = F.xxhash64(F.col(text_col).cast("string"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stay = docs.join(leaders, F.col(id_col).eqNullSafe(F.col(leader)) & (text_key == F.col(leader_key)), "left_semi")
    order = Window.partitionBy(F.col(id_col), text_key).orderBy(*columns)
    return stay.select(*columns, F.row_number().over(order).alias(rank)).where(F.col(rank) == 1).select(*columns)
