"""The trie of all prefixes of conversations, with counts, savings and members of every node.

A conversation is the chain of the digests of its turns (16 bytes each). Chains are range sorted, so conversations
that begin alike stand together, and what two neighbours share is the length of their longest common prefix. A task
reads its range in blocks. In a block, equal chains are one group; the edges between neighbouring groups are taken in
descending depth and joined by union-find. Every merge of two components creates the branching node at the depth of
the edge, or adds a child to the one that is there. Nodes between two branchings have one child and the same members,
so only branchings and groups are kept, and the nodes between them are written out from the depths of both.

A block's forest is final but for the nodes on the paths of its first and last chain, which neighbouring blocks may
share. Of these, counts per block are written (the contracted forest). Counts add up, since every node is counted in the
block where it stands; what two neighbouring blocks share is counted twice and taken off again, once per boundary,
which needs only the two chains at the boundary. Grouping the contracted forests by node merges them, so a node that
all conversations share costs one row per block. Children of such nodes look up their parent's smallest member.

Ids of equal conversations are sorted by the range sort. A group inside a block is hashed there; one that reaches over a
boundary is written as joined pieces, each of many ids, which are hashed in order from a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import prepare
from tidemark.session import staged

DIGEST = 16
#: Conversations, and bytes of their chains, that a block holds at most.
BLOCK_CHAINS = 1 << 14
BLOCK_BYTES = 8 << 20
#: Ids joined to one piece of a digest.
PIECE_IDS = 1 << 12
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns): each conversation's turns in order, as structs of digest (32 hex digits) and size (bytes of text).

    Null roles and texts are empty. Turns are ordered by number, null first; turns of one number by digest. Rows
    without a conversation id belong to no conversation and are left out. Texts stay where they are: only digests move.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(" "), role, text))
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rows = conversations.where(F.col(f"`{conv_col}`").isNotNull()).select(F.col(f"`{conv_col}`").alias("conv"), turn.alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def chains(turns: DataFrame) -> DataFrame:
    """(conv, chain, sizes) of (conv, turns)."""
    return turns.select("conv", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("chain"), F.col("turns.size").alias("sizes"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two chains have in common from the start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def node_keys(chain: bytes, upto: int) -> list[str]:
    """Names of the nodes of a chain at depths 0 to ``upto``."""
    running, out = hashlib.md5(b""), []
    for d in range(upto + 1):
        out.append(f"{d}:{running.hexdigest()}")
        running.update(chain[d * DIGEST : (d + 1) * DIGEST])
    return out


class Groups:
    """Equal chains of a block in sorted order: chain, running sums of sizes, number and smallest conversation, ids joined."""

    def __init__(self) -> None:
        self.chains: list[bytes] = []
        self.sums: list[np.ndarray] = []
        self.counts: list[int] = []
        self.least: list = []
        self.ids: list[list] = []
        self.rows = self.bytes = 0

    def add(self, conv, chain: bytes, sizes: list[int]) -> None:
        self.rows += 1
        if self.chains and self.chains[-1] == chain:
            self.counts[-1] += 1
            self.ids[-1].append(conv)  # the sort puts the smallest first
            return
        self.bytes += len(chain) * 2
        self.chains.append(chain)
        self.sums.append(np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]))
        self.counts.append(1)
        self.least.append(conv)
        self.ids.append([conv])


class Forest:
    """Branching nodes and groups of a block, by union-find over the edges between neighbours in descending depth."""

    def __init__(self, groups: Groups) -> None:
        self.groups = groups
        size = len(groups.chains)
        self.depth = [len(c) // DIGEST for c in groups.chains]
        self.members, self.least = list(groups.counts), list(groups.least)
        self.example = list(range(size))  # a group below the node
        self.children, self.leaves, self.below = [0] * size, [1] * size, [0] * size
        self.parent = [-1] * size
        self.first, self.last = list(range(size)), list(range(size))
        self.top = list(range(size))  # of a component, its node nearest to the root
        self.leader = list(range(size))
        edges = [shared_turns(a, b) for a, b in zip(groups.chains, groups.chains[1:], strict=False)]
        for k in sorted(range(size - 1), key=lambda k: -edges[k]):
            self.merge(k, k + 1, edges[k])

    def find(self, x: int) -> int:
        while self.leader[x] != x:
            self.leader[x] = x = self.leader[self.leader[x]]
        return x

    def merge(self, left: int, right: int, depth: int) -> None:
        """Join the components of two neighbours below the node they share at ``depth``."""
        a, b = self.find(left), self.find(right)
        above, under = self.top[a], self.top[b]
        if self.depth[above] != depth:
            above = self.branch(above, depth)
        self.hang(under, above)
        if self.last[a] - self.first[a] < self.last[b] - self.first[b]:
            a, b = b, a
        self.leader[b] = a
        self.first[a], self.last[a] = min(self.first[a], self.first[b]), max(self.last[a], self.last[b])
        self.top[a] = above

    def branch(self, child: int, depth: int) -> int:
        """A new node above ``child``."""
        node = len(self.depth)
        self.depth.append(depth)
        self.example.append(self.example[child])
        self.least.append(self.least[child])
        self.members.append(0)
        self.children.append(0)
        self.leaves.append(0)
        self.below.append(0)
        self.parent.append(-1)
        self.hang(child, node)
        return node

    def saved(self, node: int, depth: int) -> int:
        """Saved bytes of the subtree of the node's path at ``depth``, at most the node's own."""
        sums = self.groups.sums[self.example[node]]
        return self.below[node] + (self.members[node] - 1) * int(sums[self.depth[node]] - sums[depth - 1 if depth else 0])

    def hang(self, child: int, node: int) -> None:
        """Make ``child``, which is complete, a child of ``node``."""
        if not self.children[node]:
            self.leaves[node] = 0
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        self.members[node] += self.members[child]
        self.least[node] = min(self.least[node], self.least[child])
        self.below[node] += self.saved(child, self.depth[node] + 1)
        self.parent[child] = node


SHARED = "members long, children long, leaves long, saved long"
#: kind n: final nodes; c: nodes whose parent is on the edge of a block; o: nodes on the edge; e: ids of their ends;
#: b: the first and last chain of a block (in chain and last, with the first one's sizes).
FOREST_SCHEMA = "kind string, node string, parent string, depth long, least {conv}, parent_least {conv}, " + SHARED + ", ends string, first {conv}, place long, chain binary, last binary, sizes array<long>"


class Rows:
    """Columns under way."""

    NAMES = ("kind", "node", "parent", "depth", "least", "parent_least", "members", "children", "leaves", "saved", "ends", "first", "place", "chain", "last", "sizes")

    def __init__(self, conv: pa.DataType) -> None:
        text, long, raw = pa.string(), pa.int64(), pa.binary()
        self.kinds = [text, text, text, long, conv, conv, long, long, long, long, text, conv, long, raw, raw, pa.list_(long)]
        self.rows: list[tuple] = []

    def add(self, kind: str, **values) -> None:
        self.rows.append((kind, *(values.get(n) for n in self.NAMES[1:])))

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True)
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.kinds, strict=True)], list(self.NAMES))
        self.rows = []
        return made


def digest_of(ids: list) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def write_forest(groups: Groups, place: int, out: Rows) -> None:
    """All nodes of a block: final ones, those with a parent on the edge, and the contracted rest."""
    forest = Forest(groups)
    size = len(groups.chains)
    ends = size - 1
    on_edge = bytearray(len(forest.depth))
    for leaf in {0, ends}:
        node = leaf
        while node >= 0 and not on_edge[node]:
            on_edge[node] = 1
            node = forest.parent[node]
    keys: dict[int, list[str]] = {g: node_keys(groups.chains[g], len(groups.chains[g]) // DIGEST) for g in {0, ends}}

    def key_of(node: int, depth: int) -> str:
        g = 0 if shared_turns(groups.chains[0], groups.chains[forest.example[node]]) >= depth else ends
        return keys[g][depth]

    for node in range(len(forest.depth)):
        above, low = forest.parent[node], forest.depth[node]
        high = forest.depth[above] + 1 if above >= 0 else 0
        for d in range(high, low + 1):
            last = d == low
            values = {"depth": d, "least": forest.least[node], "members": forest.members[node], "children": forest.children[node] if last else 1, "leaves": forest.leaves[node], "saved": forest.saved(node, d)}
            if on_edge[node]:
                out.add("o", node=key_of(node, d), parent=key_of(node, d - 1) if d else None, **values)
                continue
            values["ends"] = digest_of(groups.ids[node]) if last and node < size else EMPTY_SHA
            if d > high:
                out.add("n", parent_least=forest.least[node], **values)
            elif on_edge[above]:
                out.add("c", parent=key_of(above, forest.depth[above]), **values)
            else:
                out.add("n", parent_least=forest.least[above], **values)
    for g in (g for g in range(size) if on_edge[g]):
        key = key_of(g, forest.depth[g])
        for a in range(0, len(groups.ids[g]), PIECE_IDS):
            ids = groups.ids[g][a : a + PIECE_IDS]
            out.add("e", node=key, first=ids[0], ends=",".join(map(str, ids)))
    out.add("b", place=place, chain=groups.chains[0], last=groups.chains[-1], sizes=np.diff(groups.sums[0]).tolist())


def forests(chained: DataFrame, block_chains: int = BLOCK_CHAINS) -> DataFrame:
    """Forests of all blocks of the sorted chains."""
    spark = chained.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = chained.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, out, place = Groups(), None, 0
        for batch in batches:
            out = out or Rows(batch.schema.field("conv").type)
            columns = (batch.column(n) for n in ("part", "conv", "chain", "sizes"))
            for part, conv, chain, sizes in zip(*(c.to_pylist() for c in columns), strict=True):
                if groups.rows >= block_chains or groups.bytes >= BLOCK_BYTES:
                    write_forest(groups, place, out)
                    yield out.batch()
                    groups = Groups()
                if not groups.rows:
                    place = (part << 40) + place % (1 << 40) + 1  # rises with the sort order over all tasks
                groups.add(conv, chain, sizes)
        if groups.rows:
            write_forest(groups, place, out)
            yield out.batch()

    ordered = chained.repartitionByRange(parts, "chain", "conv").sortWithinPartitions("chain", "conv")
    return ordered.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, FOREST_SCHEMA.format(conv=kind))


def twice_counted(boundaries: DataFrame, conv: str) -> DataFrame:
    """What neighbouring blocks both count of the nodes they share, as negative contracted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for before, chain, sizes in zip(*(batch.column(n).to_pylist() for n in ("before", "chain", "sizes")), strict=True):
                if before is None:
                    continue
                upto = shared_turns(before, chain)
                sums = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
                ended = -int(len(before) == upto * DIGEST)  # the block before has this node as a leaf
                for d, key in enumerate(node_keys(chain, upto)):
                    rows.append((key, d, -int(d < upto), ended, int(sums[upto] - sums[d - 1 if d else 0])))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["node", "depth", "children", "leaves", "saved"])

    # one row per block, not per conversation
    pairs = boundaries.select("place", "chain", "sizes", F.lag("last").over(W.orderBy("place")).alias("before"))
    made = pairs.mapInArrow(run, "node string, depth long, children long, leaves long, saved long")
    null = F.lit(None)
    return made.select("node", null.cast("string").alias("parent"), "depth", null.cast(conv).alias("least"), F.lit(0).cast("long").alias("members"), "children", "leaves", "saved")


def stream_digests(pieces: DataFrame, parts: int) -> DataFrame:
    """(node, ends): the digest of each node's pieces in order, read as a stream, so a long list is never held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for key, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if key != node:
                    if running:
                        done.append((node, running.hexdigest()))
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], ["node", "ends"])
        if running:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (node, running.hexdigest())], ["node", "ends"])

    return pieces.repartition(parts, "node").sortWithinPartitions("node", "first").select("node", "ends").mapInArrow(run, "node string, ends string")


def trie(chained: DataFrame, block_chains: int = BLOCK_CHAINS) -> DataFrame:
    """All nodes of the trie over (conv, chain, sizes), one row per distinct conversation id.

    Columns: conv (smallest member), depth, parent_conv (the parent's; null at the root), n_convs, n_children, n_leaves,
    saved (bytes of repeated last texts in the subtree) and ends (digest of the ids that end here). No conversations
    give no nodes. A conversation's digests, 16 bytes a turn, must fit in a task; its texts need not. Ids sort as their
    type does and are written as Spark casts them to text for whole numbers and strings.
    """
    spark = chained.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    conv = chained.schema["conv"].dataType.simpleString()
    made = staged(forests(staged(chained, "chains"), block_chains), "forests")
    shared = ["node", "parent", "depth", "least", "members", "children", "leaves", "saved"]
    contracted = made.where("kind = 'o'").select(*shared).unionByName(twice_counted(made.where("kind = 'b'"), conv))
    sums = [F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")]
    merged = contracted.groupBy("node", "depth").agg(F.max("parent").alias("parent"), F.min("least").alias("least"), *sums)
    merged = staged(merged, "merged-nodes")
    digests = stream_digests(made.where("kind = 'e'").select("node", "first", "ends"), parts)
    counts = ["depth", "least", "members", "children", "leaves", "saved", "ends"]
    parents = merged.select(F.col("node").alias("parent"), F.col("least").alias("parent_least"))
    edge = merged.join(digests, "node", "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY_SHA)))
    hung = made.where("kind = 'c'").select("parent", *counts).unionByName(edge.select("parent", *counts)).join(parents, "parent", "left")
    final = made.where("kind = 'n'").select(*counts, "parent_least").unionByName(hung.select(*counts, "parent_least"))
    return final.select(F.col("least").alias("conv"), "depth", F.col("parent_least").alias("parent_conv"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), "saved", "ends")


def share_openings(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Rebuild conversations with whole-number ids so that families of ``family`` neighbouring ids begin alike.

    Conversation c gets the first h turns of conversation c - c % family (all it has; none if it is absent), then its
    own turns after its first h; h = crc32(c as text) % most. One shuffle brings a family together.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = F.col("conv") - F.col("conv") % family
    grouped = turns.select(base.alias("base"), F.struct("conv", "turns").alias("c")).repartition(parts, "base").groupBy("base").agg(F.collect_list("c").alias("all"))
    opening = F.filter("all", lambda c: c["conv"] == F.col("base"))
    nothing = F.filter(F.col("all")[0]["turns"], lambda t: F.lit(False))
    split = grouped.select("all", F.when(F.size(opening) > 0, opening[0]["turns"]).otherwise(nothing).alias("opening"))
    each = split.select("opening", F.explode("all").alias("c")).select("c.conv", "opening", F.col("c.turns").alias("own"))
    h = (F.crc32(F.col("conv").cast("string")) % most).cast("int")
    rest = F.slice("own", h + 1, F.size("own"))
    return each.select("conv", F.concat(F.slice("opening", F.lit(1), h), F.when(F.size("own") > h, rest).otherwise(F.slice("own", 1, 0))).alias("turns"))
