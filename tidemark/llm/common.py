"""Helpers shared by the operators on texts."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import staged

#: Bytes of text a Python task takes in hand at a time.
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies on a path they can see."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(taken: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``taken`` has it."""
    names = {c.lower() for c in taken.columns}
    while name.lower() in names:
        name += "_"
    return name


def binary(column: pa.Array) -> pa.Array:
    """A text column as bytes, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return pc.fill_null(column.cast(kind), b"")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches so that each part holds about ``limit`` bytes of text; one longer text is a part of its own.

    Yields the part and its texts as bytes, nulls as empty.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.maximum(np.cumsum(sizes) - sizes, 0) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            cut = batch.slice(a, b - a)
            yield cut, binary(cut.column(text)).to_pylist()


def word_lists(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts one after another, and where each text's words begin (one more entry than texts).

    A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
    """
    lists = [x.split() for x in texts]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=bounds[1:])
    return [w for x in lists for w in x], bounds


def codes(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Number the distinct words; the numbers of all words and the distinct words themselves."""
    if not words:
        return np.zeros(0, np.int64), []
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def bucket_count(spark: SparkSession) -> int:
    """Buckets of an exchange of packed arrays; follows the session's number of shuffle partitions."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph by alternating large and small stars.

    ``edges`` has two columns a, b of one comparable type. Returns (node, root), the root being the smallest node of
    its component; nodes without an edge do not occur. Every round is a grouped minimum and a join back, so a node
    with very many neighbours is pre-aggregated and its join can be split. Each round is written out, which cuts the
    lineage and survives lost executors; the number of rounds grows with the logarithm of the longest chain.
    """
    now = staged(edges.where("a is not null and b is not null and a != b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").where("v > u and v != m").selectExpr("v as u", "m as v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").selectExpr("v as u", "m as v").unionByName(least.selectExpr("u", "m as v")).distinct()
        now = staged(small, "edges")
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen.n, seen.x) == state:
            return now.selectExpr("u as node", "v as root").unionByName(now.selectExpr("v as node", "v as root").distinct())
        state = (seen.n, seen.x)
