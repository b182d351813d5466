"""Joins and windows that stay balanced when one key holds a large part of all rows.

A Spark window puts every row of a partition key into one task. The
functions here first count rows per key (a map-side combined aggregate).
Keys that fit a task use the plain window. The rows of larger keys, or
all rows where larger keys hold at least half of them, are range
partitioned on the whole sort key, so a hot key is
cut into slices; each slice runs on its own and takes over a carry from
the slices before it. At most one key continues into a slice, so the carry
table never has more rows than there are slices and may be broadcast.
Both ways give the same rows and types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import staged

HOT_GROUP_CONF = "spark.tidemark.hotGroupRows"
HOT_GROUP_ROWS = 5_000_000


def hot_group_rows(df: DataFrame) -> int:
    """Rows of one key that a single task may sort."""
    return int(df.sparkSession.conf.get(HOT_GROUP_CONF, str(HOT_GROUP_ROWS)))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, int]:
    """Key combinations that do not fit a task, and the number of slices to cut their rows into; (None, 0) if all fit.

    Where such keys hold at least half of all rows, no keys are listed (None and the slices for all rows): to tell the
    other rows apart would cost more reads of all rows. Otherwise there are at most rows / limit such keys. The slices are at least the
    shuffle partitions, and enough to keep one near the row limit.
    """
    limit = hot_group_rows(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    is_hot = F.col("_rows") > limit
    total, rows = counts.agg(F.sum(F.when(is_hot, F.col("_rows"))), F.sum("_rows")).first()
    if not total:
        return None, 0
    most = 2 * total >= rows
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows if most else total) // limit))
    return None if most else staged(counts.filter(is_hot), "hotkeys").drop("_rows"), slices


def by_group_size(
    df: DataFrame,
    keys: Sequence[str],
    sizes: DataFrame | None,
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """``plain`` over the rows of keys that fit a task, ``sliced`` over the others, in the types of ``plain``.

    ``sizes`` is a cheaper frame to measure the groups on, with at least as
    many rows per group as ``df``; for example the scan beneath a join.
    All rows are ``sliced`` where most of them are of keys that do not fit;
    the slices need no key to be large.
    """
    hot, slices = hot_keys(df if sizes is None else sizes, keys)
    if not slices:
        return plain(df)
    if hot is None:
        return as_types(sliced(df, slices), plain(df))
    marks = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    match = same(df, marks, [(k, f"_hot_{k}") for k in keys])
    rest = plain(df.join(F.broadcast(marks), match, "left_anti"))
    return rest.unionByName(as_types(sliced(df.join(F.broadcast(marks), match, "left_semi"), slices), rest))


def as_types(df: DataFrame, model: DataFrame) -> DataFrame:
    """Columns of ``model`` by name, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in model.schema.fields])


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality over pairs of column names."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def attach(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of ``lookup`` (one row per key) to ``df``; null keys match each other."""
    renamed = lookup.withColumnsRenamed({k: f"_lk_{k}" for k in keys})
    joined = df.join(renamed, same(df, renamed, [(k, f"_lk_{k}") for k in keys]), how)
    return joined.drop(*[f"_lk_{k}" for k in keys])


def with_group_stats(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Every row with aggregates of its group, without sorting a group in one task.

    The aggregate is written out first: the join then knows its size, so a
    small one is broadcast and a large one becomes a shuffle join whose
    skewed partitions adaptive execution splits.
    """
    if not keys:
        overall = df.agg(*aggregates)
        return df.withColumns({name: overall.select(name).scalar() for name in overall.columns})
    return attach(df, staged(df.groupBy(*keys).agg(*aggregates), "groupstats"), keys)


def _slices(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Rows with the number of their range in the whole sort order.

    Range bounds come from a sample, so another evaluation may cut
    elsewhere: callers stage what they derive from this frame before they
    read it twice.
    """
    ranged = df.repartitionByRange(n, *[F.col(p) for p in partition], *order)
    return ranged.withColumn("_slice", F.spark_partition_id())


def _earlier(partition: Sequence[str], slices: int | None = None):
    """Earlier slices of the same key, all of them or the nearest few."""
    first = Window.unboundedPreceding if slices is None else -slices
    return Window.partitionBy(*partition).orderBy("_slice").rowsBetween(first, -1)


def running_rows(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: Column,
    out: str,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the partition to the current row.

    ``order`` must be total within a partition. For ``sizes``, here and
    below, see ``by_group_size``.
    """
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return by_group_size(
        df,
        partition,
        sizes,
        lambda rows: rows.withColumn(out, F.sum(value).over(w)),
        lambda rows, slices: _running_in_slices(rows, slices, partition, order, value, out),
    )


def _running_in_slices(
    df: DataFrame, slices: int, partition: Sequence[str], order: Sequence[Column], value: Column, out: str
) -> DataFrame:
    cut = _slices(df.withColumn("_value", value), partition, order, slices)
    keys = [*partition, "_slice"]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = staged(cut.withColumn("_here", F.sum("_value").over(w)), "slices")
    totals = local.groupBy(*keys).agg(F.sum("_value").alias("_part"))
    carry = (
        totals.withColumn("_before", F.sum("_part").over(_earlier(partition)))
        .filter(F.col("_before").isNotNull())
        .drop("_part")
    )
    # at most one carry row per slice
    joined = attach(local, F.broadcast(carry), keys)
    total = F.when(
        F.col("_here").isNotNull() | F.col("_before").isNotNull(),
        F.coalesce("_here", F.lit(0)) + F.coalesce("_before", F.lit(0)),
    )
    return joined.withColumn(out, total).drop("_slice", "_value", "_here", "_before")


def carried(df: DataFrame, partition: Sequence[str], order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Last value that is not null from the first row of the partition to the current row."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return by_group_size(
        df,
        partition,
        None,
        lambda rows: rows.withColumn(out, F.last(value, ignorenulls=True).over(w)),
        lambda rows, slices: _carried_in_slices(rows, slices, partition, order, value, out),
    )


def _carried_in_slices(
    df: DataFrame, slices: int, partition: Sequence[str], order: Sequence[Column], value: str, out: str
) -> DataFrame:
    keys = [*partition, "_slice"]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = _slices(df, partition, order, slices)
    local = staged(cut.withColumn(out, F.last(value, ignorenulls=True).over(w)).withColumn("_at", F.row_number().over(w)), "slices")
    ends = local.groupBy(*keys).agg(F.max_by(out, "_at").alias("_end"))
    before = F.last("_end", ignorenulls=True).over(_earlier(partition))
    carry = ends.withColumn("_before", before).filter(F.col("_before").isNotNull()).drop("_end")
    # at most one carry row per slice
    joined = attach(local, F.broadcast(carry), keys)
    return joined.withColumn(out, F.coalesce(out, "_before")).drop("_slice", "_at", "_before")


def numbered(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], out: str, sizes: DataFrame | None = None
) -> DataFrame:
    """Row number within the partition; ``order`` must be total."""
    return running_rows(df, partition, order, F.lit(1), out, sizes)


def lagged(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: str,
    out: str,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``value`` of the row before, within the partition; ``order`` must be total."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return by_group_size(
        df,
        partition,
        sizes,
        lambda rows: rows.withColumn(out, F.lag(value).over(w)),
        lambda rows, slices: _lagged_in_slices(rows, slices, partition, order, value, out),
    )


def _lagged_in_slices(
    df: DataFrame, slices: int, partition: Sequence[str], order: Sequence[Column], value: str, out: str
) -> DataFrame:
    cut = _slices(df, partition, order, slices)
    keys = [*partition, "_slice"]
    w = Window.partitionBy(*keys).orderBy(*order)
    local = staged(
        cut.withColumn("_first", F.row_number().over(w) == 1)
        .withColumn("_last", F.lead(F.lit(True)).over(w).isNull())
        .withColumn(out, F.lag(value).over(w)),
        "slices",
    )
    last = local.filter("_last").select(*keys, F.struct(F.col(value).alias("v")).alias("_end"))
    carry = (
        last.withColumn("_prior", F.lag("_end").over(Window.partitionBy(*partition).orderBy("_slice")))
        .filter(F.col("_prior").isNotNull())
        .drop("_end")
    )
    joined = attach(local, F.broadcast(carry), keys)
    return joined.withColumn(
        out, F.when(F.col("_first"), F.col("_prior.v")).otherwise(F.col(out))
    ).drop("_slice", "_first", "_last", "_prior")


def moving_average(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: str,
    preceding: int,
    out: str,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Mean over the current row and the ``preceding`` rows before it; ``order`` must be total."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-preceding, 0)
    return by_group_size(
        df,
        partition,
        sizes,
        lambda rows: rows.withColumn(out, F.avg(value).over(w)),
        lambda rows, slices: _average_in_slices(rows, slices, partition, order, value, preceding, out),
    )


def _average_in_slices(
    df: DataFrame,
    slices: int,
    partition: Sequence[str],
    order: Sequence[Column],
    value: str,
    preceding: int,
    out: str,
) -> DataFrame:
    """Sums stay in the type of a sum of the value, so decimals stay decimals."""
    kinds = df.select(F.sum(value).alias("total"), F.avg(value).alias("mean")).schema
    total_type, mean_type = kinds["total"].dataType, kinds["mean"].dataType
    if mean_type.typeName() == "double":
        total_type = mean_type
    cut = _slices(df, partition, order, slices)
    keys = [*partition, "_slice"]
    w = Window.partitionBy(*keys).orderBy(*order)
    frame = w.rowsBetween(-preceding, 0)
    local = staged(
        cut.withColumn("_pos", F.row_number().over(w))
        .withColumn("_tail", F.lead(F.lit(True), preceding).over(w).isNull())
        .withColumn("_sum", F.sum(value).over(frame))
        .withColumn("_cnt", F.count(value).over(frame)),
        "slices",
    )
    # the last rows of each slice, at most ``preceding`` of them, in order
    tails = (
        local.filter("_tail")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_pos", F.col(value).alias("v")))).alias("_t"))
        .withColumn("_t", F.col("_t.v"))
    )
    # every slice listed holds at least one row, so this many slices hold enough rows
    earlier = F.flatten(F.collect_list("_t").over(_earlier(partition, preceding)))
    carry = tails.withColumn("_before", earlier).filter(F.size("_before") > 0).drop("_t")
    # a carry row holds up to ``preceding`` values of each of as many slices, so its size decides on the join
    joined = attach(local, staged(carry, "carry"), keys)
    missing = F.lit(preceding + 1) - F.col("_pos")
    borrowed = F.when(
        (missing > 0) & F.col("_before").isNotNull(),
        F.slice("_before", -F.least(missing, F.size("_before")), F.least(missing, F.size("_before"))),
    ).otherwise(F.array().cast(df.select(F.array(value).alias("a")).schema["a"].dataType))
    borrowed = F.filter(borrowed, lambda x: x.isNotNull())
    zero = F.lit(0).cast(total_type)
    borrowed_sum = F.aggregate(borrowed, zero, lambda a, x: (a + x.cast(total_type)).cast(total_type))
    total = (F.coalesce(F.col("_sum").cast(total_type), zero) + borrowed_sum).cast(total_type)
    count = F.col("_cnt") + F.size(borrowed)
    return joined.withColumn(out, F.when(count > 0, (total / count).cast(mean_type))).drop(
        "_slice", "_pos", "_tail", "_sum", "_cnt", "_before"
    )


def _order_column(order: str, descending: bool) -> Column:
    return F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()


def running_total(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    value: str,
    out: str,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Running sum where rows with the same ``order`` value share one total (RANGE frame).

    A hot group is first summed per order value; only these steps are
    accumulated, and the totals are joined back.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())

    def stepwise(rows: DataFrame, slices: int) -> DataFrame:
        steps = staged(rows.groupBy(*partition, order).agg(F.sum(value).alias("_step")), "steps")
        totals = running_rows(steps, partition, [F.col(order).asc_nulls_last()], F.col("_step"), out)
        return attach(rows, staged(totals.drop("_step"), "totals"), [*partition, order])

    return by_group_size(df, partition, sizes, lambda rows: rows.withColumn(out, F.sum(value).over(w)), stepwise)


def ranked(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    out: str,
    descending: bool = True,
    dense: bool = False,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """RANK or DENSE_RANK of ``order`` within the partition, as a long; nulls rank last.

    In a hot group rows are first counted per order value, so equal values
    never need to meet in one task.
    """
    key = _order_column(order, descending)
    rank = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy(*partition).orderBy(key)).cast("long")

    def stepwise(rows: DataFrame, slices: int) -> DataFrame:
        steps = staged(rows.groupBy(*partition, order).agg(F.count(F.lit(1)).alias("_n")), "steps")
        if dense:
            ranks = numbered(steps, partition, [key], out)
        else:
            ranks = running_rows(steps, partition, [key], F.col("_n"), out).withColumn(out, F.col(out) - F.col("_n") + 1)
        return attach(rows, staged(ranks.drop("_n"), "ranks"), [*partition, order])

    return by_group_size(df, partition, sizes, lambda rows: rows.withColumn(out, rank), stepwise)


def top_ranked(df: DataFrame, partition: Sequence[str], order: str, n: int, out: str, descending: bool = True) -> DataFrame:
    """Rows of rank ``n`` or better, with their rank as a long; ties stay.

    Spark keeps only such rows of each input partition before the shuffle
    (window group limit), so a hot key shrinks on the map side.
    """
    w = Window.partitionBy(*partition).orderBy(_order_column(order, descending))
    return df.withColumn(out, F.rank().over(w)).filter(F.col(out) <= n).withColumn(out, F.col(out).cast("long"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps only the best row per key and input partition before the
    shuffle (window group limit), so a hot key shrinks on the map side.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
