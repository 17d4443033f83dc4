"""Ranking and predecessor operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dense_rank_first(df: DataFrame, partition: Sequence[str], order_col: str,
                     method: str = "window") -> DataFrame:
    """Rows with ``DENSE_RANK() OVER (PARTITION BY p ORDER BY o ASC NULLS LAST) = 1``.

    Rank 1 is every row whose ``o`` equals the partition's first value: the smallest non-null
    value, or null when the partition has only nulls. ``method="window"`` (default) plans as
    ``WindowGroupLimit``: each map task passes on its candidate rows only, so of a big partition
    one task sees a few rows per map task. ``method="agg"`` computes the first value with a hash
    aggregate and keeps matching rows with a null-safe semi join; it plans the input twice and is
    for a partition in which most rows tie for rank 1, which the limit can't prune.
    """
    if method == "window":
        w = Window.partitionBy(*partition).orderBy(F.col(order_col).asc_nulls_last())
        return df.withColumn("_rank", F.dense_rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")
    first = df.groupBy(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(partition)]).agg(
        F.min(order_col).alias("_first"))
    cond = F.col(order_col).eqNullSafe(F.col("_first"))
    for i, p in enumerate(partition):
        cond = cond & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return df.join(first, cond, "left_semi")


def with_previous(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                  columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``LAG(c) OVER (PARTITION BY p ORDER BY o)`` for several columns sharing one window."""
    w = Window.partitionBy(*partition).orderBy(*order)
    for c in columns:
        df = df.withColumn(prefix + c, F.lag(c).over(w))
    return df


def month_bucket(column: str) -> Column:
    """Year and month of a date or timestamp as one number; null stays null."""
    return F.year(column) * 12 + F.month(column)


#: A bucket is cut further when it holds more than one row in so many, and this many rows at least.
HOT_SHARE, HOT_ROWS = 1000, 200_000


def _number(df: DataFrame, column: str) -> Column | None:
    """A number that never falls as the column rises; None for types without one."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column) if isinstance(kind, T.IntegralType) else None


def previous_in_range(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                      columns: Sequence[str], prefix: str = "prev_",
                      bucket: Column | None = None, hot_share: int = HOT_SHARE,
                      hot_rows: int = HOT_ROWS, cuts: int = 1) -> DataFrame:
    """``LAG(c) OVER (PARTITION BY p ORDER BY o ASC NULLS LAST)`` without one task per group.

    A window sends every row of a group to one task, so a group holding a third of the rows is
    sorted by one task. Here a group is cut into buckets of its first order column: ``bucket``, a
    value that never falls as that column rises and is null where it is null (default: year and
    month). A bucket that still holds more than one row in ``hot_share`` (and ``hot_rows``) is cut into
    ranges of equal width, as many as it holds such shares: of its first order column or, where all
    its rows are equal there, of the second; ``cuts`` times over, where rows may crowd into one range. There are
    fewer than ``hot_share`` hot buckets a time, so their bounds are broadcast; without any, the plan
    reads and shuffles nothing for them.

    LAG runs inside (p, bucket, ranges). The last row of each such segment, one ``max(struct)`` with a
    map-side partial step, is lagged over the segments of its group, and patches the first row of the
    next. Every step is a function of the rows alone, so it doesn't matter how they are partitioned or
    whether an exchange is reused. ``order`` must make the order total (end it with a unique id) for a
    deterministic result.
    """
    carried = list(dict.fromkeys(columns))
    cut = df.withColumn("_bucket", month_bucket(order[0]) if bucket is None else bucket)
    keys = [*partition, "_bucket"]
    none = F.lit(None).cast("long")
    marks = [none if c is None or (m := _number(df, c)) is None else m for c in [*order, None][:2]]
    if _number(df, order[0]) is None:
        marks[1] = none  # whether rows are equal in the first column isn't known, so the second can't cut

    # max(struct(isnull(k), k, ...)) is the last row in ASC NULLS LAST order.
    sort_key = [x for c in order for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(f"_k_{c}"))]
    last = F.max(F.struct(*sort_key, *[F.col(c).alias(f"_c_{c}") for c in carried])).alias("_last")
    bounds = [f(m).alias(f"_{f.__name__}{i}") for i, m in enumerate(marks) for f in (F.min, F.max)]
    bounds.append((F.count(marks[0]).between(1, F.count(F.lit(1)) - 1)).alias("_mixed"))  # nulls and others
    ends, rows = None, cut  # the segments' last rows; the rows still to be cut

    def same(left: list[str], right: str) -> Column:
        cond = F.lit(True)
        for i, k in enumerate(left):
            cond = cond & F.col(k).eqNullSafe(F.col(f"{right}{i}"))
        return cond

    total = cut.agg(F.count(F.lit(1))).scalar()
    for level in range(cuts):
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), *bounds, last)
        hot = (F.col("_size") > hot_rows) & (F.col("_size") * hot_share > total)
        done = sizes.where(~hot).select(*keys, *[F.lit(0).cast("long").alias(f"_part{i}") for i in range(level, cuts)], "_last")
        ends = done if ends is None else ends.unionByName(done)
        parts = F.ceil(F.col("_size") * hot_share / total)
        limits = sizes.where(hot).select(*[F.col(k).alias(f"_hot{level}_{i}") for i, k in enumerate(keys)],
                                         parts.alias("_parts"), "_mixed", *[f"_{f}{i}" for i in (0, 1) for f in ("min", "max")])

        def range_of(i: int) -> Column:
            low, high, mark = (c.cast("double") for c in (F.col(f"_min{i}"), F.col(f"_max{i}"), marks[i]))
            return F.coalesce(F.floor((mark - low) / (high - low + 1) * F.col("_parts")), F.col("_parts"))  # nulls last

        part = F.when(F.col("_parts").isNull(), 0).otherwise(F.when((F.col("_max0") > F.col("_min0")) | F.col("_mixed"), range_of(0)).otherwise(range_of(1)))
        drop = ["_parts", "_mixed", "_min0", "_max0", "_min1", "_max1", *[f"_hot{level}_{i}" for i in range(len(keys))]]
        match = same(keys, f"_hot{level}_")
        rows = rows.join(F.broadcast(limits), match).withColumn(f"_part{level}", part.cast("long")).drop(*drop)
        cut = cut.join(F.broadcast(limits), match, "left").withColumn(f"_part{level}", part.cast("long")).drop(*drop)
        keys.append(f"_part{level}")
    if cuts:
        ends = ends.unionByName(rows.groupBy(*keys).agg(last))
    else:
        ends = rows.groupBy(*keys).agg(last)

    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    local = cut.withColumn("_rn", F.row_number().over(w))
    for c in columns:
        local = local.withColumn(prefix + c, F.lag(c).over(w))
    segments = Window.partitionBy(*partition).orderBy(*[F.col(k).asc_nulls_last() for k in keys[len(partition):]])
    edge = ends.select(*[F.col(k).alias(f"_edge{i}") for i, k in enumerate(keys)], F.lag("_last").over(segments).alias("_edge"))
    out = local.join(edge, same(keys, "_edge") & (F.col("_rn") == 1), "left")
    patched = {prefix + c: F.when(F.col("_rn") == 1, F.col("_edge")[f"_c_{c}"]).otherwise(F.col(prefix + c)) for c in columns}
    return out.withColumns(patched).drop("_rn", "_edge", *keys[len(partition):], *[f"_edge{i}" for i in range(len(keys))])


def repeat_deals(
    deals: DataFrame,
    lead: str,
    created: str,
    deal_id: str,
    status: str,
    *,
    previous_status: str,
    excluded: Sequence[str] = (),
    out: str = "id",
    method: str = "range",
) -> DataFrame:
    """Ids of deals that were followed by another deal of the same lead in the same calendar
    month (month number only: October of two years matches) and whose status was
    ``previous_status``.

    Excluded statuses are removed before the predecessor is taken. Ties in ``created`` are
    broken by the deal id so the predecessor is deterministic. Returns one column ``out`` with
    the previous deal's id. ``method="range"`` (default) is the skew-safe predecessor of
    ``previous_in_range``; ``method="window"`` is the plain window.
    """
    rows = deals.select(lead, created, deal_id, status)
    if excluded:
        rows = rows.filter(~F.col(status).isin(*excluded))
    if method == "window":
        order = [F.col(created).asc_nulls_last(), F.col(deal_id).asc_nulls_last()]
        rows = with_previous(rows, [lead], order, [status, deal_id, created])
    else:
        rows = previous_in_range(rows, [lead], [created, deal_id], [status, deal_id, created])
    hit = (F.col("prev_" + status) == F.lit(previous_status)) & (
        F.month(F.col("prev_" + created)) == F.month(F.col(created)))
    return rows.filter(hit).select(F.col("prev_" + deal_id).alias(out))
