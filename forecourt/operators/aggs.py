"""Aggregation operators.

Every operator here aggregates with a map-side partial step and then one shuffle of partial
results, so a key that holds a large share of the rows is reduced before it moves (with
fixed-width buffers, as here, Spark plans them as hash aggregates). Sums over joins that multiply rows are computed from per-key aggregates and
multiplicities, never by materialising the row pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import local_time


def multi_measure(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """``GROUP BY keys`` with several named measures in one pass."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def status_pivot(
    df: DataFrame,
    key: str,
    ts_col: str,
    code_col: str,
    specs: Sequence[tuple[str, object, str]],
    *,
    offset_minutes: int | None = None,
) -> DataFrame:
    """Min/max timestamp per status code from one event log, in one scan and one shuffle.

    ``specs`` = ``[(alias, code, "min"|"max"), ...]``. Equivalent to one grouped sub-select
    per spec left-joined together, but the log is read once. Rows of other codes are filtered
    before the aggregate (a pushed-down ``IN`` on the scan). Keys with no row of a given code
    get null for that spec; keys with no row of any listed code do not appear.
    """
    codes = sorted({c for _, c, _ in specs}, key=str)
    rows = df.filter(F.col(code_col).isin(*codes))
    return rows.groupBy(key).agg(*pivot_columns(code_col, ts_col, specs, offset_minutes=offset_minutes))


def pivot_columns(code_col: str, ts_col: str, specs: Sequence[tuple[str, object, str]], *,
                  offset_minutes: int | None = None) -> list[Column]:
    """The conditional aggregates of ``status_pivot``, to combine with other measures of the
    same key in one aggregate."""
    out = []
    for alias, code, fn in specs:
        picked = F.when(F.col(code_col) == F.lit(code), F.col(ts_col))
        agg = F.min(picked) if fn == "min" else F.max(picked)
        if offset_minutes:
            agg = local_time(agg, offset_minutes)
        out.append(agg.alias(alias))
    return out


def fanout_factor(sides: Sequence[tuple[DataFrame, str]], key: str) -> tuple[DataFrame | None, Column]:
    """Row multiplicity a chain of ``LEFT JOIN side ON side.k = key`` adds per key.

    A side with n >= 1 rows for the key multiplies by n, a side with none by 1 (the left join
    keeps one null row). Returns a per-key frame of counts and the product expression.
    """
    frame = None
    factor = F.lit(1).cast("long")
    for i, (side, side_key) in enumerate(sides):
        name = f"_fan{i}"
        counts = side.groupBy(F.col(side_key).alias(key)).agg(F.count(F.lit(1)).alias(name))
        frame = counts if frame is None else frame.join(counts, key, "full")
        factor = factor * F.coalesce(F.col(name), F.lit(1).cast("long"))
    return frame, factor


def fanout_sum(
    base: DataFrame,
    key: str,
    amounts: DataFrame,
    amount_key: str,
    amount_col: str,
    fan_sides: Sequence[tuple[DataFrame, str]],
    alias: str,
    *,
    dedupe: bool = False,
) -> DataFrame:
    """``SELECT key, SUM(a.amount) FROM base LEFT JOIN amounts a ... LEFT JOIN side1 ...
    GROUP BY key`` with the faithful fan-out, computed without the pairs.

    Every amount row of a key is repeated once per row of each one-to-many side and once per
    base row of that key, so the sum is ``sum(amounts) * n_base * prod(n_side)``; it is null
    when the key has no non-null amount. ``dedupe=True`` gives the sum the author meant: the
    amounts once per key (``fanout_safe_sum``).
    """
    per_key = amounts.groupBy(F.col(amount_key).alias(key)).agg(F.sum(amount_col).alias("_amt"))
    base_n = base.groupBy(key).agg(F.count(F.lit(1)).alias("_n_base"))
    out = base_n.join(per_key, key, "left")
    if dedupe:
        return out.select(key, F.col("_amt").alias(alias))
    frame, factor = fanout_factor(fan_sides, key)
    if frame is not None:
        out = out.join(frame, key, "left")
    total = F.col("_amt") * F.col("_n_base") * factor
    return out.select(key, total.alias(alias))


def group_hidden_key(df: DataFrame, keys: Sequence[str], hidden: Sequence[str],
                     measures: Mapping[str, Column]) -> DataFrame:
    """``SELECT keys, aggs ... GROUP BY keys, hidden``: the hidden keys set the grain but are
    not returned, so output rows may look duplicated. They are not re-distincted."""
    grouped = df.groupBy(*keys, *hidden).agg(*[e.alias(n) for n, e in measures.items()])
    return grouped.select(*keys, *measures.keys())
