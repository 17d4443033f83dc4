"""Latest row per key (top-1 by a monotone id), in three equivalent spellings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_id_per_key(df: DataFrame, keys: Sequence[str], id_col: str, alias: str | None = None) -> DataFrame:
    """``SELECT k, max(id) FROM t GROUP BY k`` (hash aggregate with a map-side partial step, so
    a key holding a third of the rows is reduced before the shuffle)."""
    return df.groupBy(*keys).agg(F.max(id_col).alias(alias or id_col))


def latest_per_key(df: DataFrame, keys: Sequence[str], id_col: str, how: str = "struct") -> DataFrame:
    """Rows whose ``id_col`` is the maximum of their key group.

    how="struct"    ``max(struct(id, other columns))`` per key: one shuffle of partial
                    aggregates; one row per key (ties on id are broken by the other columns).
                    Struct buffers make it a sort-based aggregate.
    how="max_by"    ``max(id), max_by(c, id)`` per column: the same row when ids are unique
                    (a primary key); with fixed-width columns it is a hash aggregate.
    how="semi"      ``WHERE id IN (SELECT max(id) ... GROUP BY keys)``: a semi join on id,
                    keeps every row that carries a group's maximum id value.
    how="join_back" ``JOIN (SELECT max(id) max_id ... GROUP BY keys) m ON m.max_id = t.id``.

    With unique ids all four agree (property test). Rows with a null id never qualify.
    """
    cols = df.columns
    if how == "max_by":
        others = [c for c in cols if c not in keys and c != id_col]
        rows = df.filter(F.col(id_col).isNotNull())
        out = rows.groupBy(*keys).agg(F.max(id_col).alias(id_col),
                                      *[F.max_by(F.col(c), F.col(id_col)).alias(c) for c in others])
        return out.select(*cols)
    if how == "struct":
        others = [c for c in cols if c not in keys and c != id_col]
        packed = F.max(F.struct(F.col(id_col), *[F.col(c) for c in others])).alias("_latest")
        out = df.filter(F.col(id_col).isNotNull()).groupBy(*keys).agg(packed)
        return out.select(*keys, "_latest.*").select(*cols)
    maxes = max_id_per_key(df, keys, id_col, "_max_id")
    if how == "semi":
        return df.join(maxes.select("_max_id"), F.col(id_col) == F.col("_max_id"), "left_semi")
    if how == "join_back":
        return df.join(maxes.select("_max_id"), F.col(id_col) == F.col("_max_id"), "inner").drop("_max_id")
    raise ValueError(f"unknown spelling {how!r}")


def owner_by_max_id(df: DataFrame, key: str, id_col: str, names: DataFrame, name_key: str,
                    name_col: str, alias: str) -> DataFrame:
    """Max non-null id per key, then its name through an inner join (no name -> no row)."""
    top = (df.filter(F.col(id_col).isNotNull()).groupBy(key).agg(F.max(id_col).alias("_owner_id")))
    return (top.join(names.select(F.col(name_key).alias("_owner_id"), F.col(name_col).alias(alias)),
                     "_owner_id", "inner")
               .select(key, alias))
