"""One subplan for several branches of a plan, without a job of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` (an aggregate or a ``repartition`` by ``keys``) for branches that use different columns.

    Spark runs equal exchanges of a plan once, but column pruning makes the branches' exchanges
    unequal: each keeps only what its branch needs. Here all columns but the keys pass
    through a generator as one struct, and pruning doesn't look into that, so every branch keeps the
    same exchange, and the tables below it are read once. The keys stay columns of the child, so that
    its partitioning still serves joins by them; rows with a null key are left out (the filter that an
    equi-join would push below, in some branches only). Nothing runs before the plan does.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.select(*keys, F.inline(F.array(F.struct(*[c for c in df.columns if c not in keys]))))
