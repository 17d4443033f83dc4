"""Table scans, projection with rename, and naming a result by position."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import sized_session

TESTDATA_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession, base_dir: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet scan. Naming the columns up front keeps ReadSchema narrow even before
    Catalyst's own pruning runs."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df


def largest_table(spark: SparkSession, base_dir: str, names: Sequence[str] = TESTDATA_TABLES) -> int:
    """Bytes of the files of the largest of the named tables; 0 if there is none."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [hadoop.Path(table_path(base_dir, name)) for name in names]
    fs = paths[0].getFileSystem(conf)
    return max([fs.getContentSummary(p).getLength() for p in paths if fs.exists(p)], default=0)


class Tables:
    """Lazy, cached-by-name access to the parquet tables of one folder.

    The frames belong to this object: a table that is rewritten under the same path is listed anew
    by the next ``Tables``. They belong to a session whose shuffle partitions follow the size of the tables
    (``sized_session``; ``spark`` itself where that has enough)."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = sized_session(spark, largest_table(spark, base_dir))
        self.base_dir = base_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.base_dir, name)
        return self._frames[name]

    def memo(self, name: str, build) -> DataFrame:
        """Build a derived (lazy) DataFrame once per object. Only the plan is shared; every action
        on it still executes the plan in full."""
        key = f"memo:{name}"
        if key not in self._frames:
            self._frames[key] = build()
        return self._frames[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def scan_project_rename(df: DataFrame, mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """``select a AS b, ...``: keep only the listed columns under their new names."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name an unnamed result by position, failing loudly when the widths differ (the
    fetch into a frame with a column list is silent about a mismatch)."""
    if len(df.columns) != len(names):
        raise ValueError(f"result has {len(df.columns)} columns, {len(names)} names given")
    return df.toDF(*names)
