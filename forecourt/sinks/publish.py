"""Publishing a result to several snapshot targets, the trailing-window subset and the text
export with blanks for nulls.

A *published table* is a folder with one sub-folder per version and a pointer file that names the
current one. A version is written completely, given a manifest, and only then made current: the new pointer
is written beside the old one and renamed over it, so readers see the old name or the new one and a crash
at any point leaves the old version readable. The version before the current one is kept for readers that
opened it. Rows are counted by an observation on the write itself; targets are not read back.
:func:`published_table` reads the current version.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions.columns import ntz_literal

POINTER, MANIFEST, SUCCESS = "_CURRENT", "_MANIFEST", "_SUCCESS"


class _Folder:
    """Small files and folders through Hadoop, so that any store Spark writes to works."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.root = spark.sparkContext._jvm, spark.sparkContext._gateway, path
        self.path = lambda *names: self.jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
        self.fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def read(self, *names: str) -> str | None:
        if not self.fs.exists(self.path(*names)):
            return None
        stream = self.fs.open(self.path(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self.fs.create(self.path(*names), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def replace(self, text: str, name: str) -> None:
        """Write a file beside ``name`` and rename it over ``name`` in one step."""
        fresh, fs = f"{name}.{uuid.uuid4().hex}", self.jvm.org.apache.hadoop.fs
        try:
            files = fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf())
        except Py4JJavaError as problem:
            if "UnsupportedFileSystem" not in problem.java_exception.getClass().getName():
                raise
            return self.write(text, name)  # an object store: the old object stays until the new one is whole
        self.write(text, fresh)
        rename = getattr(fs, "Options$Rename")
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        files.rename(self.path(fresh), self.path(name), how)

    def drop(self, *names: str) -> None:
        self.fs.delete(self.path(*names), True)

    def folders(self) -> list[str]:
        if not self.fs.exists(self.path()):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path()) if s.isDirectory()]


def fingerprint(spark: SparkSession, inputs: Sequence[str] = (), **settings) -> str:
    """Names the state of the inputs (their files' names, sizes and times) and the settings: rules,
    ``as_of`` and whatever else the result depends on."""
    files = []
    for path in inputs:
        folder = _Folder(spark, path)
        it = folder.fs.listFiles(folder.path(), True)
        while it.hasNext():
            f = it.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    text = json.dumps([sorted(files), settings], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def _commit(df: DataFrame, folder: _Folder, version: str, fmt: str, stamp: str, options: Mapping[str, str],
            **more) -> DataFrame:
    """Write one version and its manifest (last); the rows are counted while they are written."""
    spark, path = df.sparkSession, f"{folder.root}/{version}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).options(**options).save(path)
    back = spark.read.schema(df.schema).options(**options).format(fmt).load(path)
    rows = seen.get.get("rows")  # none if the plan was found to be empty before it ran
    manifest = {"rows": back.count() if rows is None else rows, "schema": df.schema.json(), "fingerprint": stamp, **more}
    folder.write(json.dumps(manifest), version, MANIFEST)
    return back


def committed_table(spark: SparkSession, path: str, stamp: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path`` if its write committed, its manifest carries the fingerprint ``stamp`` and it
    holds the rows the manifest counts; else None."""
    folder = _Folder(spark, path)
    text = folder.read(MANIFEST)
    if text is None or folder.read(SUCCESS) is None:
        return None
    manifest = json.loads(text)
    if manifest["fingerprint"] != stamp:
        return None
    table = spark.read.schema(T.StructType.fromJson(json.loads(manifest["schema"]))).format(fmt).load(path)
    return table if table.count() == manifest["rows"] else None


def stage_table(df: DataFrame | Callable[[], DataFrame], path: str, stamp: str, fmt: str = "parquet",
                spark: SparkSession | None = None) -> DataFrame:
    """The staged table at ``path``: reused if committed with the same fingerprint, else written anew.

    ``df`` may be a function (with ``spark``): it is called only if the table has to be written, so a rerun that
    finds the stage builds nothing."""
    spark = spark or df.sparkSession
    done = committed_table(spark, path, stamp, fmt)
    if done is not None:
        return done
    parent, _, name = path.rpartition("/")
    return _commit(df() if callable(df) else df, _Folder(spark, parent), name, fmt, stamp, {})


def publish_table(df: DataFrame, target: str, fmt: str = "parquet", options: Mapping[str, str] | None = None,
                  **manifest) -> DataFrame:
    """Overwrite one target: write a new version, point to it, then drop all others but the one before."""
    folder = _Folder(df.sparkSession, target)
    version, before = f"version-{uuid.uuid4().hex}", folder.read(POINTER)
    back = _commit(df, folder, version, fmt, "", options or {}, **manifest)
    folder.replace(version, POINTER)
    for old in folder.folders():
        if old not in (version, before):
            folder.drop(old)
    return back


def published_table(spark: SparkSession, target: str, fmt: str = "parquet",
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """The current version of a published table; of the text export with its line breaks."""
    folder = _Folder(spark, target)
    version = folder.read(POINTER)
    if not version:
        raise FileNotFoundError(f"nothing is published at {target}")
    manifest = json.loads(folder.read(version, MANIFEST))
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    table = spark.read.schema(schema).options(**(options or {})).format(fmt).load(f"{target}/{version}")
    escaped = manifest.get("escaped", [])
    return table.withColumns({c: _unescape(F.col(c)) for c in escaped}) if escaped else table


#: Text export: a header, quotes doubled, spaces kept. The export has no nulls; their mark is one that no
#: value has, so that blanks read back as blanks. A row is one line, so files are split among tasks when read.
TEXT_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\u0001",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Line breaks of values, and the sign that escapes them, in the text export.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def _escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def publish_text(df: DataFrame, target: str, money_scale: Mapping[str, int] | None = None) -> DataFrame:
    """The blank-filled text of ``df`` as CSV with a header (the spreadsheet export), one line a row."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (money_scale or {})]
    lines = blank_fill(df, money_scale).withColumns({c: _escape(F.col(c)) for c in texts})
    return publish_table(lines, target, "csv", TEXT_OPTIONS, escaped=texts)


def publish_snapshot(df: DataFrame, targets: Sequence[str], fmt: str = "parquet",
                     staging: str | None = None, stamp: str = "", money_scale: Mapping[str, int] | None = None) -> list[str]:
    """Overwrite every target with ``df``; the plan runs once.

    Without ``staging`` the first target is written from ``df`` and the others are copied from
    that written table. With ``staging`` (a path in the shared folder, e.g. one per run id) the
    plan is written there first and every target is a copy; a rerun with the same staging path and
    the same fingerprint ``stamp`` after a driver failure finds the committed table and only redoes
    the copies. Executor loss is covered by task retries (every plan here is deterministic). A target
    whose copy fails keeps its old version. ``fmt="csv"`` publishes the blank-filled text export.
    """
    if not targets:
        return []
    source, text = df, fmt == "csv"
    if staging is not None:
        source = stage_table(df, staging, stamp)
    for i, target in enumerate(targets):
        written = publish_text(source, target, money_scale) if text else publish_table(source, target, fmt)
        if i == 0 and staging is None and not text:
            source = written
    return list(targets)


def trailing_window(df: DataFrame, ts_col: str, as_of: dt.datetime, days: int = 90,
                    status_col: str | None = None, status: str | None = None) -> DataFrame:
    """Rows with ``ts_col`` (a date or timestamp, compared as a timestamp) at or after
    ``as_of - days``, keeping the time of day of ``as_of``; optionally one status only.

    ``as_of`` is a parameter (the run time in the source), so the result is reproducible.
    Null dates never pass.
    """
    cutoff = ntz_literal(as_of - dt.timedelta(days=days))
    cond = F.col(ts_col).cast("timestamp_ntz") >= cutoff
    if status_col is not None:
        cond = (F.col(status_col) == F.lit(status)) & cond
    return df.filter(cond)


def _as_text(field: T.StructField, money_scale: Mapping[str, int]) -> Column:
    c = F.col(field.name)
    if field.name in money_scale:
        c = c.cast(f"decimal(38,{money_scale[field.name]})")
    return F.coalesce(c.cast("string"), F.lit("")).alias(field.name)


def blank_fill(df: DataFrame, money_scale: Mapping[str, int] | None = None) -> DataFrame:
    """All columns as text, nulls as empty strings (the spreadsheet export).

    Columns listed in ``money_scale`` are rendered with a fixed number of decimals.
    """
    money_scale = money_scale or {}
    return df.select(*[_as_text(f, money_scale) for f in df.schema.fields])


def publish_margin(
    margin: DataFrame | Callable[[], DataFrame],
    refurb: DataFrame,
    *,
    full_targets: Sequence[str],
    trailing_target: str | None,
    refurb_target: str | None,
    as_of: dt.datetime,
    days: int = 90,
    fmt: str = "parquet",
    staging: str,
    stamp: str = "",
    money_scale: Mapping[str, int] | None = None,
) -> dict[str, list[str]]:
    """The whole publication step: the margin base to every full target, the delivered deals
    of the trailing window to one target, the refurb cost to one target.

    The margin plan runs once, into ``staging``; the full targets and the trailing subset are derived
    from that written table, filtering on its typed date column. ``fmt="csv"`` publishes every margin
    target as blank-filled text. ``margin`` may be a function, called only if ``staging`` holds no such table.
    """
    base = stage_table(margin, staging, stamp, spark=refurb.sparkSession)
    out = {"full": publish_snapshot(base, full_targets, fmt, money_scale=money_scale), "trailing": [], "refurb": []}
    if trailing_target:
        trailing = trailing_window(base, "delivery_time", as_of, days, status_col="deal_status", status="Delivered")
        out["trailing"] = publish_snapshot(trailing, [trailing_target], fmt, money_scale=money_scale)
    if refurb_target:
        publish_table(refurb, refurb_target)
        out["refurb"] = [refurb_target]
    return out
