"""Table writes: append, overwrite, slice replacement, published tables, layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.time import before
from tidemill.session import cut_lineage


@dataclass(frozen=True)
class Target:
    """A table behind a connector: its format name and options come from config."""

    format: str
    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def jdbc(url: str, table: str, **options: str) -> Target:
        return Target("jdbc", {"url": url, "dbtable": table, "batchsize": "10000"} | options)

    @staticmethod
    def folder(path: str) -> Target:
        return Target("parquet", {"path": path})


def append(df: DataFrame, target: Target) -> None:
    """Append.  External stores may see a retried task's rows twice: give the
    table a key and resolve by it, or use ``replace_slice`` for files."""
    df.write.format(target.format).options(**target.options).mode("append").save()


def overwrite(df: DataFrame, target: Target, keep_definition: bool = True) -> None:
    """Replace all rows.  On JDBC the table definition is kept (TRUNCATE)."""
    options = dict(target.options)
    if target.format == "jdbc":
        options["truncate"] = str(keep_definition).lower()
    df.write.format(target.format).options(**options).mode("overwrite").save()


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one output folder brought together, at a bounded file size.

    Under AQE a rebalance coalesces small folders into few files and splits a
    folder that holds a large share of all rows over many tasks.
    """
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")


def _unseen(df: DataFrame) -> DataFrame:
    return df


def write_files(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    seen: Callable[[DataFrame], DataFrame] = _unseen,
) -> None:
    """Parquet folder, optionally partitioned, sorted within files for min/max skipping."""
    if partition_by:
        df = spread(df, *partition_by)
    df = seen(df)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def replace_slice(
    df: DataFrame,
    path: str,
    slice_by: Sequence[str],
    sort_by: Sequence[str] = (),
    one_slice: bool = False,
    seen: Callable[[DataFrame], DataFrame] = _unseen,
) -> None:
    """Overwrite only the slices present in ``df``; running it again changes nothing.

    ``one_slice`` says that all rows belong to the same slice: they are spread
    evenly instead of being brought together by a constant.
    """
    df = seen(spread(df) if one_slice else spread(df, *slice_by))
    if sort_by:
        df = df.sortWithinPartitions(*slice_by, *sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*slice_by).parquet(path)


def publish_table(df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None) -> DataFrame:
    """Create or replace a partitioned aggregate table and return it."""
    writer = spread(df, *partition_by).write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


REJECTED = "rejected_columns"


def conform(df: DataFrame, ddl: str, strict: bool = False, rejects: bool = False) -> DataFrame:
    """Exactly the contract's columns, in order, cast to its types.

    Columns the frame lacks become NULL.  A value that does not fit becomes NULL, and with
    ``rejects`` its column is named in ``rejected_columns``; with ``strict`` it ends the job.
    """
    fields = T.StructType.fromDDL(ddl).fields
    have = set(df.columns)

    def cast(f: T.StructField) -> Column:
        value = F.col(f.name) if f.name in have else F.lit(None)
        return value.cast(f.dataType) if strict or f.name not in have else value.try_cast(f.dataType)

    misfits = [
        F.when(F.col(f.name).isNotNull() & cast(f).isNull(), F.lit(f.name)) for f in fields if f.name in have
    ]
    extra = [F.array_compact(F.array(*misfits)).cast("array<string>").alias(REJECTED)] if rejects else []
    return df.select(*[cast(f).alias(f.name) for f in fields], *extra)


def _folders(spark: SparkSession, path: str, column: str, outer: Sequence[str] = ()) -> list[tuple[str, object]]:
    """The slice folders of a stored table, with the slice's value as text."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = "/".join(f"{c}=*" for c in [*outer, column])
    found = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(((unescape(x.getPath().getName().split("=", 1)[1]), x.getPath()) for x in found), key=lambda x: x[0])


@dataclass(frozen=True)
class Slice:
    """A slice folder of a stored table: its values as text (None: no value), place and time of change."""

    values: tuple[str | None, ...]
    path: str
    changed: int


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed by the folder format


def slices_of(
    spark: SparkSession, path: str, columns: Sequence[str], wanted: Callable[[str | None], bool] = lambda _: True
) -> list[Slice]:
    """The slices of a table split by ``columns``; only those whose first value is ``wanted`` are listed.

    One listing per folder above the last column, and no file is opened.  ``changed`` is what the
    file system says of the folder; stores that keep no such time always say 0.
    """
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = [Slice((), path, 0)]
    for depth, column in enumerate(columns):
        inner = []
        for outer in found:
            root = jvm.org.apache.hadoop.fs.Path(outer.path)
            for status in files.listStatus(root) if files.exists(root) else []:
                name = status.getPath().getName()
                if not status.isDirectory() or not name.startswith(f"{column}="):
                    continue
                text = name.split("=", 1)[1]
                value = None if text == NO_VALUE else unescape(text)
                if depth or wanted(value):
                    inner.append(Slice((*outer.values, value), status.getPath().toString(), status.getModificationTime()))
        found = inner
    return sorted(found, key=lambda x: [(v is not None, v or "") for v in x.values])


def read_slices(spark: SparkSession, path: str, slices: Sequence[Slice], types: dict[str, str]) -> DataFrame:
    """The rows of some slices: nothing else is listed or opened.  ``types`` are those of the slice columns."""
    rows = spark.read.option("basePath", path).parquet(*[x.path for x in slices])
    return rows.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()})


def drop_slices(
    spark: SparkSession,
    path: str,
    column: str,
    gone: Callable[[str], bool],
    outer: Sequence[str] = (),
    order: Callable[[str], int] = lambda _: 0,
) -> list[str]:
    """Removes the folders of slices whose value (as text) is ``gone``, by ``order``; returns the values.

    ``outer`` names the folder columns above ``column``.
    """
    out = []
    for value, folder in sorted(_folders(spark, path, column, outer), key=lambda found: order(found[0])):
        if gone(value):
            files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if not files.delete(folder, True) and files.exists(folder):
                raise OSError(f"{folder.toString()} could not be removed")
            out.append(value)
    return out


def expire(
    spark: SparkSession, path: str, column: str, today: dt.date, days: int = 30, written: str | None = None
) -> list[str]:
    """Removes day folders older than ``days`` before ``today``; whole folders, no rewrite.

    Rows without a day lie in a folder of their own, which is kept; with ``written``, the column
    that says when a row was stored, it is reduced to the rows written since (or without that).
    """
    first = today - dt.timedelta(days=days)
    gone = drop_slices(spark, path, column, lambda day: day != NO_VALUE and day < first.isoformat())
    undated = slices_of(spark, path, [column], lambda day: day is None) if written else []
    if undated:
        rows = read_slices(spark, path, undated, {column: "date"})
        stale = F.col(written) < F.lit(first)
        if not rows.where(stale).isEmpty():
            kept = cut_lineage(rows.where(~F.coalesce(stale, F.lit(False))))
            if kept.isEmpty():
                drop_slices(spark, path, column, lambda day: day == NO_VALUE)
            else:
                replace_slice(kept, path, [column], one_slice=True)
            gone.append(NO_VALUE)
    return gone


def load_staged(spark: SparkSession, staged: str, path: str, ddl: str, slice_by: Sequence[str]) -> None:
    """Staged Parquet into a warehouse folder under its contract schema."""
    replace_slice(conform(spark.read.parquet(staged), ddl), path, slice_by)


def counted(write: Callable[[Callable[[DataFrame], DataFrame]], None], **metrics: Column) -> dict:
    """Run a write and return metrics of the rows it wrote, without a second pass.

    ``write`` is given the observer and passes it on as ``seen`` (or applies it
    to the frame it writes).  It belongs behind the last exchange: there a task
    counts once, while a stage in front of an exchange may run again when an
    executor is lost, and would be counted again.
    """
    watch = Observation()
    extra = [column.alias(name) for name, column in metrics.items()]
    write(lambda df: df.observe(watch, F.count(F.lit(1)).alias("rows"), *extra))
    return watch.get


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that break a uniqueness contract, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def retained(df: DataFrame, time_col: str, as_of, days: int = 30) -> DataFrame:
    """Rows inside the time to live."""
    return df.where(F.col(time_col) >= before(as_of, f"{days} DAY"))


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def publish_layers(
    spark: SparkSession,
    models: Sequence[tuple[str, Callable[[SparkSession], DataFrame], str]],
    folder: str | None = None,
) -> None:
    """Build models in dependency order: (name, function of the session, kind).

    A ``view`` stays a plan, a ``table`` is stored (under ``folder`` if given);
    later models read earlier ones by name.
    """
    for name, build, kind in models:
        if kind == "view":
            build(spark).createOrReplaceTempView(name)
            continue
        writer = build(spark).write.mode("overwrite").format("parquet")
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.saveAsTable(name)
