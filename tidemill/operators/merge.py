"""Upserts, inserts of absent keys and sync marks, on immutable files.

Updates are reduced to one row per key before they are joined, map-side, so a
key that is updated very often costs one row per task.  Stored tables hold each
key once; the joins are therefore one to one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.dedup import latest_per_key, orderable
from tidemill.session import cut_lineage
from tidemill.sinks.tables import drop_slices, replace_slice

BUCKET = "key_bucket"


def last_written(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, field by field: the last value that is not NULL.

    Ties are broken by the values themselves.  Rows without a key are left out.
    """
    comparable = set(orderable(rows))

    def last(name: str) -> Column:
        tie = [F.col(name).alias("tie")] if name in comparable else []
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.struct(*order, *tie))).alias(name)

    fields = [c for c in rows.columns if c not in keys]
    keyed = rows.where(has_key(keys))
    if not fields:
        return keyed.select(*keys).distinct()
    return keyed.groupBy(*keys).agg(*[last(c) for c in fields]).select(*rows.columns)


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    null_overwrites: bool = False,
    newest_wins: bool = False,
) -> DataFrame:
    """Field-wise last write wins; updates of one key apply in ``order``.

    Without ``order`` the updates hold each key once, as ``base`` does.

    By default a NULL in an update leaves the stored value alone, as when NULL
    fields are not sent.  With ``null_overwrites`` every field that the update
    frame has replaces the stored one.  Fields only one side has are kept.
    An update beats the stored row, unless ``newest_wins``: then ``order``
    decides between them too, so a late update does not undo a newer row.
    """
    fields = [c for c in updates.columns if c not in keys]
    fresh = updates.where(has_key(keys))
    if order:
        reduce = latest_per_key if null_overwrites else last_written
        fresh = reduce(fresh, keys, order)
    fresh = fresh.withColumn("is_update", F.lit(True)).alias("u")
    joined = base.where(has_key(keys)).alias("b").join(fresh, list(keys), "full_outer")

    first = F.col("is_update")  # whether the update's value goes before the stored one
    if newest_wins:
        sides = [F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in "ub"]
        first = first & (sides[0] >= sides[1])

    def field(name: str) -> Column:
        if name not in updates.columns:
            return F.col(f"b.{name}")
        if name not in base.columns:
            return F.col(f"u.{name}")
        new, old = F.col(f"u.{name}"), F.col(f"b.{name}")
        if null_overwrites:
            return F.when(first, new).otherwise(old)
        return F.when(first, F.coalesce(new, old)).otherwise(F.coalesce(old, new))

    names = [*base.columns, *[c for c in fields if c not in base.columns]]
    return joined.select(*[F.col(c) if c in keys else field(c).alias(c) for c in names])


def insert_absent(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per new key; append them to ``base``.

    Of several rows of a new key the first in ``order`` is taken, as an insert that
    leaves known keys alone would.  Rows with a NULL in the key are left out.
    """
    known = base.select(*keys).distinct()
    first = latest_per_key(updates.where(has_key(keys)), keys, order, oldest=True)
    return first.join(known, list(keys), "left_anti")


def mark(base: DataFrame, done: DataFrame, keys: Sequence[str], flag: str = "synced") -> DataFrame:
    """``flag`` set to True on exactly the rows whose key is in ``done``."""
    hits = done.select(*keys).distinct().withColumn("is_done", F.lit(True))
    joined = base.join(hits, list(keys), "left")
    value = F.when(F.col("is_done"), True).otherwise(F.col(flag) if flag in base.columns else F.lit(False))
    return joined.withColumn(flag, value).select(*base.columns, *([] if flag in base.columns else [flag]))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The folder column of a keyed table without a natural slice."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_into(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: str | None = None,
    buckets: int = 64,
    null_overwrites: bool = False,
    newest_wins: bool = False,
) -> None:
    """Upsert into a keyed Parquet folder; only touched slices are rewritten.

    ``slice_by`` names a folder column (such as the creation date).  A key lives in the
    slice in which it was stored first: an update that names another slice, or none, goes to
    that one, so a table never holds a key twice.  Finding it reads the table's key columns
    only; then the few slices that the batch touches are rewritten.  Without ``slice_by``
    the table is split by a hash of the key, which suits small serving tables.  Every write
    carries the columns of the table (``conform`` adds missing ones).  Writing the same
    updates again gives the same table, so a replayed micro-batch does no harm.
    """
    bucketed = slice_by is None
    if bucketed:
        updates, slice_by = with_bucket(updates, keys, buckets), BUCKET
    updates = updates.where(has_key(keys))
    stored = stored_rows(spark, path)
    if stored is not None:
        # Folder values are read back with a guessed type.
        stored = stored.withColumn(slice_by, F.col(slice_by).cast(updates.schema[slice_by].dataType))
        if not bucketed:
            updates = _at_home(stored, updates, keys, slice_by)
        slices = updates.select(slice_by).distinct()
        stored = stored.join(slices, stored[slice_by].eqNullSafe(slices[slice_by]), "left_semi")
    else:
        stored = updates.limit(0)
    merged = upsert(stored, updates, keys, order, null_overwrites, newest_wins)
    replace_slice(merged, path, [slice_by], keys)


def _at_home(stored: DataFrame, updates: DataFrame, keys: Sequence[str], slice_by: str) -> DataFrame:
    """The updates with the slice in which their key is stored; new keys keep their own."""
    touched = updates.select(*keys).distinct()
    homes = stored.join(touched, list(keys), "left_semi").select(*keys, F.struct(slice_by).alias("home"))
    found = updates.join(homes, list(keys), "left")
    own = F.when(F.col("home").isNull(), F.col(slice_by)).otherwise(F.col(f"home.{slice_by}"))
    return found.withColumn(slice_by, own).select(*updates.columns)


# -- tables as deltas -------------------------------------------------------------

BATCH = "batch_id"


def add_delta(rows: DataFrame, path: str, batch_id: int, slice_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """One batch's updates as slices of their own: the cost is that of the batch, not of the
    table, and a replayed batch replaces its own slices."""
    rows = rows.withColumn(BATCH, F.lit(batch_id))
    replace_slice(rows, path, [*slice_by, BATCH], sort_by, one_slice=not slice_by)


def current(deltas: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by_field: bool) -> DataFrame:
    """One row per key: the greatest ``order``, or by field the last value that is not NULL."""
    return last_written(deltas, keys, order) if by_field else latest_per_key(deltas.where(has_key(keys)), keys, order)


def settle(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order: Sequence[str | Column],
    by_field: bool,
    slice_by: Sequence[str] = (),
) -> int:
    """Folds all stored batches into slices of their own; ``current`` gives the same before and after.

    Run it now and then, while no batch is being written.  The folded rows get a new id below
    all stored ones, so the last batch, which a restarted stream may replay, never overwrites
    them, and what it has stands above them again.  They are written first, the batches
    removed then, the earliest first: a run that breaks off between leaves both, and the view
    is still the same.  Returns the number of batches folded.
    """
    deltas = spark.read.parquet(path)
    batches = sorted(row[0] for row in deltas.select(BATCH).distinct().toLocalIterator())
    if len(batches) < 2:
        return 0
    settled = min(0, batches[0]) - 1
    folded = cut_lineage(current(deltas, keys, order, by_field)).withColumn(BATCH, F.lit(settled))
    replace_slice(folded, path, [*slice_by, BATCH], keys, one_slice=not slice_by)
    drop_slices(spark, path, BATCH, lambda batch: int(batch) != settled, outer=slice_by, order=int)
    return len(batches) - 1


def has_key(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        condition = condition & F.col(key).isNotNull()
    return condition


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a Parquet folder, or None while nothing is stored in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
