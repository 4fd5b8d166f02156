"""Loads into a table whose keys must stay unique, by a rule for conflicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.dedup import latest_per_key
from tidemill.operators.merge import has_key, stored_rows
from tidemill.session import cut_lineage
from tidemill.sinks.tables import counted, drop_slices, duplicate_keys, replace_slice

LOAD = "load_id"
SHOWN = 5


class KeyConflict(ValueError):
    """Keys that are stored already, or that a load holds twice."""


def load_unique(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    load_id: str,
    on_conflict: str = "fail",
    order: Sequence[str | Column] = (),
) -> int:
    """Stores a load as a slice of its own; returns the number of rows written.

    Of a key that other loads have stored, ``fail`` raises before anything is written,
    ``ignore`` keeps the stored row, ``replace`` the new one: only loads that hold such a key
    are rewritten.  Of a key that the load holds twice, ``fail`` raises, ``ignore`` takes the
    first in ``order``, ``replace`` the last.  Rows with a NULL in the key conflict with nothing.

    Stored rows are compared by their key columns only, in a semi join, for which the
    optimizer may send a Bloom filter of the new keys to the scan.  A load that is run again
    replaces its own slice and does not conflict with itself.
    """
    if on_conflict not in ("fail", "ignore", "replace"):
        raise ValueError(f"no rule for conflicts: {on_conflict}")
    keyed, free = rows.where(has_key(keys)), rows.where(~has_key(keys))
    if on_conflict == "fail":
        _refuse(duplicate_keys(keyed, keys), keys, "given twice")
    else:
        keyed = latest_per_key(keyed, keys, order, oldest=on_conflict == "ignore")
    stored = stored_rows(spark, path)
    touched = []
    if stored is not None:
        others = stored.where(F.col(LOAD) != load_id)
        names, asked = list(keys), keyed.select(*keys)
        hits = others.select(*keys, LOAD).join(asked, names, "left_semi")
        if on_conflict == "fail":
            _refuse(hits, keys, "stored already")
        elif on_conflict == "ignore":
            keyed = keyed.join(hits.select(*keys), names, "left_anti")
        else:
            touched = [r[0] for r in hits.select(LOAD).distinct().collect()]  # names of loads
            kept = others.where(F.col(LOAD).isin(touched)).join(asked, names, "left_anti")
            kept = cut_lineage(kept) if touched else None
    new = keyed.unionByName(free).withColumn(LOAD, F.lit(load_id))
    # What is written may be read from the same table: it is settled first.
    new = cut_lineage(new) if stored is not None else new
    written = counted(lambda seen: replace_slice(new, path, [LOAD], keys, one_slice=True, seen=seen))["rows"]
    if not written:
        drop_slices(spark, path, LOAD, lambda load: load == load_id)
    if touched:
        # The new rows are stored by now: a run that ends here leaves both, and the next one mends it.
        replace_slice(kept, path, [LOAD], keys)
        left = {r[0] for r in kept.select(LOAD).distinct().collect()}
        drop_slices(spark, path, LOAD, lambda load: load in touched and load not in left)
    return written


def _refuse(conflicts: DataFrame, keys: Sequence[str], what: str) -> None:
    found = conflicts.select(*keys).limit(SHOWN).collect()
    if found:
        raise KeyConflict(f"keys {what}, such as {', '.join(str(tuple(r)) for r in found)}")
