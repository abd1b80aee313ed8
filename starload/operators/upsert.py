"""Dimension upsert with soft expiry and fact day-range replacement.

File tables take neither ``MERGE`` nor ``UPDATE``, so every operator here is a
pure function from the current snapshot (plus the new rows and one load
timestamp) to the next snapshot; the sinks write it as a new version.

Audit columns of every stage table: ``id``, ``dt_create``, ``dt_update``,
``is_actual``.  One ``load_ts`` value is used for the whole load, never a
per-row clock.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.filters import between_days
from starload.operators.joins import hash_side
from starload.operators.keys import assign_keys, max_id
from starload.operators.quality import check_unique, require_empty

AUDIT_COLUMNS = ["dt_create", "dt_update", "is_actual"]


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def with_audit(df: DataFrame, load_ts) -> DataFrame:
    """Add ``dt_create = dt_update = load_ts`` and ``is_actual = true``."""
    ts = _ts(load_ts)
    return df.select(
        "*",
        ts.alias("dt_create"),
        ts.alias("dt_update"),
        F.lit(True).alias("is_actual"),
    )


def insert_new(
    rows: DataFrame,
    order_cols: Sequence[str],
    load_ts,
    start: int,
    id_col: str = "id",
) -> DataFrame:
    """New rows with ids after ``start`` and fresh audit columns."""
    keyed = assign_keys(rows, order_cols, start=start, id_col=id_col)
    return with_audit(keyed, load_ts)


def initial_load(
    source: DataFrame, columns: Sequence[str], load_ts, order_cols: Sequence[str] | None = None
) -> DataFrame:
    """First fill of a dimension: straight insert-select, no de-duplication (M6)."""
    rows = source.select(*columns)
    return insert_new(rows, order_cols or list(columns), load_ts, start=0)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    load_ts,
    update_cols: Sequence[str] = (),
    insert_cols: Sequence[str] | None = None,
    id_col: str = "id",
    check_source_unique: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """``MERGE`` of ``source`` into ``target`` on ``keys`` (M1, M2).

    * matched: ``dt_update = load_ts``; every ``update_cols`` column takes the
      source value, NULL included (type-1 overwrite); ``is_actual`` is left as
      it is, so an expired row is not revived;
    * not matched: inserted with the next ids, ``dt_create = dt_update =
      load_ts``, ``is_actual = true``;
    * target rows without a source row are unchanged (see ``expire_unseen``).

    A source key that occurs twice would update one target row twice; as in
    SQL ``MERGE`` that is an error (checked unless disabled).  Repeated source
    rows without a target row are all inserted.  Matching is a
    left join of the target with the source, and the new rows are the source
    rows whose key no matched target row has (an anti join against keys
    only); keys that match are unique on each side, so none can be hot.  The
    target is sorted for neither if a task can hold its part of the source
    (``hash_side``); ``tasks`` is their number where the target lies in buckets.
    """
    insert_cols = list(insert_cols) if insert_cols is not None else [
        c for c in target.columns if c not in (id_col, *AUDIT_COLUMNS)
    ]
    if check_source_unique:
        # only the few repeated keys meet the target, if there are any
        repeated = check_unique(source, keys)
        if not repeated.isEmpty():
            repeated = repeated.join(target.select(*keys), list(keys), "left_semi")
            require_empty(repeated, f"several source rows match one row on {list(keys)}")
    s = source.select(
        *[F.col(f"`{c}`").alias(f"__s_{c}") for c in dict.fromkeys([*keys, *insert_cols])],
        F.lit(True).alias("__hit"),
    )
    cond = None
    for k in keys:
        c = target[k] == s[f"__s_{k}"]
        cond = c if cond is None else (cond & c)
    held = hash_side(s, tasks=tasks)
    joined = target.join(held, cond, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    ts = _ts(load_ts)

    kept = joined.select(
        *[
            F.when(hit, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
            if c in update_cols
            else (
                F.when(hit, ts).otherwise(F.col(c)).alias(c)
                if c == "dt_update"
                else F.col(c)
            )
            for c in target.columns
        ]
    )
    target_keys = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    anti = None
    for k in keys:
        c = s[f"__s_{k}"] == target_keys[f"__t_{k}"]
        anti = c if anti is None else (anti & c)
    matched = target_keys.join(held, anti, "left_semi")
    fresh_rows = s.join(matched if held is s else matched.hint("shuffle_hash"), anti, "left_anti").select(
        *[F.col(f"__s_{c}").alias(c) for c in insert_cols]
    )
    fresh = insert_new(fresh_rows, list(keys), load_ts, max_id(target, id_col), id_col)
    fresh = fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).cast(
        target.schema[c].dataType).alias(c) for c in target.columns])
    return kept.unionByName(fresh)


def expire_unseen(target: DataFrame, load_ts) -> DataFrame:
    """``is_actual = false`` for every row with ``dt_update < load_ts`` (M3).

    Run right after ``upsert`` with the same ``load_ts``: rows the source did
    not touch are expired; with an empty source everything is.
    """
    return target.withColumn(
        "is_actual",
        F.when(F.col("dt_update") < _ts(load_ts), F.lit(False)).otherwise(F.col("is_actual")),
    )


def flag_range(fact: DataFrame, start, end, dt_col: str = "dt") -> DataFrame:
    """Existing facts with ``date(dt)`` in [start, end] become not actual;
    ``dt_update`` is untouched."""
    return fact.withColumn(
        "is_actual",
        F.when(between_days(dt_col, start, end), F.lit(False)).otherwise(F.col("is_actual")),
    )


def replace_range(
    fact: DataFrame,
    new_rows: DataFrame,
    load_ts,
    mode: str = "append",
    start="1900-01-01",
    end="1900-01-01",
    dt_col: str = "dt",
    order_cols: Sequence[str] | None = None,
    id_col: str = "id",
    delete: bool = False,
) -> DataFrame:
    """Append new facts; with ``mode='replace'`` first flag the day range (M4).

    ``append`` is a plain append: running the same load twice doubles the
    facts, exactly as the procedure it mirrors.  ``delete=True`` is the hard
    variant of ``replace``: rows in the range are removed instead of flagged.
    """
    if mode != "replace":
        current = fact
    elif delete:
        # a NULL date is outside every range: the row stays
        current = fact.where(~F.coalesce(between_days(dt_col, start, end), F.lit(False)))
    else:
        current = flag_range(fact, start, end, dt_col)
    order = list(order_cols) if order_cols else [c for c in new_rows.columns]
    added = insert_new(new_rows, order, load_ts, max_id(fact, id_col), id_col)
    added = added.select(*fact.columns)
    return current.unionByName(added)
