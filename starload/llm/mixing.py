"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets the exponential key ``-ln(u) / quality`` with ``u`` a hash
of its identifier, so that documents sorted by the key within their source are
a weighted random order (Efraimidis-Spirakis).  A source's target is met by
complete epochs over all its documents first; the rest is the start of that
order, up to the token budget, with the last document taken in part.

The order and its prefix sums are built without a task that sees a whole
source: the key range is cut into ``BUCKETS`` slices, rows are sorted and
summed within (source, slice), and the slice totals, pre-aggregated, give each
slice its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import materialize, with_row

#: Slices of the key range within a source; a source of 10**10 documents has
#: some 10**6 in each.
BUCKETS = 8192

#: Names of the columns that mixing adds, for a time or for good.
_ADDED = {"source_size", "target", "epochs", "fraction", "taken", "_key", "_bucket", "_null", "_name",
          "_source", "_offset", "_upto", "_in_bucket"}


def uniform(ident: Column, seed: int) -> Column:
    """A number in (0, 1) from the identifier alone, equal in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], ratio: tuple[int, int], most: int) -> DataFrame:
    """Targets of the sources: ``source, source_size`` plus ``weight, target``.

    Sources in code point order, null last, take ``weights`` in turn and share
    ``ratio`` of the total size; no target exceeds ``most`` times its source's
    size, and what is cut off is shared by weight among the others until none
    is above.  That ends with all others at one level ``budget / weight``, so
    it is found by sorting the sources by ``size / weight`` (one row a source).
    """
    up, down = ratio
    everything = Window.partitionBy(F.lit(0))
    turn = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(turn) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long")
    ranked = sizes.select("source", "source_size", weight.alias("weight"))
    by_room = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")
    ).rowsBetween(Window.unboundedPreceding, -1)
    # if this source and all with more room stay under their caps, each unit of weight gets num / den
    num = up * F.sum("source_size").over(everything) - down * most * F.coalesce(
        F.sum("source_size").over(by_room), F.lit(0))
    den = down * (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0)))
    level = ranked.withColumns({"num": num, "den": den})
    fits = F.col("weight") * F.col("num") <= most * F.col("source_size") * F.col("den")
    found = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), "num", "den"))).over(everything)
    level = level.withColumn("level", found)
    cap = (most * F.col("source_size")).cast("double")
    share = (F.col("weight") * F.col("level.num")).cast("double") / F.col("level.den").cast("double")
    return level.select(
        "source", "source_size", "weight",
        F.least(cap, F.coalesce(share, cap)).alias("target"),
    )


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    ratio: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: int = 7,
) -> DataFrame:
    """Sampling decisions for ``docs`` (``id, source, size, quality`` and others).

    Adds ``source_size``, ``target``, ``epochs`` (complete passes), ``fraction``
    (tokens taken once more, from the front of the weighted order) and
    ``taken = epochs * size + fraction``.  Null sources form a source of their
    own.  Null sizes count as 0, null or non-positive qualities as 1.  Rows
    that repeat an identifier share its key and are ordered by size; equal
    rows are interchangeable.  Documents of size 0 take 0; an empty table stays
    empty.  Other columns are kept; those with the name of a new column, or one
    of those used in between (``_ADDED``), are replaced.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() not in _ADDED))
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    quality = F.when(F.col("quality") > 0, F.col("quality")).otherwise(F.lit(1.0))
    key = -F.log(uniform(F.col("id"), seed)) / quality
    rows = docs.withColumns({"size": size, "_key": key})
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(spark, source_targets(sizes, weights, ratio, most), "targets").select(
        F.col("source").alias("_source"), "source_size", "target"
    )
    rows = rows.withColumns({
        "_bucket": F.floor((1 - F.exp(-F.col("_key"))) * BUCKETS).cast("int"),
        # a null source joins and sorts like any other
        "_null": F.col("source").isNull(),
        "_name": F.coalesce(F.col("source"), F.lit("")),
    })
    totals = rows.groupBy("_null", "_name", "_bucket").agg(F.sum("size").alias("_in_bucket"))
    before = Window.partitionBy("_null", "_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_null", "_name", "_bucket",
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy("_null", "_name", "_bucket").orderBy("_key", "id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumn("_upto", F.sum("size").over(inside)).join(offsets, ["_null", "_name", "_bucket"])
    both = summed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0).cast("long")
    rest = F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs") * F.col("source_size")
    fraction = F.least(
        F.col("size"),
        F.greatest(F.lit(0), rest - (F.col("_offset") + F.col("_upto") - F.col("size"))),
    )
    return (
        both.withColumn("epochs", epochs)
        .withColumn("fraction", fraction)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("fraction"))
        .select(*docs.columns, "source_size", "target", "epochs", "fraction", "taken")
    )


def quality_of(labels: DataFrame) -> DataFrame:
    """``id, quality``: weight 2 for documents labelled good, 0.5 for bad ones.

    Several labels of one document count as their largest; null labels as none.
    """
    best = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    best = best.groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("best"))
    return best.select("id", F.when(F.col("best") > 0, 2.0).otherwise(0.5).alias("quality"))


def mixed(spark: SparkSession, docs: DataFrame, labels: DataFrame, size: Column, id_col: str, source_col: str, **how) -> DataFrame:
    """The rows of the written table ``docs`` as often as the mix takes them,
    with all columns: once for each complete epoch, and once more, whole, if any
    of their tokens are in the fractional part."""
    rows, at = with_row(docs)
    narrow = rows.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.col(at).alias("at"))
    narrow = narrow.join(quality_of(labels), "id", "left")
    times = (F.col("epochs") + F.when(F.col("fraction") > 0, 1).otherwise(0)).cast("int")
    taken = mix(spark, narrow, **how).where("taken > 0").select(F.col("at").alias(at), times.alias("times"))
    taken = materialize(spark, taken.select(at, F.explode(F.sequence(F.lit(1), "times")).alias("n")), "taken")
    # the files' names make this table look small enough for a broadcast, which it is not
    return rows.join(taken.select(at).hint("shuffle_hash"), at).select(*docs.columns)
