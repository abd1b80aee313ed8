"""Delimited files with line ends inside quoted fields, read by many tasks.

Whether a line end closes a record depends on all quotes before it, which is
why Spark's own ``multiLine`` reader gives a whole file to one task.  Here a
file stays cut into blocks.  A line end is a record's end if the number of
quotes before it is even, so each block needs one bit from the blocks before:

1. A narrow pass counts each line's quotes and returns one row a block: whether
   their number is odd, and whether a record ends in it, if the block begins
   outside or inside of quotes.  The running sum over these rows tells how each
   block begins.
2. The lines are read again and put together to records within their block, on
   Arrow arrays.
3. What a block's edges cut off, two pieces a block at most, is joined to
   records by an exchange of those pieces alone.

Records are then parsed by ``from_csv`` in the JVM.  The values that a row of the
block table holds do not depend on how Spark cut the files in that pass; a
block that it does not know raises.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.session import checkpoint_dir

BOM = "﻿"

_KEY = ("f1", "f2", "block")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their file, as 96 bits of hash, and their block."""
    file = F.col("_metadata.file_path")
    return spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)).select(
        F.xxhash64(file).alias("f1"), F.hash(file).alias("f2"),
        F.col("_metadata.file_block_start").alias("block"), "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of a batch that are of one block: its key, and from where to where."""
    columns = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in _KEY]
    if not batch.num_rows:
        return
    change = np.zeros(batch.num_rows - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        yield tuple(int(c[low]) for c in columns), low, high


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block from the numbers of quotes of its lines."""
    known: dict[tuple, list[int]] = {}  # odd so far, a line is even, a line is odd
    for batch in batches:
        quotes = batch.column(batch.schema.get_field_index("quotes")).to_numpy()
        for key, low, high in _runs(batch):
            state = known.setdefault(key, [0, 0, 0])
            odd = (state[0] + np.cumsum(quotes[low:high])) & 1
            state[0] = int(odd[-1])
            state[1] |= int((odd == 0).any())
            state[2] |= int(odd.any())
    rows = [(*key, bool(a), bool(b), bool(c)) for key, (a, b, c) in known.items()]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
        [*_KEY, "odd", "ends_outside", "ends_inside"])


def block_states(lines: DataFrame) -> DataFrame:
    """For each block: whether it begins ``inside`` of quotes, and if so, in which
    block (``opened``) the record began that reaches into it."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    rows = lines.select(*_KEY, quotes.alias("quotes")).mapInArrow(
        _block_rows, "f1 long, f2 int, block long, odd boolean, ends_outside boolean, ends_inside boolean")
    earlier = Window.partitionBy("f1", "f2").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    rows = rows.withColumn("inside", inside)
    opens = (F.col("inside") != F.col("odd")) & (~F.col("inside") | F.col("ends_inside"))
    rows = rows.withColumn("opens", opens)
    opened = F.last(F.when(F.col("opens"), F.col("block")), ignorenulls=True).over(earlier)
    checkpoint_dir(lines.sparkSession)
    return rows.select(*_KEY, "inside", opened.alias("opened")).checkpoint()


_PARTS = "f1 long, f2 int, opened long, block long, head boolean, value string"


class _Stitcher:
    """Puts the lines of blocks together to records.

    ``whole`` records are those that begin and end in a block; the others, pieces
    of records, carry the block in which their record began.
    """

    def __init__(self, whole: bool):
        self.whole = whole
        self.key: tuple | None = None  # the block that lines are of

    def _begin(self, key: tuple, inside: bool, opened: int | None) -> None:
        self.key, self.inside, self.opened = key, inside, opened
        self.odd, self.ended, self.rest = int(inside), False, []

    def _piece(self, lines: list[pa.Array], opened: int) -> pa.RecordBatch:
        text = "\n".join(v for part in lines for v in part.to_pylist())
        f1, f2, block = self.key
        values = ([f1], [f2], [opened], [block], [block == 0 and not self.ended], [text])
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in _PARTS.split(", ")])

    def _end(self) -> Iterator[pa.RecordBatch]:
        """What is open at a block's end is a piece."""
        if self.key is not None and self.rest and not self.whole:
            through = self.inside and not self.ended
            yield self._piece(self.rest, self.opened if through else self.key[2])

    def _records(self, values: pa.Array, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The records that the lines of a stretch complete."""
        first = [*self.rest, values.slice(0, int(ends[0]) + 1)]
        head = self.key[2] == 0 and not self.ended
        if self.inside and not self.ended:
            if not self.whole:
                yield self._piece(first, self.opened)
        elif self.whole:
            yield self._batch(pa.array(["\n".join(v for part in first for v in part.to_pylist())], pa.string()), head)
        if self.whole and len(ends) > 1:
            more = values.slice(int(ends[0]) + 1, int(ends[-1] - ends[0]))
            if len(more) > len(ends) - 1:
                offsets = pa.array((np.concatenate((ends[:1], ends[1:])) - ends[0]).astype(np.int32))
                more = pc.binary_join(pa.ListArray.from_arrays(offsets, more), "\n")
            yield self._batch(more, False)
        self.ended = True

    @staticmethod
    def _batch(values: pa.Array, head: bool) -> pa.RecordBatch:
        heads = pa.array(np.full(len(values), head))
        return pa.RecordBatch.from_arrays([heads, values], ["head", "value"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            quotes = pc.count_substring(at["value"], '"').to_numpy()
            for key, low, high in _runs(batch):
                if key != self.key:
                    yield from self._end()
                    self._begin(key, at["inside"][low].as_py(), at["opened"][low].as_py())
                odd = (self.odd + np.cumsum(quotes[low:high])) & 1
                self.odd = int(odd[-1])
                ends = np.flatnonzero(odd == 0)
                values = at["value"].slice(low, high - low)
                if len(ends):
                    yield from self._records(values, ends)
                    values, self.rest = values.slice(int(ends[-1]) + 1), []
                if len(values):
                    self.rest.append(values)
        yield from self._end()


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``value``, each record of the files as it stands there, line ends inside
    quotes included, and whether it is the ``head`` (first) of its file."""
    lines = _lines(spark, path)
    # one narrow row for each block, of which the plan of the scan holds more
    states = F.broadcast(block_states(lines))
    known = lines.join(states, list(_KEY), "left").select(
        *_KEY, "opened", "value",
        F.when(F.col("inside").isNull(), F.raise_error(F.lit("the files were cut in other places; read them again")))
        .otherwise(F.col("inside")).alias("inside"),
    )
    whole = known.mapInArrow(_Stitcher(True).__call__, "head boolean, value string")
    pieces = known.mapInArrow(_Stitcher(False).__call__, _PARTS).groupBy("f1", "f2", "opened").agg(
        F.bool_or("head").alias("head"), F.sort_array(F.collect_list(F.struct("block", "value"))).alias("p"))
    joined = pieces.select("head", F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
    every = whole.unionByName(joined)
    return every.withColumn("value", F.regexp_replace("value", "\r\\z", "")).where("value != ''")


def parsed(value: Column, schema: StructType, options: dict[str, str]) -> Column:
    """A record as a struct of ``schema``'s columns."""
    return F.from_csv(value, schema.simpleString(), options)


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    options: dict[str, str],
    header: bool = True,
) -> DataFrame:
    """The files' records as rows of ``schema``; the first record of each file is
    its header.  ``options`` are those of Spark's CSV reader.

    A quote inside a field must be doubled, and such a field quoted, as
    ``export_csv`` writes it: quotes are counted before fields are known.  Nothing
    but the pass over the quotes runs at once; rows come when they are asked for.
    """
    found = records(spark, path)
    if header:
        found = found.where(~F.col("head"))
    else:
        found = found.withColumn("value", F.regexp_replace("value", f"^{BOM}", ""))
    row = parsed(F.col("value"), schema, {"multiLine": "true", **options})
    return found.select(row.alias("r")).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
