"""Order-dependent grouping of rows: bands, segments, runs and islands.

Where a group's state depends on its own first row, the sorted rows of a key stream through a fold; a lag would give other
groups. A key is a page, a line or a user.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window


def upper_median(name: str) -> Column:
    """Aggregate: element n // 2 of the sorted values, the upper of the two middle ones. Counts of values are merged, no group is
    collected."""
    return F.expr(f"percentile_disc(0.5) within group (order by `{name}` desc)")


def folded(df: DataFrame, by: list[str], order: list[str], columns: list[str], start: tuple, step: Callable[[tuple, tuple], tuple[tuple, tuple]], out: str) -> DataFrame:
    """by, and what step(state, row) gives beside the next state, for the rows (columns) of each group in order.

    Rows are dealt out by group, sorted, and stream through one function that carries the state from row to row, so that time grows
    with the rows, and a group of any size needs the memory of one batch.
    """
    sorted_rows = df.select(*by, *order, *[c for c in columns if c not in [*by, *order]]).repartition(*by).sortWithinPartitions(*by, *order)
    keys = sorted_rows.select(*by).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.fields) + ", " + out
    names = [f.split()[0].strip("`") for f in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, target = None, start, None
        for batch in batches:
            at = batch.schema.names
            groups = list(zip(*[batch.column(at.index(c)).to_pylist() for c in by]))
            found = []
            for g, row in zip(groups, zip(*[batch.column(at.index(c)).to_pylist() for c in columns])):
                if g != group:
                    group, state = g, start
                state, result = step(state, row)
                found.append(result)
            made = list(zip(*found)) or [()] * len(names)
            target = target or [to_arrow_type(t.dataType) for t in parsed[len(by) :]]
            yield pa.RecordBatch.from_arrays([*[batch.column(at.index(c)) for c in by], *[pa.array(v, t) for v, t in zip(made, target)]], [*by, *names])

    parsed = _parse_datatype_string(schema).fields
    return sorted_rows.mapInArrow(run, schema)


def gap_segments(df: DataFrame, by: list[str], start: str, end: str, order: list[str], gap: float, out: str = "segment") -> DataFrame:
    """Numbers segments (from 1) of rows in order; a row that begins more than gap after the end of all before it opens one."""
    w = Window.partitionBy(*by).orderBy(*order)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(start) - reach > gap), 1).otherwise(0)
    return df.withColumn("__opens", opens).withColumn(out, F.sum("__opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__opens")


def layout_segments(df: DataFrame, by: list[str], start: str, end: str, height: str, order: str, gap: float = 6.0, raised_gap: float = 1.2, rise: float = 2.4) -> DataFrame:
    """Segments of the clusters of a line: a new one after a gap to all before, or after a small gap where the height
    leaves that of the segment's first cluster. Returns by, order, segment (from 1)."""

    def step(state: tuple, row: tuple) -> tuple[tuple, tuple]:
        reach, first, n = state
        o, a, b, y = row
        opens = reach is None or a - reach > gap or (a - reach > raised_gap and abs(y - first) > rise)
        n += opens
        return (b if reach is None else max(reach, b), y if opens else first, n), (o, n)

    return folded(df.withColumn(order, F.col(order).cast("bigint")), by, [start, order], [order, start, end, height], (None, None, 0), step, f"{order} bigint, segment int")


def anchored_bands(df: DataFrame, by: list[str], value: str, tolerance: float) -> DataFrame:
    """Bands of values: ascending, a value joins the band whose first value it is within tolerance of, else opens one.

    Returns by, value, leader: a row for each row, of values that are not null.
    """

    def step(state: tuple, row: tuple) -> tuple[tuple, tuple]:
        (leader,), (v,) = state, row
        leader = v if leader is None or v - leader > tolerance else leader
        return (leader,), (v, leader)

    rows = df.filter(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    return folded(rows, by, [value], [value], (None,), step, f"{value} double, leader double")


def overlaid(df: DataFrame, by: list[str], x: str, width: str, order: str, least: float = 0.3, share: float = 0.25) -> DataFrame:
    """Flags rows that stand on the last unflagged row before them: nearer than max(least, share of its width)."""

    def step(state: tuple, row: tuple) -> tuple[tuple, tuple]:
        (at, wide), (o, here, w) = state, row
        on = at is not None and here - at < max(least, wide * share)
        return (at, wide) if on else (here, w), (o, on)

    flags = folded(df.withColumn(order, F.col(order).cast("bigint")), by, [order], [order, x, width], (None, None), step, f"{order} bigint, overlaid boolean")
    return df.join(flags, [*by, order])


def islands(df: DataFrame, by: list[str], order: list[str], kind: Column, out: str = "run") -> DataFrame:
    """Numbers runs (from 1) of neighbours of the same kind."""
    w = Window.partitionBy(*by).orderBy(*order)
    marked = df.withColumn("__kind", kind)
    change = F.when(F.col("__kind").eqNullSafe(F.lag("__kind").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return marked.withColumn("__change", change).withColumn(out, F.sum("__change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__change", "__kind")


def single_separators(df: DataFrame, by: list[str], order: list[str], is_separator: Column) -> DataFrame:
    """Drops separators that follow a separator."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__sep", is_separator).withColumn("__before", F.lag("__sep").over(w)).filter(~(F.col("__sep") & F.coalesce("__before", F.lit(False)))).drop("__sep", "__before")


def merge_marks(base: Column, marks: Column) -> Column:
    """A letter with its marks: shadda first, then by place. marks: array of (x, text)."""
    key = lambda m: F.struct((m["text"] != "ّ").alias("later"), m["x"].alias("x"), m["text"].alias("text"))
    return F.concat(base, F.array_join(F.transform(F.array_sort(F.transform(marks, key)), lambda m: m["text"]), ""))
