"""What the operators of this subpackage share: shared storage, sizes and column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
#: Rows, and bytes of text, that a Python stage takes at once; long texts then stay within a worker's memory.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local run takes a temporary folder; a cluster has none that all could read, which is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = current.get() if current.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="pagefold-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


#: Folders made while a run tidies up after itself, else nothing.
_made: list[list[str]] = []


def fresh_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/pagefold-{what}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(path)
    return path


def written(df: DataFrame, what: str, path: str | None = None) -> DataFrame:
    """The rows, computed once and kept in the shared folder: lineage is cut and a lost executor costs nothing."""
    path = path or fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def tidied(spark: SparkSession, keep: str) -> Iterator[None]:
    """Deletes the folders made inside, but for `keep`, once what is computed inside is written."""
    made: list[str] = []
    _made.append(made)
    try:
        yield
    finally:
        _made.remove(made)
        for path in made:
            if path != keep:
                remove(spark, path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def slices(batches: Iterator[pa.RecordBatch], text: int, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut up, so that none has more than so many rows, nor more bytes in column `text` unless in one row.

    Spark bounds a batch by rows and bytes too, but what a stage makes of its texts takes several times their size.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, min(start + rows, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, end - start)
            start, before = end, int(ends[end - 1])


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is computed inside: many where rows are short, few where they are whole texts."""
    before = spark.conf.get(ARROW_ROWS, "10000")
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, whatever else the table has; a column's name is matched as written."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


#: Rows of keys (16 bytes each, about 64 as a hashed relation) that are broadcast at most.
BROADCAST_KEYS = 200_000


def keep_marked(docs: DataFrame, key: str, sign: Column, marks: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, less those that marks drops.

    marks: __key, __sign (as `sign` makes it from a row), __kept, __n (rows alike), one row per key and sign, all
    in written storage. Rows not in marks stay. Of rows alike that are kept the greatest by its columns stays.
    Short lists are broadcast, after a count; long ones are joined by a shuffle.
    """
    names = docs.columns
    gone, again = marks.filter("not __kept"), marks.filter("__kept and __n > 1")
    n_gone, n_again = gone.count(), again.count()
    meets = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("__row_sign") == F.col("__sign"))
    pick = lambda x, n: F.broadcast(x.select("__key", "__sign")) if n <= BROADCAST_KEYS else x.select("__key", "__sign")
    back = [F.col(f"`{c}`") for c in names]
    out = docs.withColumn("__row_sign", sign)
    if n_gone:
        out = out.join(pick(gone, n_gone), meets, "left_anti")
    if not n_again:
        return out.select(*back)
    tied = out.join(pick(again, n_again), meets, "left_semi").groupBy(F.col(f"`{key}`").alias("__k"), "__row_sign").agg(F.max(F.struct(*back)).alias("__row")).select("__row.*")
    return out.join(pick(again, n_again), meets, "left_anti").select(*back).unionByName(tied)


class Memo(dict):
    """What a Python worker remembers of words: those of the latest generations, so that frequent words stay.

    When it holds `most` words it begins anew, and takes words over from the generation before as they come up again.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.before = most, {}

    def missing(self, words: set, turn: bool = True) -> list:
        """The words to be worked out; afterwards and until the next call with `turn`, all others are here."""
        new = words.difference(self)
        if turn and len(self) + len(new) > self.most:
            self.before = dict(self)
            self.clear()
            new = words
        get, out = self.before.get, []
        for w in new:
            v = get(w)
            if v is None:
                out.append(w)
            else:
                self[w] = v
        return out
