"""Small helpers that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: Words are runs of anything but these bytes, the ones that ``bytes.split()`` splits on.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all nodes share."""
    return work_dir(spark, name)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once and read back: later jobs start from files that outlive executors.

    Spark drops the shuffle files of finished jobs when the driver's garbage
    collector has seen that nothing refers to them. Jobs here are few and large,
    so it's told to look, lest the files of all steps lie on the disks at once.
    """
    spark = df.sparkSession
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that nothing reads any more, since all that was made of them is stored."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def whole_row(docs: DataFrame):
    """All columns, whatever their names, as the struct ``row``."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("row")


def placed(docs: DataFrame, *columns) -> DataFrame:
    """``rid`` and the given columns of each row of a stored table.

    ``rid`` is the number of the row's file, in order of their paths, and its
    place in that file; so all jobs give a row the same one, however the
    files are split among tasks.
    """
    place = docs.metadataColumn("_metadata")
    path = place["file_path"].alias("_path")
    paths = sorted(r[0] for r in docs.select(path).distinct().collect())
    files = docs.sparkSession.createDataFrame([(p, n << 40) for n, p in enumerate(paths)], "_path string, _first long")
    rows = docs.select(path, place["row_index"].alias("_at"), *columns)
    names = rows.columns[2:]
    return rows.join(F.broadcast(files), "_path").select((F.col("_first") + F.col("_at")).alias("rid"), *names)


def numbered(docs: DataFrame, text: str = "text", id_col: str = "doc_id", carry: bool = False) -> DataFrame:
    """Columns ``rid``, ``doc_id`` and ``body`` (UTF-8 bytes, NULL as empty) of each row, with ``carry`` also ``row``, all its columns.

    ``rid`` tells rows apart even where ids repeat or are NULL. It follows from
    the place of a row in the files, so ``docs`` has to be a stored table.
    """
    return placed(
        docs,
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"),
        *([whole_row(docs)] if carry else []),
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a stored table but those whose ``rid`` (as ``numbered`` gives it) is in ``gone``."""
    rows = placed(docs, whole_row(docs))
    return rows.join(gone.select("rid"), "rid", "left_anti").select("row.*")


def words_of(text) -> F.Column:
    """The words of a text column as an array, JVM side; NULL and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def crc_fold(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def most_frequent(counts: DataFrame, n: str, top: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the greatest counts ``n``, at most ``top`` of them, and the others.

    Counts are cut at a sixteenth of a power of two, so that neither a sort nor
    more than about a thousand rows are needed to tell how many lie above.
    """
    step = F.floor(F.log2(F.col(n)) * 16).cast("int")
    upper, total = 64 * 16, 0
    for bucket, size in sorted(counts.groupBy(step).count().collect(), reverse=True):
        total += size
        if total > top:
            break
        upper = bucket
    return counts.filter(step >= upper), counts.filter(step < upper)


def arrow_rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of the batches, one Python tuple at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # few texts at once as Python objects
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def arrow_out(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096, weight: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows and about ``weight`` bytes."""
    held, heavy = [], 0
    for row in rows:
        held.append(row)
        heavy += sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
        if len(held) >= size or heavy >= weight:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def share(spark: SparkSession, value: object):
    """A broadcast of an object of this package, whose classes the tasks' processes don't have: its plain state."""
    return spark.sparkContext.broadcast(vars(value))


def shared(kind: type, state: dict) -> object:
    """The object again; all tasks of a process use the same state."""
    out = object.__new__(kind)
    out.__dict__ = state
    return out
