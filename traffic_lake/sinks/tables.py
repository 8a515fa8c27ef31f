"""Table sinks: append, idempotent upsert, latest snapshot, target state, fan-out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import utc_ntz
from ..schemas import BRONZE

# Fixed value: how long the latest snapshot stays valid.
SNAPSHOT_TTL = "300 seconds"

# Snapshots that are kept side by side: what a reader has begun to read stays for as many cycles, less one.
SLOTS = 16
POINTER = "number bigint, value bigint"

# A write is told by the run of its stream and the batch in that run; both are partitions.
RUN, BATCH = "run_id", "batch_id"
# Fixed value: the folder name of a partition whose value is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Partitions that a task writes at once without sorting its rows by them, which takes memory for all of its rows.
OPEN_FILES = 8


def write_batch(df: DataFrame, path: str, partitions: Sequence[str], rebalance: bool) -> None:
    """Replace exactly the partitions that ``df`` holds, so a replay is harmless."""
    if rebalance and partitions:
        # Adaptive execution merges small and splits oversized partitions here.
        df = df.hint("rebalance", *[F.col(p) for p in partitions])
    df.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def ingest_date(stamp: Column) -> Column:
    return utc_ntz(stamp).cast("date")


def key_date(key: Column) -> Column:
    """The day encoded in a time-ordered key: all versions of a key share it."""
    return ingest_date(F.timestamp_seconds(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")))


def numbered(df: DataFrame, run_id: int, batch_id: int) -> DataFrame:
    return df.withColumns({RUN: F.lit(run_id).cast("bigint"), BATCH: F.lit(batch_id).cast("bigint")})


def _last_run(spark: SparkSession, target: str) -> int:
    """The greatest run stored in a target, -1 without one."""
    try:
        stored = spark.read.parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return -1
        raise
    if RUN not in stored.columns:
        return -1
    return max((int(run) for run, _ in _folders(stored, [RUN, BATCH])), default=-1)


def run_number(spark: SparkSession, checkpoint: str, target: str | None = None) -> int:
    """The number of the run that ``checkpoint`` belongs to.

    It is the time at which the first stream with that checkpoint started, kept
    beside the checkpoint: a fresh checkpoint counts its batches from 0 again,
    but in a later run, so that it neither replaces older batches nor loses to them.
    Should the clock be behind that of an older run in ``target``, it's the next after that.
    """
    beside = f"{checkpoint.rstrip('/')}-run"
    try:
        return spark.read.schema("run bigint").parquet(beside).first()["run"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    run = time.time_ns() // 1_000_000
    if target is not None:
        run = max(run, _last_run(spark, target) + 1)
    spark.range(1).select(F.lit(run).cast("bigint").alias("run")).coalesce(1).write.parquet(beside)
    return run


def append_events(
    df: DataFrame,
    path: str,
    batch_id: int | None = None,
    stamp: str = "fetched_at",
    rebalance: bool = True,
    run_id: int = 0,
) -> None:
    """Append documents under ``ingest_date``; nothing is de-duplicated.

    With ``batch_id`` the rows go to that batch's own partition and a replayed
    batch replaces itself instead of being stored twice. Rows are dealt by day
    first, so a task writes few files; adaptive execution splits a large day.
    """
    dated = df.withColumn("ingest_date", ingest_date(F.col(stamp)))
    if batch_id is None:
        if rebalance:
            dated = dated.hint("rebalance", F.col("ingest_date"))
        dated.write.mode("append").partitionBy("ingest_date").parquet(path)
    else:
        write_batch(numbered(dated, run_id, batch_id), path, ["ingest_date", RUN, BATCH], rebalance)


def compact_events(spark: SparkSession, path: str, into: str) -> None:
    """Write appended documents to a new folder in well-sized files per day. The old folder is left alone."""
    stored = spark.read.parquet(path).drop(RUN, BATCH)
    stored.hint("rebalance", F.col("ingest_date")).write.partitionBy("ingest_date").parquet(into)


def latest_snapshot(
    df: DataFrame,
    ts: str = "fetched_at",
    ttl: str = SNAPSHOT_TTL,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows of the newest snapshot, none once its age reaches ``ttl``.

    The age filter comes first, so both the search for the newest time and the
    read touch only the last ``ttl`` of data. ``as_of`` replaces the clock.
    """
    now = F.current_timestamp() if as_of is None else as_of
    alive = df.filter((F.col(ts) > now - F.expr(f"INTERVAL '{ttl}'")) & (F.col(ts) <= now))
    return alive.filter(F.col(ts) == alive.select(F.max(ts)).scalar())


def snapshot_payload(snapshot: DataFrame) -> DataFrame:
    """The snapshot as JSON text, one row per alert."""
    return snapshot.select(F.to_json(F.struct("*")).alias("payload"))


def _pointer(spark: SparkSession, base: str) -> dict[str, int] | None:
    """The newest pointer row of a store. A pointer that is just being written again is passed over."""
    reader = spark.read.schema(POINTER).option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    try:
        rows = reader.parquet(f"{base}/pointers").orderBy(F.desc("number")).limit(1).collect()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows[0].asDict() if rows else None


def _point(spark: SparkSession, base: str, number: int, value: int) -> None:
    """Let readers see ``value`` from now on. Pointers are used again in turn."""
    row = spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(value).cast("bigint").alias("value"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{base}/pointers/slot={number % SLOTS}")


def keep_snapshot(df: DataFrame, base: str, stamp: str = "fetched_at") -> bool:
    """Make the newest poll in ``df`` the kept snapshot; False, and nothing changes, if there is none or it's older than the kept one.

    The rows are written beside the kept snapshot, then a pointer row is written:
    readers see one snapshot or the next, never a mixture. Slots and pointers are
    used again in turn, so the store doesn't grow, and what a reader has resolved stays for
    ``SLOTS`` - 1 more cycles. One stream writes; a replayed cycle is a cycle.
    """
    spark, micros = df.sparkSession, F.unix_micros(F.col(stamp).cast("timestamp"))
    taken = df.agg(F.max(micros)).first()[0]
    kept = _pointer(spark, base)
    if taken is None or (kept and taken < kept["value"]):
        return False
    number = kept["number"] + 1 if kept else 0
    df.filter(micros == taken).write.mode("overwrite").parquet(f"{base}/slots/{number % SLOTS}")
    _point(spark, base, number, taken)
    return True


def read_snapshot(
    spark: SparkSession, base: str, ttl: str = SNAPSHOT_TTL, as_of: Column | None = None, schema: T.StructType = BRONZE
) -> DataFrame:
    """The kept snapshot, no rows once its age reaches ``ttl`` or before there is one.

    Which snapshot that is is settled here, its age when the frame is computed. ``as_of`` replaces the clock.
    """
    kept = _pointer(spark, base)
    if kept is None:
        return spark.createDataFrame([], schema)
    now, taken = F.current_timestamp() if as_of is None else as_of, F.timestamp_micros(F.lit(kept["value"]))
    alive = (taken > now - F.expr(f"INTERVAL '{ttl}'")) & (taken <= now)
    return spark.read.schema(schema).parquet(f"{base}/slots/{kept['number'] % SLOTS}").filter(alive)


def upsert(
    df: DataFrame,
    path: str,
    batch_id: int,
    key: str = "mongo_id",
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    run_id: int = 0,
) -> None:
    """Store one batch of whole rows; readers see the last version of each key.

    Writing is append-like and needs no look at older rows. Replaying a batch
    replaces its own partitions. Columns in ``partition_by`` must follow from
    the key, so that all versions of a key stay in one partition. A batch holds
    a key once (see :func:`newest_per_key`).
    """
    if key not in df.columns:
        raise ValueError(f"no key column {key!r}")
    write_batch(numbered(df, run_id, batch_id), path, [*partition_by, RUN, BATCH], rebalance)


def newest_per_key(
    df: DataFrame, key: str = "mongo_id", version: Sequence[str] = (RUN, BATCH), within: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``version`` of each key.

    The rank filter becomes a group limit before the shuffle as well: however
    often a key was rewritten, a task sends one row for it.
    """
    order = [F.desc(v) for v in version]
    newest = W.partitionBy(*within, key).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def _folders(df: DataFrame, names: Sequence[str]) -> Iterable[tuple[str, ...]]:
    """The values of the innermost partitions, which have to be ``names``, of each file. What lies above the table isn't looked at."""
    for file in df.inputFiles():
        parts = file.split("/")[-len(names) - 1 : -1]
        at = dict(part.split("=", 1) for part in parts if "=" in part)
        if set(at) != set(names):
            raise ValueError(f"{file} isn't partitioned by {', '.join(names)}")
        yield tuple(at[n] for n in names)


def _writes(df: DataFrame, partition_by: Sequence[str]) -> dict[tuple[str, ...], set[tuple[str, str]]]:
    """The writes (run, batch) that each partition of an upserted table holds, as its folder names tell."""
    found: dict[tuple[str, ...], set[tuple[str, str]]] = {}
    for *values, run, batch in _folders(df, [*partition_by, RUN, BATCH]):
        found.setdefault(tuple(values), set()).add((run, batch))
    return found


def read_current(
    spark: SparkSession, path: str, key: str = "mongo_id", partition_by: Sequence[str] = ()
) -> DataFrame:
    """The upserted table as its readers see it; filters on ``partition_by``
    columns still prune files.

    Partitions of one write are read as they are, whatever the others need. In
    those of several, keys and write numbers alone are grouped; they give the
    outdated versions, which are taken out of the rows.
    """
    stored = spark.read.parquet(path)
    several = [values for values, writes in _writes(stored, partition_by).items() if len(writes) > 1]
    if not several:
        return stored.drop(RUN, BATCH)
    single, mixed = None, stored
    if len(partition_by) == 1:
        value = F.coalesce(F.col(partition_by[0]).cast("string"), F.lit(NO_VALUE))
        held = value.isin(*(unquote(values[0]) for values in several))
        single, mixed = stored.filter(~held), stored.filter(held)
    rows = mixed.select(*partition_by, key, RUN, BATCH)
    last = rows.groupBy(*partition_by, key).agg(F.max(F.struct(RUN, BATCH)).alias("__last"), F.count(F.lit(1)).alias("__n"))
    last = last.filter("__n > 1").select(key, "__last")
    outdated = rows.join(last, key).filter(F.struct(RUN, BATCH) < F.col("__last")).select(key, RUN, BATCH)
    current = mixed.join(outdated, [key, RUN, BATCH], "left_anti").select(*stored.columns)
    return (current if single is None else single.unionByName(current)).drop(RUN, BATCH)


def compact(
    spark: SparkSession, path: str, into: str, key: str = "mongo_id", partition_by: Sequence[str] = ()
) -> None:
    """Write the current rows to a new folder as batch -1 of run 0, in well-sized files per partition.

    The old folder is left alone: point readers and writers to the new one.
    """
    upsert(read_current(spark, path, key, partition_by), into, -1, key, partition_by)


def compact_bucketed(
    spark: SparkSession,
    path: str,
    into: str,
    table: str,
    key: str = "mongo_id",
    partition_by: Sequence[str] = (),
    buckets: int = 64,
) -> None:
    """Write the current rows as the table ``table`` at ``into``, bucketed and sorted by key.

    What joins or groups it by key then moves only the other side (see :func:`merged`). Rows are
    dealt by bucket first, so a partition has one file per bucket. The old folder is left alone.
    """
    rows = read_current(spark, path, key, partition_by).repartition(buckets, F.col(key))
    writer = rows.write.bucketBy(buckets, key).sortBy(key).option("path", into)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def merged(spark: SparkSession, table: str, batch: DataFrame, key: str = "mongo_id") -> DataFrame:
    """The rows of a bucketed table with those of ``batch``, which holds a key once, in the place of theirs. The table isn't shuffled."""
    stored = spark.table(table)
    return stored.join(batch.select(key), key, "left_anti").select(*stored.columns).unionByName(batch.select(*stored.columns))


def _columns(spark: SparkSession, path: str) -> set[str] | None:
    """Column names stored at ``path``, None when there is nothing."""
    try:
        return set(spark.read.parquet(path).columns)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ensure_target(
    spark: SparkSession, base: str, required: Iterable[str] = ("pig_event_filter",)
) -> tuple[str, str]:
    """Decide where to write: ``(state, path)``.

    ``create``: nothing there yet. ``ok``: the newest version holds every
    required column. ``rebuild``: it does not; the path is that of the next
    version, to be filled from the start with a fresh checkpoint. Nothing is
    ever deleted.
    """
    version, found = 1, None
    while (columns := _columns(spark, f"{base}/v{version}")) is not None:
        version, found = version + 1, columns
    if found is None:
        return "create", f"{base}/v1"
    if set(required) <= found:
        return "ok", f"{base}/v{version - 1}"
    return "rebuild", f"{base}/v{version}"


def current_target(spark: SparkSession, base: str) -> str | None:
    """The version that readers of a rebuilt target use, None before there is one."""
    at = _pointer(spark, base)
    return at and f"{base}/v{at['value']}"


def rebuild_target(
    spark: SparkSession, base: str, fill: Callable[[str], None], required: Iterable[str] = ("pig_event_filter",)
) -> tuple[str, str]:
    """Bring a target to the wanted structure as one action: ``(state, path)`` with the states of :func:`ensure_target`.

    Without a version, or with one that lacks a required column, ``fill`` writes
    the next one from the start, while readers of :func:`current_target` stay on the old one. When it
    returns one pointer is written, and they see the new one. Should it fail,
    nothing has changed for them, and the next attempt takes a fresh folder. Older versions stay.
    """
    at = _pointer(spark, base)
    held = _columns(spark, f"{base}/v{at['value']}") if at else None
    if held is not None and set(required) <= held:
        return "ok", f"{base}/v{at['value']}"
    version = at["value"] + 1 if at else 1
    while _columns(spark, f"{base}/v{version}") is not None:  # left by an attempt that failed
        version += 1
    fill(f"{base}/v{version}")
    _point(spark, base, at["number"] + 1 if at else 0, version)
    return "rebuild" if at else "create", f"{base}/v{version}"


def check_schema(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns of ``schema`` that ``df`` lacks or holds with another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f.name for f in schema.fields if have.get(f.name) != f.dataType.simpleString()]


def fan_out(
    df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]]
) -> dict[str, str | None]:
    """Write one frame to several sinks at once, computing it a single time.

    A failing sink does not stop the others. Returns the error text per sink,
    None for success; the caller decides which failures matter.
    """
    shared = df.persist()

    def run(write: Callable[[DataFrame], None]) -> str | None:
        try:
            write(shared)
            return None
        except Exception as error:  # the result carries the failure of this sink
            return f"{type(error).__name__}: {error}"

    try:
        with ThreadPoolExecutor(max_workers=max(1, len(sinks))) as pool:
            task = inheritable_thread_target(df.sparkSession)(run)
            return dict(zip(sinks, pool.map(task, sinks.values())))
    finally:
        shared.unpersist()
