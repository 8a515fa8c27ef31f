"""The field profiler: which paths documents hold, how often and with what."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from ..functions import variants as V
from ..session import work_dir
from .incremental import recent_sample

SAMPLES = 5
SAMPLE_CHARS = 100

# Category words looked for in the lower-cased path, in order of precedence.
CORE_PATHS = ("_id", "type", "subtype")
LOCATION_WORDS = ("location", "coord")
TIME_WORDS = ("time", "pub", "date")
METADATA_WORDS = ("id",)
# Display order of the categories.
CATEGORY_ORDER = ("core", "location", "time", "domain", "metadata")


def _fields(objects: DataFrame, key: str) -> DataFrame:
    """The fields of objects ``key, prefix, value``: ``key, path, value``. Anything but an object has none."""
    held = objects.select(F.col(key).alias("__key"), F.col("prefix").alias("__prefix"), F.col("value").alias("__object"))
    fields = held.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("__object").outer())).filter("key IS NOT NULL")
    return fields.select(F.col("__key").alias(key), F.concat("__prefix", "key").alias("path"), "value")


def _objects_below(nodes: DataFrame, key: str) -> DataFrame:
    """Nodes that are objects with fields, or lists that such an object leads, as ``key, prefix, value``."""
    lead = F.try_variant_get("value", "$[0]", "variant")
    filled = "^OBJECT<[^>]"
    return (
        nodes.withColumn("__type", V.type_name(F.col("value")))
        .withColumn("__lead", F.when(F.col("__type").startswith("ARRAY"), lead))
        .filter(F.col("__type").rlike(filled) | V.type_name(F.col("__lead")).rlike(filled))
        .select(
            key,
            F.concat("path", F.when(F.col("__lead").isNull(), ".").otherwise("[0].")).alias("prefix"),
            F.coalesce("__lead", "value").alias("value"),
        )
    )


def _stored_levels(documents: DataFrame, key: str, max_depth: int | None) -> list[str]:
    """Folders with the objects inside documents, one per level, until a level has none."""
    spark = documents.sparkSession
    base, above, found = work_dir(spark, "levels"), documents, []
    while True:
        path = f"{base}/level={len(found) + 1}"
        _objects_below(_fields(above, key), key).write.parquet(path)
        above = spark.read.schema(documents.schema).parquet(path)
        if above.isEmpty():
            return found
        if len(found) + 1 == max_depth:
            raise PySparkException(f"documents nest deeper than {max_depth} levels: raise max_depth")
        found.append(path)


def _roots(df: DataFrame, alert: str, key: str) -> DataFrame:
    return df.select(key, F.lit("").alias("prefix"), F.col(alert).alias("value"))


def document_depth(df: DataFrame, alert: str = "alert", key: str = "mongo_id") -> int:
    """Levels of paths that documents have, 1 at least."""
    return 1 + len(_stored_levels(_roots(df, alert, key), key, None))


def flatten_paths(
    df: DataFrame, alert: str = "alert", key: str = "mongo_id", max_depth: int | None = None
) -> DataFrame:
    """One row per document and path: ``key, path, value``.

    Objects give ``a.b``; a list whose first element is an object gives
    ``a[0].b`` for that element only. The objects inside documents are stored
    first, level by level until there are none, in a pass each over the level
    above; then one plan, the same for any depth, takes the fields of documents and
    stored objects. Values may be of any length. With ``max_depth`` a deeper
    document fails instead of losing paths.
    """
    roots = _roots(df, alert, key)
    levels = _stored_levels(roots, key, max_depth)
    if not levels:
        return _fields(roots, key)
    inner = df.sparkSession.read.schema(roots.schema).parquet(*levels)
    return _fields(roots, key).unionByName(_fields(inner, key))


def sample_text(value: Column, type_name: Column | None = None) -> Column:
    """Short text of a value: containers by size, everything else cut to 100 characters."""
    kind = V.kind_of(V.bare_type(value) if type_name is None else type_name)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "dict", F.format_string("dict(%d keys)", F.size(V.as_object(value))))
        .when(
            kind == "list",
            F.format_string("list(%d items)", F.size(F.try_variant_get(value, "$", "array<variant>"))),
        )
        .when(kind == "bool", F.initcap(text))
        .when((kind == "datetime") & (F.length(text) > 19), F.rpad(text, 26, "0"))
        .when(kind == "float", V.float_text(F.try_variant_get(value, "$", "double")))
        .otherwise(F.substring(text, 1, SAMPLE_CHARS))
    )


def _typed(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("type_name", V.bare_type(F.col("value")))


def _counts() -> list[Column]:
    """Aggregates over typed nodes: how many, of which kinds, how many nulls."""
    kinds = F.transform(F.collect_set("type_name"), V.kind_of)
    null_n = F.coalesce(F.sum((F.col("type_name") == "VOID").cast("int")), F.lit(0))
    return [F.count(F.lit(1)).alias("n"), F.sort_array(F.array_distinct(kinds)).alias("types"), null_n.alias("null_n")]


def _newest(key: str, n: int) -> Column:
    """Aggregate over typed nodes: the ``n`` greatest keys with a value that isn't null, and its text.

    No more than ``n`` are ever held per path, in a task as after the shuffle.
    """
    shown = F.struct(F.col(key).alias("key"), sample_text(F.col("value"), F.col("type_name")).alias("sample"))
    return InternalFunction.collect_top_k(F.when(F.col("type_name") != "VOID", shown), n, False)


def field_stats(nodes: DataFrame) -> DataFrame:
    """``path, n, types, null_n``.

    A path collapses to a row in each task before the shuffle, so one that is
    present in every document is no hot key.
    """
    return _typed(nodes).groupBy("path").agg(*_counts())


def field_samples(nodes: DataFrame, key: str = "mongo_id", n: int = SAMPLES) -> DataFrame:
    """``path, rank, sample``: the newest ``n`` non-null values of each path."""
    newest = _typed(nodes).groupBy("path").agg(_newest(key, n).alias("s"))
    return newest.select("path", F.posexplode("s.sample").alias("rank", "sample")).withColumn("rank", F.col("rank") + 1)


def profile_fields(
    df: DataFrame,
    alert: str = "alert",
    key: str = "mongo_id",
    max_depth: int | None = None,
    samples: int = SAMPLES,
) -> DataFrame:
    """One row per path: ``path, n, pct, types, null_n, null_pct, samples``.

    Statistics and samples come from one flattening and one aggregation.
    """
    nodes = flatten_paths(df, alert, key, max_depth)
    total = df.select(F.count(F.lit(1))).scalar()
    shown = [_newest(key, samples).alias("newest")] if samples else []
    found = _typed(nodes).groupBy("path").agg(*_counts(), *shown)
    return found.select(
        "path",
        "n",
        (100 * F.col("n") / total).alias("pct"),
        "types",
        "null_n",
        (100 * F.col("null_n") / F.col("n")).alias("null_pct"),
        *([F.col("newest.sample").alias("samples")] if samples else []),
    )


def by_frequency(profile: DataFrame) -> DataFrame:
    """Most frequent paths first, ties by name."""
    return profile.orderBy(F.desc("n"), "path")


def classify_fields(profile: DataFrame, path: str = "path") -> DataFrame:
    """Add ``category``, ``category_rank`` and ``keep`` to each path."""
    name = F.col(path)
    low = F.lower(name)

    def holds(words: tuple[str, ...]) -> Column:
        return low.rlike("|".join(words))

    hidden = name.startswith("_")
    category = (
        F.when(name.isin(*CORE_PATHS), "core")
        .when(holds(LOCATION_WORDS), "location")
        .when(holds(TIME_WORDS), "time")
        .when(hidden | holds(METADATA_WORDS), "metadata")
        .otherwise("domain")
    )
    order = F.array(*[F.lit(c) for c in CATEGORY_ORDER])
    return (
        profile.withColumn("category", category)
        .withColumn("category_rank", F.array_position(order, F.col("category")).cast("int"))
        .withColumn("keep", (F.col("category") != "metadata") & (~hidden | (name == "_id")))
    )


def by_category(classified: DataFrame, path: str = "path") -> DataFrame:
    """Display order: category, then name."""
    return classified.orderBy("category_rank", path)


def inspect_fields(
    df: DataFrame, alert: str = "alert", key: str = "mongo_id", newest: int | None = 100
) -> DataFrame:
    """Profile and classes of the ``newest`` documents in display order; None takes all."""
    docs = df.select(key, alert)
    if newest is not None:
        docs = recent_sample(docs, key, newest)
    return by_category(classify_fields(profile_fields(docs, alert, key)))
