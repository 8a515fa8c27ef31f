"""One key, path or group holds a third of all rows: results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from traffic_lake import operators as O
from traffic_lake.sinks import tables as S

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7000))
    return spark.range(0, N, 1, 6).select(key.alias("mongo_id"), F.col("id").alias("v"))


def test_newest_per_key(spark, skewed):
    expected = {}
    for row in skewed.collect():
        expected[row["mongo_id"]] = max(row["v"], expected.get(row["mongo_id"], -1))
    found = {r["mongo_id"]: r["v"] for r in S.newest_per_key(skewed, version=("v",)).collect()}
    assert found == expected


def test_reconciliation_does_not_multiply(spark, skewed):
    row = O.reconcile(skewed, skewed.filter("v % 2 = 0")).first()
    assert (row["raw_rows"], row["processed_rows"]) == (N, N // 2)
    assert row["in_both"] + row["only_raw"] == skewed.select("mongo_id").distinct().count()


def test_hot_paths_and_facets(spark, skewed):
    doc = F.when(F.col("mongo_id") == "hot", '{"a":{"b":1}}').otherwise(F.concat(F.lit('{"c":'), "v", F.lit("}")))
    docs = skewed.select(F.format_string("%024d", "v").alias("mongo_id"), F.parse_json(doc).alias("alert"))
    rows = {r["path"]: r for r in O.profile_fields(docs).collect()}
    assert {p: r["n"] for p, r in rows.items()} == {"a": N // 3, "a.b": N // 3, "c": N - N // 3}
    newest = [str(v) for v in range(N - 1, 0, -1) if v % 3][:5]
    assert rows["c"]["samples"] == newest
    top = O.facet_counts(skewed, ["mongo_id"], k=1).first()
    assert (top["mongo_id"], top["n"]) == ("hot", N // 3)


def test_hot_day_is_split_when_rebalanced(spark, skewed):
    from traffic_lake.session import work_dir

    out = work_dir(spark, "hot")
    day = F.when(F.col("mongo_id") == "hot", "2024-01-01").otherwise("2024-01-02").cast("date")
    S.upsert(skewed.withColumn("day", day), out, 1, partition_by=["day"], rebalance=True)
    assert spark.read.parquet(out).count() == N
