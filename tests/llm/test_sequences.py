"""Learning from every character sequence of the labelled rows, however rare."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa

from traffic_lake.llm import toxicity

from . import tables


def test_all_sequences_are_counted(spark, tmp_path):
    texts = [(i % 2, " ".join(f"{(i * 40 + j) * 2654435761 % 10**12:012d}" for j in range(40)).encode()) for i in range(500)]
    path = tables.write(f"{tmp_path}/texts", {"toxic": pa.int32(), "body": pa.binary()}, texts)
    wanted = {0: Counter(), 1: Counter()}
    for toxic, body in texts:
        for token in body.decode().split():
            wanted[toxic].update(toxicity.spelled(token))
    bound = (150_000,) if hasattr(toxicity, "GRAMS") else ()
    got = toxicity._count(spark.read.parquet(path), *bound, f"{tmp_path}/counts")
    assert len(wanted[0] | wanted[1]) > 150_000
    assert got == {g: (wanted[0][g], wanted[1][g]) for g in wanted[0] | wanted[1]}
