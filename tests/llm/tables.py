"""Small tables with awkward rows, written as Parquet."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = [f"w{i}" for i in range(40)] + ["Über", "naïve", "x,", "(y)", "e"]


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", "\t "]) for _ in range(n))


def awkward_documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text): empty, NULL, blank, short, long, equal, nearly equal, sharing passages, repeated rows and ids."""
    rng = random.Random(seed)
    passage, long = prose(rng, 60), prose(rng, 6000)
    texts = [None, "", " \n\t", "one", "One two", "a" * 450, "a" * 199, "ab" * 300, long, long, long[:-7] + "changed"]
    texts += [prose(rng, rng.randint(1, 150)) for _ in range(25)]
    texts += [prose(rng, rng.randint(0, 50)) + passage + prose(rng, rng.randint(0, 50)) for _ in range(12)]
    texts += [texts[20]] * 15 + [texts[21].upper(), texts[21] + " ", passage, passage]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[0], rows[3], (None, "nobody's text " + passage), (None, None), (7, "another row with an id that is taken")]


def write(path: str, columns: dict[str, pa.DataType], rows: list[tuple], files: int = 3) -> str:
    """A Parquet folder of some files."""
    import os

    os.makedirs(path, exist_ok=True)
    schema = pa.schema(list(columns.items()))
    for n in range(files):
        part = rows[n::files]
        arrays = [pa.array([r[i] for r in part], t) for i, t in enumerate(columns.values())]
        pq.write_table(pa.Table.from_arrays(arrays, schema=schema), f"{path}/part-{n}.parquet")
    return path


def documents(spark, path: str, rows: list[tuple]):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(i, t, "xx", "src", None if t is None else len(t), 5, "r", b"b", 1.5) for i, t in rows]
    columns = {
        "doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64(),
        "rid": pa.int64(), "row": pa.string(), "body": pa.binary(), "a.b": pa.float64(),
    }
    write(path, columns, full)
    return spark.read.parquet(path)
