"""Registered queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import brown_lm, toxicity
from .common import table
from .fingerprints import as_text, compared
from .packing import pack
from .perspectives import rotate
from .phrases import collocations
from .radix_dedup import exact_duplicates
from .seed_extend import remove_repeated_passages
from .simhash import near_duplicates
from .string_tiling import contamination
from .suffix_dedup import remove_repeated_substrings
from .warc import round_trip
from .whitening import whitened

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


@query
def op4_suffix_dedup(spark, sf_dir):
    docs = remove_repeated_substrings(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op1_toxicity(spark, sf_dir):
    docs = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.select("doc_id", "held_out", "score", "predicted", "ratio")


@query
def op2_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


@query
def op3_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@query
def op5_radix_dedup(spark, sf_dir):
    docs = exact_duplicates(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op8_perspectives(spark, sf_dir):
    chats = rotate(table(spark, sf_dir, "conversations"))
    runs = F.transform("mask", lambda r: F.concat(r["chars"].cast("string"), F.when(r["train"], "+").otherwise("-")))
    return chats.withColumn("mask", F.array_join(runs, ""))


@query
def op9_string_tiling(spark, sf_dir):
    docs = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", "contaminated", F.transform(F.coalesce("items", F.array()), lambda i: i["item_id"]).alias("item_ids"))


@query
def op6_brown_lm(spark, sf_dir):
    return brown_lm.score(table(spark, sf_dir, "documents")).drop("rid")


@query
def op7_seed_extend(spark, sf_dir):
    docs = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_simhash(spark, sf_dir):
    docs = near_duplicates(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


@query
def op11_fingerprints(spark, sf_dir):
    docs = compared(table(spark, sf_dir, "documents"))
    prints = {"fingerprint": as_text(F.col("vector")), "edited_fingerprint": as_text(F.col("edited_vector"))}
    docs = docs.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).withColumns(prints)
    return docs.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next")


@query
def op12_whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


SQL: dict[str, str] = {
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        f AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d, min(page_id) OVER (PARTITION BY b) AS first FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
          CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to, true AS verified
        FROM f
    """,
    "op8_perspectives": """
        WITH m AS (
          SELECT conv_id, turn, CAST(coalesce(floor(turn / 64.0), -1) AS BIGINT) AS part,
            CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS role, coalesce(text, '') AS text
          FROM conversations),
        s AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
        r AS (
          SELECT m.*, speaker, role = speaker AS own,
            CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
              ELSE '<|user ' || replace(role, '<|', '< |') || '|>' END || chr(10) AS head,
            replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
          FROM m JOIN s ON m.conv_id IS NOT DISTINCT FROM s.conv_id)
        SELECT conv_id, speaker, part, count(*) AS n_messages,
          string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, m_text) AS text,
          string_agg(length(head) || '-' || length(body) || CASE WHEN own THEN '+' ELSE '-' END, '' ORDER BY turn NULLS FIRST, role, m_text) AS mask,
          CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_target_chars
        FROM (SELECT *, text AS m_text FROM r) GROUP BY conv_id, speaker, part
    """,
    "op5_radix_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)
    """,
    "op11_fingerprints": """
        WITH o AS (
          SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS nt,
            coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS nid
          FROM documents WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
        e AS (SELECT *, length(t) AS n, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2) AS edited FROM o),
        k AS (SELECT doc_id, 0 AS kind, t AS body FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
        p AS (SELECT doc_id, kind, unnest(list_filter(string_split(body, chr(10)), lambda x: trim(x) <> '')) AS line FROM k),
        pd AS (SELECT doc_id, kind, line, sha256(line) || sha256(sha256(line)) AS h FROM p),
        s AS (
          SELECT doc_id, kind,
            md5(unnest(list_filter(regexp_split_to_array(line, '[.!?]+[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS h
          FROM p),
        wide AS (
          SELECT doc_id, kind, i, sum(CAST('0x' || substr(h, 15 * i + 1, 15) AS BIGINT)) % 1152921504606846976 AS v
          FROM pd, range(8) r(i) GROUP BY ALL),
        counted AS (SELECT doc_id, kind, count(*) AS n FROM s GROUP BY ALL),
        ones AS (
          SELECT doc_id, kind, b // 60 AS word, b % 15 AS j, b % 60 // 15 AS field,
            CAST(sum((CAST('0x' || substr(h, 15 * (b // 60) + 1, 15) AS BIGINT) >> (b % 60)) & 1) AS BIGINT) % 16384 AS v
          FROM s, range(120) r(b) GROUP BY ALL),
        packed AS (SELECT doc_id, kind, 9 + 15 * word + j AS i, CAST(sum(v * (1 << (15 * field))) AS BIGINT) AS v FROM ones GROUP BY ALL),
        entries AS (
          SELECT doc_id, kind, i, CAST(v AS BIGINT) AS v FROM wide UNION ALL SELECT doc_id, kind, 8, n FROM counted
          UNION ALL SELECT * FROM packed),
        prints AS (
          SELECT k.doc_id, k.kind, string_agg(format('{:015x}', coalesce(v, 0)), '' ORDER BY r.i) AS f
          FROM k CROSS JOIN range(39) r(i) LEFT JOIN entries x ON x.doc_id = k.doc_id AND x.kind = k.kind AND x.i = r.i GROUP BY ALL),
        signs AS (
          SELECT doc_id, kind, word * 60 + field * 15 + j AS b, (2 * v - n + 16384 + 32768 * (1 + n // 32768)) % 32768 - 16384 AS v
          FROM ones JOIN counted USING (doc_id, kind)),
        sizes AS (SELECT doc_id, kind, CAST(sum(v * v) AS BIGINT) AS size FROM signs GROUP BY ALL),
        pairs AS (SELECT doc_id, doc_id AS other, 1 AS kind FROM e UNION ALL SELECT doc_id, nid, 0 FROM e),
        products AS (
          SELECT p.doc_id, p.kind, CAST(sum(x.v * y.v) AS BIGINT) AS product
          FROM pairs p JOIN signs x ON x.doc_id = p.doc_id AND x.kind = 0 JOIN signs y ON y.doc_id = p.other AND y.kind = p.kind AND y.b = x.b
          GROUP BY ALL),
        near AS (
          SELECT p.doc_id, p.kind,
            CASE WHEN a.f = b.f THEN 1e0 WHEN coalesce(x.size, 0) + coalesce(y.size, 0) = 0 THEN 0e0
              ELSE greatest(0e0, least(1e0, 2e0 * coalesce(product, 0) / (coalesce(x.size, 0) + coalesce(y.size, 0)))) END AS near
          FROM pairs p JOIN prints a ON a.doc_id = p.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = p.other AND b.kind = p.kind
          LEFT JOIN sizes x ON x.doc_id = p.doc_id AND x.kind = 0 LEFT JOIN sizes y ON y.doc_id = p.other AND y.kind = p.kind
          LEFT JOIN products q ON q.doc_id = p.doc_id AND q.kind = p.kind)
        SELECT e.doc_id, n AS n_chars, sha256(edited) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
          c.near AS near_edited, d.near AS near_next
        FROM e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1
        JOIN near c ON c.doc_id = e.doc_id AND c.kind = 1 JOIN near d ON d.doc_id = e.doc_id AND d.kind = 0
    """,
    "op13_collocations": """
        WITH t AS (
          SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
          FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p),
        s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
        g AS (SELECT lang, words[i : i + k - 1] AS g FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(words)),
        f AS (SELECT lang, g, len(g) AS k, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 30),
        n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
        c AS (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
        v AS (
          SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, CAST(2000000 * c.f::HUGEINT // (x.f + y.f) AS BIGINT) AS score,
            row_number() OVER (PARTITION BY c.lang, c.g ORDER BY 2000000 * c.f::HUGEINT // (x.f + y.f), cut) AS nth
          FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1 : c.k]),
        i AS (
          SELECT lang, g[j : j + m - 1] AS g, max(f) AS most
          FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 2), (SELECT unnest([2, 3]) AS m) WHERE m < k AND j + m - 1 <= k GROUP BY ALL),
        o AS (
          SELECT v.*, array_to_string(v.g, ' ') AS phrase FROM v LEFT JOIN i ON i.lang = v.lang AND i.g = v.g
          WHERE nth = 1 AND (most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT)),
        z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
        SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
    """,
}
