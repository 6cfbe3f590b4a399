"""The registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom.llm import (
    brown, centroids, decontaminate, dedup, html, jaccard, langid, merkle, packing, quality, secrets,
    sharding, warc)
from retaloom.llm.common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered("op1_brown_classes")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return brown.score(docs, crc_mod("doc_id", 5) != 1).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "perplexity")


@registered("op2_hypergeometric_shards")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: shard sizes are at most one row apart."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@registered("op8_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents),
g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY content)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.content) AS text_sha256
FROM n JOIN g ON n.content = g.content""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.assign(table(spark, folder, "documents"))


@registered("op9_best_fit_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096, 1)
    return packing.pack(cut, 4096)


@registered("op3_byte_cnn_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs, crc_mod("doc_id", 5) != 0)
    return langid.predict(docs.select("doc_id", "text"), network).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@registered("op4_suffix_automaton", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
items AS (
  SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
sizes AS (SELECT DISTINCT least(10, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g,
         least(10, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, i, grams.k, item_id FROM grams JOIN windows ON grams.g = windows.g AND grams.k = windows.k),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM found))
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(words.w) AS BIGINT) AS n_words,
       CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(named.s, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hits ON words.doc_id = hits.doc_id LEFT JOIN named ON words.doc_id = named.doc_id""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@registered("op5_structural_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("spans", lambda s: s.kind == kind)
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@registered("op6_token_group_join")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"), n=3, num=90, den=100)


@registered("op7_ftrl_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, folder, "labels"), where=crc_mod("doc_id", 3) != 1)
    return quality.score(docs, weights).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@registered("op10_host_paths")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def _rounds_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of op11, one after the other."""
    near = """
a{i} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(w) AS w, min(near) AS near
  FROM (SELECT v.rid, v.vec_id, v.w, {{'d': CAST(list_sum(list_transform(
          list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}} AS near
        FROM v, c{i} c)
  GROUP BY rid)"""
    moved = """
m{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS w
  FROM (SELECT near.c AS c, d, sum(w[d]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(d) GROUP BY near.c, d)
  GROUP BY c),
c{j} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m{i}.w, c{i}.w) AS w FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)"""
    steps = []
    for i in range(rounds):
        steps += [near.format(i=i), moved.format(i=i, j=i + 1)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(
           embedding, lambda x: TRY_CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, w) - 1 AS c, w
  FROM (SELECT w, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, w LIMIT {k})),
{",".join([*steps, near.format(i=rounds)])}
SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.w, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON near.c = c{rounds}.c"""


@registered("op11_threshold_centroids", _rounds_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"), k=8, rounds=10).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@registered("op12_chunked_warc", """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
g AS (SELECT d, n, min(page_id) AS kept FROM p WHERE n >= 100 GROUP BY d, n)
SELECT page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN kept IS NULL OR kept IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN kept IS DISTINCT FROM page_id THEN kept END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND p.n = g.n""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the archives below the shared folder and returns what reading them gives."""
    pages = table(spark, folder, "pages")
    read = warc.records(warc.chunks(warc.write(pages), data=False)).where("record_type != 'warcinfo'")
    as_id = lambda c: warc.key_of(c).cast(pages.schema["page_id"].dataType)
    return read.select(
        as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        as_id("refers_to").alias("refers_to"))


def _merkle_sql(levels: int = 10) -> str:
    """op13 by levels of ranks; groups of up to 8^levels leaves."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    height = lambda n: "CASE " + " ".join(f"WHEN {n} <= {8 ** j} THEN {j}" for j in range(levels + 1)) + " END"

    def tree(t: str) -> str:
        """Nodes of each level (g, i, h), the top ones, and what stands beside each node."""
        parts = [f"""
{t}{j} AS MATERIALIZED (
  SELECT g, i >> 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM {t}{j - 1} JOIN {t}size USING (g) WHERE height >= {j} GROUP BY g, i >> 3)""" for j in range(1, levels + 1)]
        tops = " UNION ALL ".join(
            f"SELECT g, h FROM {t}{j} JOIN {t}size USING (g) WHERE height = {j}" for j in range(levels + 1))
        parts.append(f"\n{t}top AS MATERIALIZED ({tops})")
        parts += [f"""
{t}beside{j} AS MATERIALIZED (
  SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {t}{j} a JOIN {t}{j} b ON a.g = b.g AND a.i >> 3 = b.i >> 3
  JOIN {t}size ON a.g = {t}size.g WHERE height > {j} GROUP BY a.g, a.i)""" for j in range(levels)]
        return ",".join(parts)

    way = []
    for t, g, rank in (("a", "q.g", "q.i"), ("b", "0", "q.g")):
        for j in range(levels):
            way.append(f"""
w{len(way) + 1} AS MATERIALIZED (
  SELECT q.* REPLACE (CASE WHEN x.g IS NULL THEN q.seen ELSE sha256(x.l || q.seen || x.r) END AS seen,
                      CASE WHEN x.g IS NULL THEN q.proof ELSE q.proof || x.l || x.r END AS proof)
  FROM w{len(way)} q LEFT JOIN {t}beside{j} x ON x.g = {g} AND x.i = ({rank} >> {3 * j}))""")
    return f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, b:
           xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY n) AS t
  FROM range(256) r(n)),
d AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(lowered)} AS low,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda s: CAST(ord(s) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)),
           4294967295) % 3 = 0 AS tampered
  FROM documents, crc),
w0 AS MATERIALIZED (
  SELECT doc_id, leaf, CASE WHEN tampered THEN low ELSE leaf END AS seen, '' AS proof,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM d),
asize AS MATERIALIZED (SELECT g, {height("count(*)")} AS height FROM w0 GROUP BY g),
a0 AS MATERIALIZED (SELECT g, i, leaf AS h FROM w0),{tree("a")},
bsize AS MATERIALIZED (SELECT 0 AS g, {height("count(*)")} AS height FROM asize),
b0 AS MATERIALIZED (SELECT 0 AS g, g AS i, h FROM atop),{tree("b")},{",".join(way)}
SELECT doc_id, leaf, atop.h AS subroot, btop.h AS root, sha256(proof) AS proof_sha256,
       seen AS folded_root, seen = btop.h AS verified
FROM w{len(way)} q JOIN atop ON q.g = atop.g CROSS JOIN btop"""


@registered("op13_merkle_descent", _merkle_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose id has a crc32 divisible by three are checked with A-Z of the text lowered."""
    tampered = crc_mod("doc_id", 3) == 0
    text = F.when(F.col("doc_id").isNotNull() & tampered, merkle.lower_az(F.col("text"))).otherwise(F.col("text"))
    return merkle.verify(table(spark, folder, "documents"), changed={"text": text})
