"""The registered queries of the operators: name, query, and DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartframes.llm import alignment, binary, counts, decontaminate, language, licences, mixing, packing, quality, simhash, suffix, topk, tries
from chartframes.llm.common import held_out, pin, scratch_folder, text_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register("op7_simhash_near_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@register("op6_suffix_array_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, folder, "documents")).drop("kept", "kept_text")


@register("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.fit(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register(
    "op4_benchmark_decontamination",
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins))
), hits AS (
  SELECT doc_id, item_id, i, p.n FROM places p JOIN wins USING (win)
), spans AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN items USING (doc_id)
""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items", "text_hash")


@register("op5_best_fit_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op2_quality_classifier")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, folder, "labels"), ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _canonical_sql(text: str) -> str:
    """The canonical lines of a text column, in DuckDB."""
    out = f"lower(coalesce({text}, ''))"
    for old, new in licences.SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    out = f"regexp_replace({out}, '{licences.COPYRIGHT_LINE}', chr(10), 'g')"
    out = f"regexp_replace({out}, '{licences.SIGNS}', ' ', 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _licence_rows() -> str:
    quoted = [f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in licences.LICENCES]
    return ", ".join(quoted)


@register(
    "op10_license_scan",
    f"""
WITH known AS (
  SELECT array_to_string(lines, ' ') AS canonical, min(license_id) AS license
  FROM (SELECT license_id, {_canonical_sql('text')} AS lines FROM (VALUES {_licence_rows()}) AS v(license_id, text))
  WHERE len(lines) > 0 GROUP BY 1
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_canonical_sql('text')} AS lines FROM documents
), notes AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n_notices
  FROM (SELECT rid, unnest(lines) AS canonical FROM d) JOIN known USING (canonical) GROUP BY rid
)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS text_sha256, license, coalesce(notices, '') AS notices,
  coalesce(n_notices, 0) AS n_notices
FROM d LEFT JOIN known ON canonical = array_to_string(lines, ' ') LEFT JOIN notes USING (rid)
""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"), licences.known_licences(spark))


@register("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pieces = counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return counts.token_counts(table(spark, folder, "documents"), pieces)


@register("op9_training_order_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    binary.materialise(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return binary.read_from(spark, path).select(
        "slot", "shard", "at", "doc_id", "piece", "length", F.crc32("ids").alias("ids_crc32")
    )


@register(
    "op1_exact_top_k",
    """
WITH codes AS (
  SELECT vec_id, list_sum(list_transform(range(1, len(embedding) + 1), lambda i: CASE WHEN embedding[i] > 0 THEN CAST(1 AS UBIGINT) << (i - 1) ELSE 0 END))::UBIGINT AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, t.vec_id AS id, bit_count(xor(q.code, t.code))::INTEGER AS distance
  FROM codes q, codes t WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs) WHERE rank <= 10
""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), topk.sign_code(F.col("embedding")).alias("code"))
    return topk.nearest(codes, codes.where("id % 20 = 0"), 10)


@register(
    "op11_source_mix",
    r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('1' || coalesce('/=' || doc_id, '/') || coalesce('/=' || text, '/')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496 AS coin
  FROM documents
), s AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), r AS (
  SELECT *, sum(3 * source_size) OVER o AS fulls, sum(w) OVER o AS ws, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w
  FROM s WINDOW o AS (ORDER BY source_size::DOUBLE / w, source NULLS FIRST ROWS UNBOUNDED PRECEDING)
), b AS (SELECT *, fulls * w + 3 * source_size * (all_w - ws) <= total * w AS bound FROM r
), t AS (
  SELECT source, source_size, CASE WHEN bound THEN (3 * source_size)::DOUBLE ELSE (total - coalesce(sum(3 * source_size) FILTER (bound) OVER (), 0))::DOUBLE
    / (sum(w) FILTER (NOT bound) OVER ())::DOUBLE * w END AS target FROM b
), c AS (
  SELECT doc_id, size, source_size, target, coin, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size::DOUBLE END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM c
""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.with_copies(pin(mixing.measured(table(spark, folder, "documents"))))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register(
    "op12_conversation_prefix_trie",
    """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
), own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS first,
    xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id), crc
), rebuilt AS (
  SELECT c.conv_id, o.place AS depth, role, text FROM convs c JOIN own o ON o.conv_id = c.first WHERE o.place <= h
  UNION ALL
  SELECT c.conv_id, o.place - c.h + least(c.h, coalesce(f.n, 0)), role, text
  FROM convs c JOIN own o USING (conv_id) LEFT JOIN convs f ON f.conv_id = c.first WHERE o.place > c.h
), p AS (
  SELECT conv_id, depth, length(text) AS chars,
    md5(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), above AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM p
), nodes AS (
  SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM above GROUP BY depth, node
), kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), x AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * chars AS saved
  FROM nodes n LEFT JOIN kids USING (depth, node)
), sums AS (
  SELECT p.depth, p.node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM p JOIN x ON x.conv_id = p.conv_id AND x.depth >= p.depth GROUP BY p.depth, p.node
), ends AS (
  SELECT depth, node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY depth, node
)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN sums USING (depth, node) LEFT JOIN ends USING (depth, node) LEFT JOIN nodes y ON y.depth = x.depth - 1 AND y.node = x.parent
""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return tries.prefix_trie(table(spark, folder, "conversations"))


@register("op13_tokenizer_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.agreement(alignment.align(table(spark, folder, "documents"), a, b), alignment.piece_count(b))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
