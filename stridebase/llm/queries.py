"""The registered queries of this package and, where SQL can express them, their DuckDB form."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.llm import alignment, chat, decontaminate, html_text, kdtree, licenses, neighbours, ngram_join, packing, sharding, url_templates, warc, whitening
from stridebase.llm.tables import application_folder, cut_lineage, table
from stridebase.llm.url_templates import Rule

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from transcripts of all conversations, by a model of four fifths of them."""
    transcripts = chat.as_transcripts(table(spark, sf_dir, "conversations"))
    model = chat.count_labelled(transcripts.where(~neighbours.held_out("conv")))
    turns = chat.parse_transcripts(transcripts, model)
    return turns.withColumn("held_out", neighbours.held_out("conv")).withColumnRenamed("conv", "conv_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    warc.register(spark)
    folder = f"{application_folder(spark)}/warc-{uuid.uuid4().hex}"
    records = warc.page_records(table(spark, sf_dir, "pages"), lambda df: cut_lineage(df, "repeated"))
    records.write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    revisit = F.col("record_type") == "revisit"
    return read.select(
        "page_id",
        F.when(revisit, F.col("payload_length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        warc.referred_page(F.col("refers_to")).alias("refers_to"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of nearly equal bytes."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (sharding.utf8_size(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    sharded = sharding.shard_by_bytes(cut_lineage(rows, "sizes"), ["doc_id", "text_crc32"], "size", 8)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# The rules of the query on URLs.
URL_RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and by learnt templates; a page is bad if the document
    of its number is labelled toxic or of low quality."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page"), bad.alias("bad"))
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality by labelled neighbours."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = neighbours.quality_scores(docs, neighbours.fit_voters(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        neighbours.held_out().alias("held_out"),
        "score",
        (F.col("score") >= neighbours.ACCEPTED).cast("int").alias("predicted"),
    )


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector against all others."""
    vectors = kdtree.quantised(table(spark, sf_dir, "embeddings"))
    return kdtree.nearest(vectors, vectors.where(F.col("id") % 50 == 0))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of similar ones and its number of links."""
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item of which it holds four fifths of the shingles."""
    return decontaminate.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 1024 tokens as best-fit decreasing finds."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), TOKENIZER)
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack(digested)
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in the documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies laid over each other."""
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first eight whitened components; a deviation beyond a long is NULL."""
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, with weights learnt from pages that mark their article."""
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, html_text.fit_weights(pages))


QUERIES = {
    "op1_chat": op1_chat,
    "op2_warc": op2_warc,
    "op3_sharding": op3_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_exact_topk": op6_exact_topk,
    "op7_ngram_join": op7_ngram_join,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_licenses": op10_licenses,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_html_text": op13_html_text,
}


def _shingles(source: str, key: str, name: str) -> str:
    """SQL for a row per position of a text's shingles: runs of five words, or all of fewer."""
    return f"""{name}_words AS (
  SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source} WHERE text IS NOT NULL
), {name} AS (
  SELECT {key}, len(w) AS words, i, array_to_string(w[i + 1 : i + 5], ' ') AS s
  FROM (SELECT {key}, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM {name}_words WHERE len(w) > 0)
)"""


SQL = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, coalesce(octet_length(encode(html)), 0)::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id OR (first IS NOT NULL AND page_id IS NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id OR (first IS NOT NULL AND page_id IS NULL) THEN first END AS refers_to
FROM f""",
    "op3_sharding": """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n::BIGINT)) AS t
), d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size,
    xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM documents, crc
), p AS (
  SELECT *, row_number() OVER w - 1 AS n, sum(size) OVER w - size AS start, sum(size) OVER () AS total FROM d
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), s AS (SELECT *, least((2 * start + size) * 8 // (2 * total), 7)::INTEGER AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, n - min(n) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM s""",
    "op6_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op7_ngram_join": f"""
WITH RECURSIVE {_shingles("documents", "doc_id", "d")},
g AS (SELECT DISTINCT doc_id, s FROM d WHERE doc_id IS NOT NULL),
size AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN size p ON p.doc_id = x.doc_id JOIN size q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING count(*) >= 0.8 * (p.n + q.n - count(*)) - 1e-9
),
reached(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON r.b = p.a)
SELECT doc_id, least(doc_id, coalesce((SELECT min(b) FROM reached r WHERE r.a = doc_id), doc_id)) AS class_id,
  (SELECT count(*) FROM pairs p WHERE p.a = doc_id) AS links
FROM documents""",
    "op8_decontamination": f"""
WITH {_shingles("documents", "doc_id", "d")}, {_shingles("benchmark", "item_id", "b")},
size AS (SELECT item_id, count(*) AS n FROM (SELECT DISTINCT item_id, s FROM b) GROUP BY item_id)
SELECT d.doc_id, b.item_id, count(DISTINCT b.s) AS shared, any_value(n) AS item_shingles,
  count(DISTINCT b.s) / any_value(n) AS containment,
  min(d.i) AS first_word, max(d.i) + any_value(least(d.words, 5)) - 1 AS last_word
FROM d JOIN b USING (s) JOIN size USING (item_id)
GROUP BY d.doc_id, b.item_id HAVING count(DISTINCT b.s) >= 0.8 * any_value(n) - 1e-9""",
}
