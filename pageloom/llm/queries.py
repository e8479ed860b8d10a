"""The registered queries of this package, over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalogue.book import Book
from pageloom.llm import (bpe, cross_tokenizer, exact_dedup, line_dedup, mixing, periodic_runs, personal_data, quality,
                          shards, simhash, token_files, topk, toxicity)
from pageloom.llm.common import whole_text

BOOK = Book()

UPPER, LOWER = exact_dedup.UPPER, exact_dedup.LOWER


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@BOOK.query()
def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assigned(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@BOOK.query(r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sizes GROUP BY source),
ordered AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER w, 0.0) AS taken,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0) AS open
  FROM per
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((total - taken) / open)::DOUBLE AS level FROM ordered),
targets AS (SELECT source, source_size, least(cap, level * weight)::DOUBLE AS target FROM ordered, level),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
       ((floor(rate)::BIGINT + (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
         / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT) * size)::BIGINT AS taken
FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source
""")
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.planned(_table(spark, sf_dir, "documents")).drop("copies")


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@BOOK.query(rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
raw AS (
  SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS n FROM docs),
lines AS (
  SELECT doc_id, n, trim(l, {_BLANKS}) AS l,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w
  FROM raw WHERE trim(l, {_BLANKS}) <> ''),
ahead AS (
  SELECT *, lead(l) OVER d AS l1, lead(w) OVER d AS w1, lead(n) OVER d AS n1,
         lead(l, 2) OVER d AS l2, lead(n, 2) OVER d AS n2
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY n)),
windows AS (
  SELECT doc_id, n AS first,
         CASE WHEN w >= 50 THEN n WHEN w + w1 >= 50 THEN n1 ELSE n2 END AS last,
         CASE WHEN w >= 50 THEN l WHEN w + w1 >= 50 THEN l || chr(10) || l1
              ELSE l || chr(10) || l1 || chr(10) || l2 END AS lines
  FROM ahead),
later AS (
  SELECT doc_id, first, last,
         row_number() OVER (PARTITION BY lines ORDER BY doc_id, first) AS nth
  FROM windows WHERE last IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS n FROM later WHERE nth > 1),
kept AS (
  SELECT raw.doc_id, count(*) FILTER (gone.n IS NOT NULL) AS removed,
         coalesce(string_agg(l, chr(10) ORDER BY raw.n) FILTER (gone.n IS NULL), '') AS text
  FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.n = gone.n GROUP BY raw.doc_id)
SELECT doc_id, len(ls)::BIGINT AS n_lines, removed::BIGINT AS n_removed, sha256(kept.text) AS text_sha256
FROM docs JOIN kept USING (doc_id)
""")
def op3_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                          F.sha2("text", 256).alias("text_sha256"))


@BOOK.query()
def op4_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@BOOK.query()
def op5_bpe_speculative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


@BOOK.query()
def op6_token_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.segments(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return token_files.documents_in(written)


@BOOK.query(rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                           '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS word
  FROM documents),
tf AS (SELECT doc_id, word, count(*)::DOUBLE AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*)::DOUBLE AS length FROM words GROUP BY doc_id),
size AS (SELECT (SELECT count(*) FROM documents) AS n,
                greatest(1.0, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents)::DOUBLE) AS mean),
idf AS (SELECT word, round(ln(1 + (n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)), 9) AS idf
        FROM tf, size GROUP BY word, n),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(idf * d.tf * 2.2::DOUBLE / (d.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 6) AS score
  FROM tf q JOIN tf d ON q.word = d.word JOIN idf ON idf.word = q.word JOIN lengths ON lengths.doc_id = d.doc_id, size
  WHERE q.doc_id % 100 = 0
  GROUP BY q.doc_id, d.doc_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS place, doc_id, score
FROM scores QUALIFY place <= 10
""")
def op7_bm25_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 100, as a query against all documents."""
    docs = _table(spark, sf_dir, "documents")
    queries = docs.where(F.col("doc_id") % 100 == 0).select(
        F.col("doc_id").cast("long").alias("query_id"), whole_text().alias("text"))
    return topk.top_k(docs, queries)


@BOOK.query()
def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@BOOK.query(f"""
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@BOOK.query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@BOOK.query()
def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_tokenizer.aligned(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"),
                                    _tokenizer("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return found.withColumn("groups_sha256", digest).drop("groups")


@BOOK.query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, by their ids, end in a repeated passage, as the contract has it."""
    return periodic_runs.digests(periodic_runs.collapsed(_table(spark, sf_dir, "documents"), periodic_runs.repeated_tail))


@BOOK.query()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.found(_table(spark, sf_dir, "documents")))


def queries():
    return {name: fn for name, (fn, _) in BOOK.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in BOOK.items() if sql}
