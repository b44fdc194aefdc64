"""Queries of the operators over the given tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import bpe, ctw, exact, license, mix, near, quality, records, search, splitters, suffix, webtext, whitening
from tickbars.llm.shipping import ship
from tickbars.session import scratch_path


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.dedup(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(documents(spark, sf_dir))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(documents(spark, sf_dir))


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return splitters.shard(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(documents(spark, sf_dir))


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    files = records.write(documents(spark, sf_dir), folder, vocabulary())
    return records.summaries(spark, folder, files)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), vocabulary())


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source, language and ranges of ids are directories; one that begins with a
    licence line is a licence file of its thousand."""
    docs = documents(spark, sf_dir)
    number = F.col("doc_id")
    thousand = F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.floor(number / 1000)
    )
    begins = F.substring_index("text", "\n", 1).rlike(r"(?i)\blicen[sc]ed?\b")
    below = F.when(begins, F.concat(F.lit("LICENSE."), number)).otherwise(
        F.concat(F.floor(number / 100), F.lit("/"), number, F.lit(".txt"))
    )
    return license.scan(docs.select("doc_id", F.concat(thousand, F.lit("/"), below).alias("path"), "text"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return suffix.remove(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return webtext.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mix": op3_mix,
    "op4_shard": op4_shard,
    "op5_ctw": op5_ctw,
    "op6_records": op6_records,
    "op7_bpe": op7_bpe,
    "op8_quality": op8_quality,
    "op9_license": op9_license,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_search": op11_search,
    "op12_html": op12_html,
    "op13_whitening": op13_whitening,
}

WORDS = r"[^\x20\x09-\x0D]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

# SQL of the queries whose rows a contract fixes and SQL can express.
SQL: dict[str, str] = {
    "op1_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least ON u = doc_id""",
    "op2_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY plain) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM k""",
    "op11_search": f"""
WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents),
sizes AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, CAST(sum(times * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term), sizes GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
