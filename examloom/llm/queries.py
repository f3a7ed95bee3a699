"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.llm.blocks import without_repeated_passages
from examloom.llm.decontaminate import contamination
from examloom.llm.fingerprints import as_text, fingerprints, likeness, next_ids
from examloom.llm.language import fit_languages, predicted_languages
from examloom.llm.lines import without_similar_lines
from examloom.llm.minhash import near_duplicates
from examloom.llm.packing import packed
from examloom.llm.quality import fit_quality, scored
from examloom.llm.resample import resampled
from examloom.llm.rows import with_row_key
from examloom.llm.sql import PASSAGES_SQL, RESAMPLING_SQL, STRINGS_SQL, vector_codes_sql
from examloom.llm.suffixes import without_repeated_strings
from examloom.llm.toxicity import fit_severity, severities
from examloom.llm.vectorcodes import vector_codes
from examloom.llm.warc import read_archives, resolved, with_revisits, write_archives
from examloom.session import fresh_path, written

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_document_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text and its edited form, whose last third is the head of the next document.

    One row per row of the table. Rows without a doc_id count as those of the greatest
    one, and rows that share one follow each other by a hash of their text.
    """
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    named = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = with_row_key(named, "key")
    docs = keyed.select("key", "text")
    sizes = keyed.select("key", "doc_id", F.length("text").cast("long").alias("n_chars"))
    ahead = sizes.join(next_ids(docs.select("key"), "key"), "key")
    # Both joins read one shuffle of the texts: that side is the same, and sorted at every size.
    heads = ahead.alias("a").join(docs.alias("n").hint("merge"), F.expr("a.next_key = n.key")).select(
        "a.key", "a.doc_id", "next_key", "n_chars", F.expr("substring(n.text, 1, cast(n_chars div 3 as int))").alias("head")
    )
    both = (
        docs.alias("d")
        .hint("merge")
        .join(heads.alias("h"), F.expr("d.key = h.key"))
        .select("h.doc_id", "d.key", "next_key", "n_chars", "text", "head")
        .withColumn("kept", F.expr("substring(text, 1, cast(n_chars - n_chars div 3 as int))"))
        .select(
            "doc_id", "key", "next_key", "n_chars",
            F.explode(
                F.array(
                    F.struct(F.lit(False).alias("edited"), "text", F.lit(None).cast("string").alias("digest")),
                    F.struct(
                        F.lit(True).alias("edited"), F.concat("kept", "head").alias("text"),
                        F.sha2(F.concat("kept", "head"), 256).alias("digest"),
                    ),
                )
            ).alias("v"),
        )
        .select("doc_id", "key", "next_key", "n_chars", "v.*")
    )
    found = fingerprints(both, ["doc_id", "key", "next_key", "n_chars", "edited", "digest"])
    print_ = F.struct("identity", "content", "n_pairs")
    whole = written(
        found.groupBy("key").agg(
            F.max("doc_id").alias("doc_id"), F.max("next_key").alias("next_key"), F.max("n_chars").alias("n_chars"), F.max("digest").alias("edited_sha256"),
            F.max(F.when(~F.col("edited"), print_)).alias("own"), F.max(F.when(F.col("edited"), print_)).alias("other"),
        ),
        "fingerprints",
    )
    ahead = whole.select(F.col("key").alias("next_key"), F.col("own").alias("ahead"))
    return whole.join(ahead, "next_key").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own.identity"), F.col("own.content")).alias("fingerprint"),
        as_text(F.col("other.identity"), F.col("other.content")).alias("edited_fingerprint"),
        likeness(F.col("own.content"), F.col("own.n_pairs"), F.col("other.content"), F.col("other.n_pairs")).alias("near_edited"),
        likeness(F.col("own.content"), F.col("own.n_pairs"), F.col("ahead.content"), F.col("ahead.n_pairs")).alias("near_next"),
    )


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = "regexp_extract_all(" + _LOW + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

WARC_SQL = """SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    CASE WHEN revisits THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisits THEN first_id END AS refers_to
    FROM (SELECT *, first_id <> page_id AND strlen(coalesce(html, '')) >= 1000 AS revisits
      FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages))"""

CONTAMINATION_SQL = f"""WITH item_words AS (SELECT item_id::VARCHAR AS item, {_BENCH_WORDS.format('text')} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, least(len(w), 10) AS width, w[i:i + least(len(w), 10) - 1] AS win
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
    docs AS (SELECT doc_id, coalesce({_BENCH_WORDS.format('text')}, []) AS w FROM documents),
    places AS (SELECT doc_id, width, i, w[i:i + width - 1] AS win
      FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM docs, (SELECT DISTINCT width FROM windows))),
    hits AS (SELECT doc_id, i, p.width, item FROM places p JOIN windows USING (win)),
    words AS (SELECT doc_id, count(DISTINCT place) AS n FROM
      (SELECT doc_id, unnest(range(i, i + width)) AS place FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
      sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op3_warc", WARC_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page into archives and back; ids travel as record ids.

    A null page_id comes back as null, and rows that repeat a page_id as rows of their own.
    """
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("uri"), F.encode("html", "UTF-8").alias("payload")
    )
    records = with_revisits(pages).select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none"))).alias("record_id"), "uri", "payload",
        F.concat(F.lit("urn:page:"), "refers_to").alias("refers_to"),
    )
    path = fresh_path(spark, "archives")
    write_archives(records, path)
    back = resolved(read_archives(spark, path))
    number = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    return back.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


@query("op4_substring_dedup", PASSAGES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_suffix_array_dedup", STRINGS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return severities(docs, fit_severity(docs, table(spark, sf_dir, "labels")))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("ids")


@query("op8_benchmark_decontamination", CONTAMINATION_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_similar_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


@query("op11_importance_resampling", RESAMPLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted_languages(docs, fit_languages(docs))


@query("op13_vector_codes", vector_codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))
