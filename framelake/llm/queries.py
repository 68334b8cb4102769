"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import decontaminate, embedding, langid, mixing, negatives, passages, quality, sharding, simhash, sst, urls, warc, whitening
from framelake.llm.common import new_path, table, tidy

#: Rules of the URL filter: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
ARRIVALS = 4


def tokenizer_path() -> str:
    """Place of the tokenizer that the corpus is encoded with, from the installed vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def held_out(parts: int, part: int):
    """Whether a document's id falls in the part that is never learned from; a null id is learned from nowhere either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(True))


@tidy
def op1_sst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the shards read back: ids before it, its ids with the end id, and their CRC-32."""
    path = new_path(spark, "shards")
    sst.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return sst.digests(spark, path).withColumnRenamed("id", "doc_id")


@tidy
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, its source's words and target, and the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mixing.taken(mixing.mix(docs, carry=["doc_id", "source"]))
    return found.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken")
    )


@tidy
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its language by a model of the documents outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out(5, 0)))
    found = langid.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


@tidy
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in four commits and are compacted after each; per document of the last version: id, source and MD5 of the text."""
    docs = table(spark, sf_dir, "documents")
    store = sharding.Store(spark, new_path(spark, "store"))
    for k in range(ARRIVALS):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == k))
        store.compact()
        store.vacuum()
    return store.read().select("doc_id", "source", "n_chars", F.md5("text").alias("text_md5"))


@tidy
def op5_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: links at cosine 0.98 inside its label, and the smallest vec_id reachable."""
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@tidy
def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the longest rule that fits, and its verdict."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@tidy
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: SimHash of its 4-word shingles, and the smallest doc_id reachable over 4 or fewer differing bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = simhash.with_fingerprint(docs).select("doc_id", "fingerprint")
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@tidy
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, edits included, and where else they stand."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.repeated_passages(docs).withColumnRenamed("other", "other_doc_id")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learned from labelled documents outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    return quality.train(docs, labels)


@tidy
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the probability that its quality is 1, and whether its id was kept from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.with_score(docs, quality_model(spark, docs, sf_dir))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@tidy
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside occurrences of benchmark windows, and the items whose windows occur."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@tidy
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and leading component: its whitened coordinate, exact deviation (null beyond a long) and the share explained."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@tidy
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, from the archives read back: its payload's bytes and digest, and the page that a revisit refers to."""
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.Archives(spark, path).records().select(
        F.col("record_id").cast("long").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"),
    )


@tidy
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor and positive: up to three rows of other labels that score from 50 to 95 hundredths of the positive."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))
