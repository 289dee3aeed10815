"""The queries of the ``llm`` operators, one ``opN_<name>`` each, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import content_sort, decontaminate, hard_negatives, langid, line_templates, mixing, near_dup, ogg, secret_scan, sharding, unigram, variants, warc
from .workspace import stage

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captured_pages(table(spark, sf_dir, "pages"))


def captured_pages(pages: DataFrame, salts: int = 16) -> DataFrame:
    """One row per row of ``pages``, from the archives that hold them."""
    captures = warc.round_trip(pages)
    page = F.regexp_extract(F.get("metadata", F.lit(0))["fields"], r"pageId: (-?\d+)", 1)
    # a revisit holds no payload: its size and digest are those that its headers keep
    full = F.when(F.col("kind") == "revisit", F.col("declared_bytes")).otherwise(F.col("payload_bytes"))
    digest = F.when(F.col("kind") == "revisit", F.regexp_replace("payload_digest", "^sha1:", "")).otherwise(F.col("payload_sha1"))
    rows = stage(captures.select("record_id", F.when(page != "", page).cast("bigint").alias("page_id"), full.alias("payload_bytes"), digest.alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers_to").alias("target"), F.col("request").isNotNull().alias("has_request")), "warc-captures")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    # only revisits look for their response; those of one response are dealt over several keys
    revisits = rows.where("target is not null").withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(salts)).cast("int"))
    wanted = rows.where("target is not null").select("target").distinct()
    stored = rows.where("target is null").select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    stored = stored.join(wanted, "target").select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    found = revisits.join(stored, ["target", "salt"], "left").select(*columns, "refers_to", "has_request")
    return rows.where("target is null").select(*columns, F.lit(None).cast("bigint").alias("refers_to"), "has_request").unionAll(found)


def op2_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stored = stage(ogg.to_media(docs, F.col("text"), [F.col("doc_id")]), "ogg")
    return ogg.from_media(stored, F.col("media"), [F.col("doc_id"), F.col("n_bytes")])


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs).select("doc_id", "n_dropped", "text")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, pieces = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.words_taken(sizes, pieces).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.classes(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def op6_shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", SHARDS)


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = secret_scan.train(secret_scan.training_samples(spark, docs.where(~_held_out())))
    found = secret_scan.scan(docs.select("doc_id", "text"), "text", ratios)
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    digest = F.sha2(secret_scan.written(base).cast("binary"), 256)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), digest.alias("base_sha256"), secret_scan.written(F.col("secrets")).alias("spans"))


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~_held_out()), "text", "lang")
    return langid.predict(docs, F.col("text"), model, [F.col("doc_id"), _held_out().alias("held_out")])


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, F.col("text"), items, [F.col("doc_id")])
    return found.select("doc_id", (F.size("found") > 0).alias("contaminated"), F.transform("found", lambda x: x["item"]).alias("items"), F.transform("found", lambda x: x["distance"]).alias("distances"))


def op10_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return unigram.count_tokens(docs, F.col("text"), unigram.default_vocabulary(spark), [F.col("doc_id")])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, "vec_id", label, hard_negatives.whole_numbers(F.col("embedding")), F.col("vec_id") % 100 == 0)


def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = content_sort.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, least = table(spark, sf_dir, "documents"), 7
    words = F.transform(variants.runs(F.col("text"), least), lambda run: variants.damaged(F.col("doc_id"), run))
    return variants.group_variants(variants.vocabulary(docs, words, least))


QUERIES = {f.__name__: f for f in (op1_warc_captures, op2_ogg_media, op3_line_templates, op4_source_mix, op5_near_duplicates, op6_shard_placement, op7_secret_spans, op8_language, op9_contamination, op10_unigram_counts, op11_hard_negatives, op12_content_sort, op13_spelling_variants)}
