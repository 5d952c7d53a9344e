"""The registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, doc_fingerprints, html_wrappers, importance, language_id, merkle, packing, pii
from . import simhash_dedup, suffix_dedup, toxicity, url_filters
from .common import read_table
from .oracles import ORACLE


def crc_mod(column: str, n: int) -> Column:
    """The CRC-32 of the id as text, modulo ``n``; null ids have none."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def hex16(bits: str) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.cut_repeats(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    labels = simhash_dedup.near_duplicates(read_table(spark, folder, "documents"))
    return labels.select(
        "doc_id", hex16("fp").alias("fingerprint"), "component_id"
    )


# Verdict, host and path of the rules that go before the mined ones.
URL_RULES = [
    (url_filters.ALLOW, "org", "/"),
    (url_filters.BLOCK, "example.org", "/es/"),
    (url_filters.BLOCK, "example.org", "/en/1"),
    (url_filters.ALLOW, "com", "/fr/"),
    (url_filters.BLOCK, "com", "/de/"),
]


# Host words that mark a page as one to block before any mining.
SEED_HOST_WORDS = ["ads", "adult", "bets", "casino", "pills", "porn", "spam"]


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Labels to mine: a host with a seed word is to be blocked; else a page takes the label of the document of its
    id, to be blocked if that is of low quality or toxic by any of its labels."""
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    seeded = F.arrays_overlap(F.split(url_filters.host(F.col("url")), "[.-]+"), F.array(*map(F.lit, SEED_HOST_WORDS)))
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    verdict = F.when(seeded | bad, F.lit(url_filters.BLOCK)).when(F.col("doc_id").isNotNull(), F.lit(url_filters.ALLOW))
    labelled = read_table(spark, folder, "labels").groupBy("doc_id")
    documents = labelled.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    labels = pages.join(documents, F.col("page_id") == F.col("doc_id"), "left").select("page_id", verdict.alias("verdict"))
    judged = url_filters.judge(pages, labels.where("verdict IS NOT NULL"), URL_RULES, label_id_col="page_id")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.overlaps(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )
    return found.drop("text_hash")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    labels = read_table(spark, folder, "labels").where(~held_out)
    scored = toxicity.classify(read_table(spark, folder, "documents"), labels)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted, "n_hits")


def op8_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = doc_fingerprints.edited_fingerprints(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex16("fp").alias("fingerprint"),
        hex16("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_within",
    )


CONTROL_CONVERSATION = "</s>[INST] ok [/INST]"


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_CONVERSATION), (-1, 1, "assistant", CONTROL_CONVERSATION)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.readback(chat.conversations(chat.chain(rows.unionByName(planted))))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read_table(spark, folder, "documents"))

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.sort_array(F.concat("base", "more"))).alias("spans"),
    )


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_wrappers.main_texts(read_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of ids whose CRC-32 five divides are lower-cased (A-Z) after the manifest was made; their proofs fail
    where that changes anything."""
    docs = read_table(spark, folder, "documents")
    lowered = F.translate("text", importance.UPPER, importance.LOWER)
    values = [lowered if name == "text" else F.col(name) for name in merkle.FIELDS]
    tampered = F.when(crc_mod("doc_id", 5) == 0, merkle.leaf(values))
    found = merkle.proofs(docs, also={"tampered": tampered})
    refolded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        refolded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_pii": op10_pii,
    "op11_html_extraction": op11_html_extraction,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}
