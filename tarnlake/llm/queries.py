"""One query per operator over the whole of its table, and the SQL that some must agree with."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import chat, embeddings, licenses, lines, manifest, mixing, packing, quality, runs, sharding, simhash, topk, urls
from tarnlake.llm.common import prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark, d):
    return simhash.simhash_dedup(table(spark, d, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_line_dedup(spark, d):
    kept = lines.line_dedup(table(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_embedding_dedup(spark, d):
    return embeddings.embedding_dedup(table(spark, d, "embeddings"))


def op4_url_filter(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return urls.url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op5_license_scan(spark, d):
    return licenses.license_scan(table(spark, d, "documents"))


def op6_source_mix(spark, d):
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark, d):
    pieces = packing.pack(table(spark, d, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op8_sharding(spark, d):
    text = F.col("text").cast("binary")
    slim = table(spark, d, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return sharding.shard_rows(slim, "doc_id", "text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_quality_rules(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return quality.quality_rules(docs, table(spark, d, "labels")).drop("text", "quality_score")


def op10_preference_format(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    pairs = chat.preference_pairs(turns, chat.swapped_replies(turns))

    def digest(text):
        return F.sha2(text, 256)

    return pairs.select(
        "conv_id",
        "n_turns",
        "n_common",
        digest(F.col("prompt")).alias("prompt_sha256"),
        *[digest(chat.segment_text(side)).alias(f"{side}_sha256") for side in ("chosen", "rejected")],
        *[digest(chat.trained_text(side)).alias(f"{side}_trained_sha256") for side in ("chosen", "rejected")],
    )


def op11_exact_topk(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def planted(docs: DataFrame) -> DataFrame:
    """Texts of the documents whose id's CRC-32 is a multiple of 10 repeat a stretch from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words, n, g = F.col("words"), F.size("words"), F.floor(crc / 10)
    tail = F.struct(F.pmod(g, n).cast("int").alias("a"), words.alias("words"))
    period = lambda s: (1 + F.floor((n - s["a"]) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    place = lambda s, i: F.when(i < s["a"], i).otherwise(s["a"] + F.pmod(i - s["a"], period(s)))
    repeated = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(tail, i))), " ")
    split = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    # The words of the other documents stay null: their texts are not cut.
    some = docs.withColumn("words", F.when(F.pmod(crc, F.lit(10)) == 0, split))
    return some.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_word_runs(spark, d):
    found = runs.word_runs(planted(table(spark, d, "documents").select("doc_id", "text")))
    row = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines_of_runs = F.array_join(F.transform(row, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines_of_runs, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = manifest.leaf_digest("doc_id", "source", "lang", F.col("n_chars").cast("decimal(20,0)") + 1, "text")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    rows = manifest.merkle_manifest(docs, carry={"tampered": F.when(chosen, tampered)})
    folded = manifest.fold(F.coalesce("tampered", "leaf"), "proof")
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest("proof").alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_dedup,
        op2_line_dedup,
        op3_embedding_dedup,
        op4_url_filter,
        op5_license_scan,
        op6_source_mix,
        op7_packing,
        op8_sharding,
        op9_quality_rules,
        op10_preference_format,
        op11_exact_topk,
        op12_word_runs,
        op13_merkle_manifest,
    )
}
ORACLES = {
    "op2_line_dedup": lines.ORACLE,
    "op6_source_mix": mixing.ORACLE,
    "op10_preference_format": chat.ORACLE,
    "op11_exact_topk": topk.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
