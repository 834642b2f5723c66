"""One query per operator, over its whole table."""

import hashlib

from pyspark.sql import functions as F

from sluicegate.llm.byte_bpe import decode_documents, encode_documents
from sluicegate.llm.common import checkpointed
from sluicegate.llm.decontaminate import contaminated
from sluicegate.llm.fingerprints import fingerprint_documents
from sluicegate.llm.html_extract import extract_text
from sluicegate.llm.language_id import identify_documents
from sluicegate.llm.merkle import as_text, field, folded, leaf, manifest
from sluicegate.llm.packing import pack_documents
from sluicegate.llm.sharding import shard_documents
from sluicegate.llm.simhash import near_duplicates
from sluicegate.llm.suffix_dedup import removed_repeats
from sluicegate.llm.url_filter import Rule, filter_urls
from sluicegate.llm.vector_codes import books_text, compress_vectors, with_label_error
from sluicegate.llm.wavelet import store_documents

RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name="word_bpe_49k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_url_filter(spark, sf_dir):
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules=RULES)
    return judged.drop("url")


def op2_suffix_dedup(spark, sf_dir):
    # a passage of over 50 words has 49 that are whole, wherever it is set in
    return removed_repeats(table(spark, sf_dir, "documents"), 400, kept="text", words=49)


def op3_decontaminate(spark, sf_dir):
    return contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1, whole_below=5
    )


def op4_language_id(spark, sf_dir):
    return identify_documents(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048, 0)


def op6_sharding(spark, sf_dir):
    return (
        shard_documents(table(spark, sf_dir, "documents"), 24)
        .withColumn("law", F.lit("bytes"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    )


def op7_fingerprints(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_wavelet_shards(spark, sf_dir):
    return store_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op9_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 3)


def op11_vector_codes(spark, sf_dir):
    found, books = compress_vectors(table(spark, sf_dir, "embeddings"), 16, 64, 2, 256)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return with_label_error(found).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def op12_byte_bpe(spark, sf_dir):
    path, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern()
    encoded = encode_documents(table(spark, sf_dir, "documents"), path, pattern)
    return decode_documents(encoded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle_manifest(spark, sf_dir):
    docs, columns = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, more).otherwise(F.col("n_chars"))
    leaves = docs.select(
        "doc_id",
        "lang",
        leaf(columns).alias("digest"),
        leaf(columns, {"n_chars": field(more)}).alias("tampered"),
    )
    # stored, as it is read to find ranges and then dealt out by them
    found = manifest(checkpointed(leaves), "lang", ["doc_id"], carried=["tampered"])
    sub = folded(F.col("tampered"), F.col("idx"), F.col("size"), F.col("proof"))
    whole = folded(sub, F.col("tree"), F.col("trees"), F.col("top_proof"))
    return (
        found.withColumn("folded_root", as_text(whole))
        .select(
            "doc_id",
            *[as_text(F.col(c)).alias(n) for c, n in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))],
            F.sha2(F.concat(as_text(F.col("proof")), as_text(F.col("top_proof"))), 256).alias("proof_sha256"),
            "folded_root",
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_url_filter, op2_suffix_dedup, op3_decontaminate, op4_language_id,
        op5_best_fit_packing, op6_sharding, op7_fingerprints, op8_wavelet_shards,
        op9_html_extraction, op10_simhash, op11_vector_codes, op12_byte_bpe, op13_merkle_manifest,
    )
}
