"""A corpus pipeline: five stages, each one operator, over all documents.

``run`` applies the stages to the ``documents`` table.  Between stages the rows are written as Parquet
to the cluster's shared folder and read again, so a lost executor costs one stage at most."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, row_key
from sluicegate.llm.decontaminate import contaminated
from sluicegate.llm.language_id import UNKNOWN, fit, held_out, identify
from sluicegate.llm.packing import pack_documents
from sluicegate.llm.queries import table, tokenizer_path
from sluicegate.llm.simhash import near_duplicates
from sluicegate.llm.suffix_dedup import without_repeats
from sluicegate.session import work_dir


#: A repeated passage has more words than this; the shortest has one letter a word and a space between.
PASSAGE_WORDS = 50
PASSAGE_BYTES = 2 * (PASSAGE_WORDS + 1) - 1
WORDS = 400_000  # whose ids a packing worker remembers, about 80 MB


def language(spark, docs, sf_dir):
    """Keeps documents in a language.  Out: null texts, texts without letters, and what the network rejects."""
    network = fit(docs.where(~held_out()), reject=docs.where(held_out()))
    judged = identify(docs, network, label="_lang_pred", score="_lang_score")
    return judged.where(F.col("_lang_pred") != UNKNOWN).select(*docs.columns)


def near_copies(spark, docs, sf_dir):
    """Keeps the document with the least id of each class of near copies, once.

    Of rows that repeat a kept id, the one whose text has the least hash stays, and of these the first by
    the other columns.  Decisions are made on narrow rows; texts are shuffled once."""
    found = near_duplicates(docs, 3, 3).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    firsts = found.select(F.col("doc_id").alias("_first")).distinct()
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    kept = hashed.select("doc_id", "_hash").join(
        firsts, F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi"
    )
    kept = kept.groupBy(F.col("doc_id").alias("_id")).agg(F.min("_hash").alias("_least"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_least"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")] or ["_hash"]
    turn = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(*others))
    rows = hashed.join(kept, same, "left_semi").withColumn("_turn", turn).where("_turn = 1")
    return rows.select(*docs.columns)


def repeated_passages(spark, docs, sf_dir):
    """Cuts byte strings that occur twice out of the texts; keeps all documents.

    They are as long as the shortest passage of over ``PASSAGE_WORDS`` words, so every such passage goes."""
    lost = without_repeats(docs, PASSAGE_BYTES).select(
        F.col("_row").alias("_lost_row"), F.col("kept").alias("_lost_kept")
    )
    lost = lost.dropDuplicates(["_lost_row"])  # rows that repeat id and text lose the same
    joined = docs.join(lost, row_key("doc_id", "text") == F.col("_lost_row"), "left")
    text = F.coalesce("_lost_kept", "text")
    cut = {"text": text, "n_chars": F.length(text).cast("long")}
    return joined.select(*[cut[c].alias(c) if c in cut else F.col(c) for c in docs.columns])


def benchmark_leaks(spark, docs, sf_dir):
    """Drops documents in which a benchmark item is found; an item of under five tokens only where it is the
    whole document.  Null texts stay, rows that repeat each other go or stay together, and an empty
    benchmark drops nothing."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), shortest=1, whole_below=5)
    found = found.select("doc_id").distinct()
    leaks = checkpointed(found).withColumnRenamed("doc_id", "_leak")
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")


def packing(spark, docs, sf_dir):
    """Token sequences of at most 2048 ids: doc_id, piece, start, length, ids_crc32 and places.

    Null texts are empty documents of one id, repeated rows are packed each, ties of length go by id and piece.
    Workers that have served the other stages remember fewer words, for their memory."""
    return pack_documents(docs, tokenizer_path(), 2048, 0, words=WORDS)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("best_fit_packing", packing),
]

#: A trained network and a packing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
