"""Benchmark decontamination by spaced seeds, in native expressions.

A mask is laid over runs of tokens (lower case, letters and digits) and looks only at its marked
places, so a run with other tokens in the gaps gives the same hash.  Hashes of all runs of all
documents meet those of the benchmark in a join; a hit names a document, an item and how far the
item is moved along the document.  Around each hit the item is laid over the document's tokens
and compared one by one: it counts if ``span`` tokens in a row (or the item, if shorter) agree in
``share`` of their places.

The masks go by the length of an item.  For ``SPAN`` and ``SHARE`` one of them meets every placement of
the places that may differ, so no pair that the comparison accepts is missed (a test counts them all).
Documents are read under the masks of the lengths that the benchmark has.

A document is read as rows of one place each, so no array of its runs is built and the hashing and the join
are generated code; a text's tokens are the largest thing a task holds of it.

Items of fewer than ``shortest`` tokens are left out; those of fewer than ``whole_below`` match only documents
that consist of them, as a word or two stand in any text.  Null texts are empty and match nothing; null items
and items without a token are left out.  Repeated rows are judged alike and reported once per id.  Items that
repeat each other are reported each.  Empty tables give no rows.  Only the named columns are read."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, let, row_key

#: (least tokens of an item, masks): a fifth of up to 20 tokens in a row may be replaced, anywhere.
MASKS = (
    (15, ("10110001011", "10110111", "1011000010011", "1110111")),
    (10, ("111011", "1101011", "1110011")),
    (5, ("1111", "11011", "10111", "11101")),
    (4, ("1111",)),
    (3, ("111",)),
    (2, ("11",)),
    (1, ("1",)),
)
MASK_NUMBERS = {mask: n for n, mask in enumerate(m for _, masks in MASKS for m in masks)}
SPAN, SHARE = 20, 0.8
BROADCAST_ROWS = 2_000_000  # benchmark seeds, 16 bytes each; more are joined by a shuffle
BROADCAST_HITS = 200_000  # places to verify; more are joined by a shuffle
BROADCAST_TOKENS = 2_000_000  # of all items together, 8 bytes each


def token_hashes(text):
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.transform(F.regexp_extract_all(lower, F.lit(r"([\p{L}\p{N}]+)")), lambda w: F.xxhash64(w))


def masks_of(tokens):
    """The masks for items of so many tokens."""
    return next((masks for least, masks in MASKS if tokens >= least), ())


def seeds(frame, keep, masks):
    """``keep`` columns, seed, place: every run of the frame's ``_tokens`` under every mask."""
    size, place = F.size("_tokens"), F.col("_place")

    def run(mask):
        marked = [F.get("_tokens", place + i) for i, c in enumerate(mask) if c == "1"]
        number = MASK_NUMBERS[mask]  # seeds of different masks differ
        return F.when(place <= size - len(mask), F.xxhash64(F.lit(number), *marked))

    # outer: Spark would otherwise look for empty texts first and make all tokens twice; the seeds are a
    # column of their own, as a row that still has all tokens would be copied with them for each place
    places = frame.select(*keep, "_tokens", F.posexplode_outer("_tokens").alias("_place", "_token"))
    made = places.select(*keep, "_place", F.array(*map(run, masks)).alias("_seeds"))
    made = made.select(*keep, "_place", F.explode_outer("_seeds").alias("seed"))
    return made.where("seed is not null")


def item_seeds(items, least):
    """item_id, seed, _at: seeds of the items of one class of MASKS under its masks."""
    own = items.where(F.col("_least") == least).select("item_id", F.col("_item").alias("_tokens"))
    return seeds(own, ["item_id"], masks_of(least)).withColumnRenamed("_place", "_at")


def agreement(document, item, shift, span, share):
    """Column: the most places that agree in ``span`` in a row, or null if under the share."""

    def same(d, t):
        at = F.sequence(F.lit(0), F.size(t) - 1)
        return F.transform(at, lambda i: F.when(F.get(d, shift + i) == F.get(t, i), 1).otherwise(0))

    def most(found):
        width = F.least(F.size(found), F.lit(span))
        sums = F.transform(
            F.sequence(F.lit(0), F.size(found) - width),
            lambda s: F.aggregate(F.slice(found, s + 1, width), F.lit(0), lambda a, x: a + x),
        )
        return let(F.array_max(sums), lambda m: F.when(m >= F.ceil(width * F.lit(share)), m))

    pair = let(document, lambda d: let(item, lambda t: same(d, t)))
    return let(pair, most)


def contaminated(
    docs, benchmark, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
    shortest=8, span=SPAN, share=SHARE, whole_below=0,
):
    """doc_id, item_id, agreeing, compared: pairs of a document and an item found in it."""
    items = checkpointed(
        benchmark.select(
            F.col(item_id).alias("item_id"), token_hashes(F.col(item_text)).alias("_item")
        ).where(F.size("_item") >= max(1, shortest))
    )
    inside = items.where(F.size("_item") >= whole_below)
    classes = [F.when(F.size("_item") >= least, least) for least, _ in MASKS]
    classed = inside.withColumn("_least", F.coalesce(*classes))
    present = sorted(r[0] for r in classed.select("_least").distinct().collect()) or [MASKS[0][0]]
    masks = sorted({mask for least in present for mask in masks_of(least)})
    known = checkpointed(
        reduce(DataFrame.unionByName, [item_seeds(classed, least) for least in present]).distinct()
    )
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), row_key(doc_id, text).alias("_row")
    )
    runs = seeds(slim.select("_row", token_hashes(F.col("_text")).alias("_tokens")), ["_row"], masks)
    few = known.count() <= BROADCAST_ROWS
    hits = checkpointed(
        runs.join(F.broadcast(known) if few else known, "seed")
        .select("_row", "item_id", (F.col("_place") - F.col("_at")).alias("_shift"))
        .distinct()
    )
    few = hits.count() <= BROADCAST_HITS
    laid = slim.join(F.broadcast(hits) if few else hits, "_row")
    tokens = inside.agg(F.sum(F.size("_item"))).first()[0] or 0
    found = (
        laid.select("doc_id", "item_id", "_shift", token_hashes(F.col("_text")).alias("_tokens"))
        .join(F.broadcast(inside) if tokens <= BROADCAST_TOKENS else inside, "item_id")
        .select(
            "doc_id",
            "item_id",
            agreement(F.col("_tokens"), F.col("_item"), F.col("_shift"), span, share).alias("agreeing"),
            F.least(F.size("_item"), F.lit(span)).alias("compared"),
        )
        .where("agreeing is not null")
    )
    if whole_below > shortest:
        found = found.unionByName(consist_of(slim, items.where(F.size("_item") < whole_below), whole_below))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("agreeing").alias("agreeing"), F.max("compared").alias("compared")
    )


def consist_of(slim, items, below):
    """Documents whose tokens are those of a short item, as pairs of ``contaminated``."""
    short = slim.select("doc_id", token_hashes(F.col("_text")).alias("_tokens"))
    short = short.where(F.size("_tokens").between(1, below - 1))
    size = F.size("_item").alias("agreeing")
    return short.join(items, F.col("_tokens") == F.col("_item")).select(
        "doc_id", "item_id", size, F.size("_item").alias("compared")
    )
