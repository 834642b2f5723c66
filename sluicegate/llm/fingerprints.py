"""Bottom-k sketches of documents, in native expressions.

A document's shingles are runs of ``width`` words (lower case, split at white space; fewer words
are one shingle, none give an empty sketch).  Its sketch is the ``k`` least distinct 64-bit hashes
of its shingles, ascending.  Two sketches merge by keeping the k least of their union, so
sketches of parts give the sketch of the whole.  Of two sketches the k least of the union are a
fair sample of all shingles; the share found in both estimates resemblance, and with the
estimated counts, containment.

Null texts are empty.  Two empty sketches are alike (1), an empty and a full one are not (0)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluicegate.llm.common import let, partitions

K, WIDTH = 128, 5


def word_hashes(text):
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " ")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(words, width=WIDTH):
    """Hashes of runs of ``width`` of an array of word hashes; of all of them if they are fewer."""

    def runs(w):
        n = F.size(w)
        run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)])
        full = F.transform(F.sequence(F.lit(0), n - width), run)
        none = F.array().cast("array<bigint>")
        return F.when(n >= width, full).when(n > 0, F.array(F.xxhash64(w))).otherwise(none)

    return let(words, runs)


def least(hashes, k=K):
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def sketch(text, k=K, width=WIDTH):
    """Column: the bottom-k sketch of a text."""
    return least(shingle_hashes(word_hashes(F.coalesce(text, F.lit(""))), width), k)


def merge(a, b, k=K):
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_groups(rows, group, column, k=K, salts=64):
    """The sketch of all of a group's documents together, as ``group, column``.

    The k least hashes are first found in parts of a group, so no task holds a whole group."""
    hashes = rows.select(group, F.explode(column).alias("_hash"), F.rand(3).alias("_draw"))
    dealt = hashes.withColumn("_part", F.floor(F.col("_draw") * salts))
    for keys in ([group, "_part"], [group]):
        place = F.dense_rank().over(Window.partitionBy(*keys).orderBy("_hash"))
        dealt = dealt.withColumn("_place", place).where(F.col("_place") <= k)
        dealt = dealt.select(*keys, "_hash").distinct()
    return dealt.groupBy(group).agg(F.array_sort(F.collect_set("_hash")).alias(column))


def distinct_shingles(a, k=K):
    """Estimated number of different shingles; exact for fewer than k."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def resemblance(a, b, k=K):
    def share(union):
        last = F.element_at(union, -1)
        common = F.size(F.filter(F.array_intersect(a, b), lambda x: x <= last))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))

    return let(merge(a, b, k), share)


def containment(a, b, k=K):
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    share = F.least(F.lit(1.0), common / distinct_shingles(a, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).when(F.size(b) == 0, F.lit(0.0)).otherwise(share)


def as_text(a):
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def bucket_of(docs, key, buckets):
    """Column: the number of the range of ``key`` a row is in, near equal ranges; -1 for null.

    Up to 256 ranges between approximate quantiles, each cut into equal widths."""
    coarse = min(256, buckets)
    fine = -(-buckets // coarse)
    shares = [i / coarse for i in range(coarse + 1)]
    bounds = docs.select(F.col(key).cast("double")).approxQuantile(key, shares, 1 / (4 * coarse))
    bounds = sorted(set(bounds))
    if len(bounds) < 2:
        return F.when(F.col(key).isNull(), -1).otherwise(0)
    value = F.col(key).cast("double")
    inner = F.array(*map(F.lit, bounds[1:-1])).cast("array<double>")
    at = F.size(F.filter(inner, lambda b: b <= value))
    low = F.get(F.array(*map(F.lit, bounds[:-1])), at)
    high = F.get(F.array(*map(F.lit, bounds[1:])), at)
    step = F.floor((value - low) / (high - low) * fine).cast("int")
    step = F.least(F.greatest(step, F.lit(0)), F.lit(fine - 1))
    return F.when(F.col(key).isNull(), -1).otherwise(at * fine + step)


def beside_next(docs, key):
    """Rows dealt out so that a window finds the next row by descending ``key``.

    Returns the rows with ``_guest``, and the window to partition by.  The first rows of each range
    are also put, as guests, behind the rows of the range above it (those of the highest
    behind the lowest), so no window spans more than a range.  Look ahead, then drop guests."""
    spark = docs.sparkSession
    n = partitions(spark)
    dealt = docs.withColumn("_bucket", bucket_of(docs, key, 4 * n))
    first = [tuple(r) for r in dealt.groupBy("_bucket").agg(F.max(key)).collect()]  # 4n rows
    first.sort(reverse=True)
    guests = [(first[i][1], first[i - 1][0]) for i in range(len(first))]
    kind = docs.schema[key].dataType.simpleString()
    named = spark.createDataFrame(guests, f"_key {kind}, _to int")
    guest = dealt.join(F.broadcast(named), F.col(key).eqNullSafe(F.col("_key")))
    rows = dealt.withColumn("_guest", F.lit(0)).unionByName(
        guest.drop("_bucket", "_key").withColumnRenamed("_to", "_bucket").withColumn("_guest", F.lit(1))
    )
    return rows.repartition(n, "_bucket"), Window.partitionBy("_bucket")


def fingerprint_documents(docs, doc_id="doc_id", text="text", k=K, width=WIDTH):
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next lower id; after the lowest comes the highest.  Rows of one
    id follow each other by a hash of their texts, null ids come last."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    rows, window = beside_next(slim, "doc_id")
    order = window.orderBy("_guest", F.col("doc_id").desc_nulls_last(), "_tie")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("_next", F.lit(1), half)
    )
    sketched = (
        rows.withColumn("_tie", F.xxhash64("text"))
        .withColumn("_sketch", sketch(F.col("text"), k, width))
        .withColumn("_next", F.coalesce(F.lead("text").over(order), F.lit("")))
        .withColumn("_next_sketch", F.lead("_sketch").over(order))
        .where("_guest = 0")
        .withColumn("_edited", edited)
        .withColumn("_edited_sketch", sketch(F.col("_edited"), k, width))
    )
    return sketched.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_next_sketch"), k).alias("near_next"),
    )
