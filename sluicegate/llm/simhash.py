"""SimHash near-duplicates, found with BK-trees.

Fingerprint: words are runs of bytes other than ASCII white space, A-Z lower-cased; every shingle
of ``width`` words (joined by a space, repeats included) is hashed with XXH64, seed 42; a bit is
1 if it is 1 in over half the hashes.  Fewer words: the whole sequence is the one shingle; none:
the fingerprint is zero, linked like any other.  Null texts are empty.

Linking: fingerprints (each once, however many documents have it) are dealt to shards by every
choice of 3 of 6 blocks of their bits: two fingerprints that differ in at most 3 bits agree in
some choice.  Each shard is a BK-tree: children hang by their distance to the parent, and a search
follows only edges within the radius of the distance to the node.  A shard's tree and its queries
meet in one task; no tree is sent to all, as the trees together grow with the data.  A shard of more than
``MOST`` fingerprints is dealt again, by choices of 3 of 6 blocks of the bits that its members need not
agree in, which loses no link either; after three deals so few bits are left that no shard is large.  A
shard tells the links that connect it (each fingerprint to the least of its cluster), not all
pairs.  Clusters then grow together by label propagation between stored tables.

Repeated rows and copies share a fingerprint and a component.  A null id is in its class like any other, but
is its component only if the class has no other id.  Texts are read whole, shingles some thousands at
a time.  An empty table gives no rows; other columns are not looked at."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, text_batches, tidy, whole_groups

DEALS = 3  # at most; shards of the last agree in all but about 8 bits
MOST = 4000  # fingerprints of a shard that is not dealt again
BROADCAST_SHARDS = 100_000  # large shards, 16 bytes each; more are joined by a shuffle


def text_fingerprint(texts, width=3):
    """Unsigned 64-bit fingerprints of texts."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= width:
            out[i] = digest(line, 42)
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: -width]]).tolist()
        ends = (ends[width - 1 :] - 1).tolist()
        n, counts = len(starts), np.zeros(64, np.int64)
        for low in range(0, n, 1 << 14):
            part = zip(starts[low : low + (1 << 14)], ends[low : low + (1 << 14)])
            hashes = np.array([digest(line[a:b], 42) for a, b in part], "<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs, width=3, doc_id="doc_id", text="text"):
    """doc_id and its fingerprint as a signed 64-bit number."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            found = text_fingerprint(batch.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"]
            )

    text_batches(docs)
    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return wanted.mapInArrow(tidy(compute), f"doc_id {kind}, fingerprint bigint")


class Trees:
    """BK-trees of many shards, built and searched together.

    ``shards`` numbers the tree of each fingerprint; fingerprints of a tree are distinct."""

    def __init__(self, prints, shards):
        self.prints = prints
        n = len(prints)
        first = np.concatenate([[True], shards[1:] != shards[:-1]]) if n else np.zeros(0, bool)
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        waiting, at = np.flatnonzero(~first), self.root[~first]
        while len(waiting):  # all insertions go down one level at a time
            d = np.bitwise_count(prints[waiting] ^ prints[at]).astype(np.int64)
            order = np.lexsort((waiting, d, at))
            waiting, at, d = waiting[order], at[order], d[order]
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (d[1:] != d[:-1])])
            child = waiting[new]
            parent[child], edge[child] = at[new], d[new]
            at = child[np.cumsum(new) - 1]
            waiting, at = waiting[~new], at[~new]
        kids = np.flatnonzero(parent >= 0)
        kids = kids[np.lexsort((edge[kids], parent[kids]))]
        self.kids, self.edges = kids, edge[kids]
        self.place = parent[kids] * 65 + self.edges  # sorted: children of a node by edge
        self.parent = parent

    def near(self, queries, radius, step=1 << 15):
        """Yields arrays (query, node) of other fingerprints within the radius."""
        for low in range(0, len(queries), step):
            q = queries[low : low + step]
            stack = [(q, self.root[q])]
            while stack:
                q, node = stack.pop()
                if len(q) > step:
                    stack += [(q[step:], node[step:])]
                    q, node = q[:step], node[:step]
                d = np.bitwise_count(self.prints[q] ^ self.prints[node]).astype(np.int64)
                hit = (d <= radius) & (q != node)
                if hit.any():
                    yield q[hit], node[hit]
                a = np.searchsorted(self.place, node * 65 + np.maximum(d - radius, 0))
                b = np.searchsorted(self.place, node * 65 + np.minimum(d + radius, 64), "right")
                count = b - a
                if count.any():
                    reach = np.repeat(np.arange(len(q)), count)
                    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    stack.append((q[reach], self.kids[a[reach] + inside]))


def shard_links(prints, shards, radius):
    """For each fingerprint, the place of the least of its cluster within its shard."""
    trees, label = Trees(prints, shards), np.arange(len(prints))
    alone = np.bincount(shards, minlength=1)[shards] == 1 if len(shards) else np.zeros(0, bool)
    for q, node in trees.near(np.flatnonzero(~alone), radius):
        while True:
            a, b = label[q], label[node]
            differ = a != b
            if not differ.any():
                break
            q, node, a, b = q[differ], node[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:  # every label points at itself in the end
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def choices(mask):
    """Masks of 3 of 6 blocks of the bits that are not in ``mask``, with these."""
    free = [1 << b for b in range(64) if not mask >> b & 1]
    blocks = [sum(free[len(free) * k // 6 : len(free) * (k + 1) // 6]) for k in range(6)]
    return [mask | sum(three) for three in itertools.combinations(blocks, 3)]


def signed(mask):
    return mask - (1 << 64) if mask >> 63 else mask


def linked(dealt, radius):
    """Links ``a, b`` within shards (columns deal, key, fingerprint)."""

    def link(batches):
        for table in whole_groups(batches, ["deal", "key"], 100_000):
            table = table.combine_chunks()
            deal, key, found = (table.column(k).to_numpy() for k in ("deal", "key", "fingerprint"))
            new = (deal[1:] != deal[:-1]) | (key[1:] != key[:-1])
            shards = np.concatenate([[0], np.cumsum(new)])
            label = shard_links(found.view(np.uint64), shards, radius)
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[label[at]]), pa.array(found[at])], ["a", "b"]
            )

    return (
        dealt.select("fingerprint", "deal", "key")
        .repartition("deal", "key")
        .sortWithinPartitions("deal", "key")
        .mapInArrow(tidy(link), "a bigint, b bigint")
        .distinct()
    )


def links(prints, radius=3):
    """Links ``a, b`` between different fingerprints (one column ``fingerprint``, each once)."""
    if not 0 <= radius <= 3:
        raise ValueError("choices of 3 of 6 blocks find distances up to 3")
    spark, masks = prints.sparkSession, choices(0)
    keys = [
        F.struct(F.lit(n).alias("deal"), F.col("fingerprint").bitwiseAND(F.lit(signed(m))).alias("key"))
        for n, m in enumerate(masks)
    ]
    dealt = prints.select("fingerprint", F.explode(F.array(*keys)).alias("at"))
    dealt, found = dealt.select("fingerprint", "at.deal", "at.key"), None
    for turn in range(DEALS):
        some = dealt
        if turn < DEALS - 1:
            large = dealt.groupBy("deal", "key").agg(F.count("*").alias("n")).where(F.col("n") > MOST)
            large = checkpointed(large.select(F.col("deal").alias("_deal"), F.col("key").alias("_key")))
            many = large.count()
            large = F.broadcast(large) if many <= BROADCAST_SHARDS else large
            same = (F.col("deal") == F.col("_deal")) & (F.col("key") == F.col("_key"))
            some = dealt.join(large, same, "left_anti") if many else dealt
        found = linked(some, radius) if found is None else found.unionByName(linked(some, radius))
        if turn == DEALS - 1 or not many:
            return found if turn == 0 else found.distinct()
        # a row per deal and choice that may follow it: 400, then 8,000
        after = [(n, m) for n, mask in enumerate(masks) for m in choices(mask)]
        table = spark.createDataFrame(
            [(n, k, signed(m)) for k, (n, m) in enumerate(after)], "_old int, _new int, _mask bigint"
        )
        deeper = dealt.join(large, same, "left_semi").join(F.broadcast(table), F.col("deal") == F.col("_old"))
        masks = [m for _, m in after]
        dealt = deeper.select(
            "fingerprint",
            F.col("_new").alias("deal"),
            F.col("fingerprint").bitwiseAND(F.col("_mask")).alias("key"),
        )


def components(edges):
    """``node, component`` (the least node reachable) of all nodes with an edge ``a, b``.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    least neighbour, then its smaller neighbours and itself to the least of these.  Both are
    grouped minima and joins; each round's links are stored."""
    now = edges.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).where("a < b")
    now = checkpointed(now.distinct())
    state = None
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select("b", F.col("m").alias("a"))
        large = large.distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.where("a != m").select(F.col("a").alias("b"), F.col("m").alias("a"))
        small = small.unionByName(least.select("b", F.col("m").alias("a"))).distinct()
        now = checkpointed(small)
        last, state = state, now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )


def near_duplicates(docs, width=3, radius=3, doc_id="doc_id", text="text"):
    """doc_id, fingerprint (16 hexadecimal digits), component_id (least doc_id reachable)."""
    rows = checkpointed(fingerprints(docs, width, doc_id, text))
    prints = checkpointed(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    grown = components(links(prints.select("fingerprint"), radius))
    named = prints.join(grown, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "component").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
