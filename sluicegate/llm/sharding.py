"""Sharding of indivisible groups by best-fit decreasing.

Groups go, largest first, into the bin with the least room that still holds them; a balanced
tree over the remaining room finds it.  The smallest capacity that needs no more than the given
number of bins is found by bisection, which makes the shards near equal.

At scale: a group is all documents of one text, known by a hash of the text.  Groups larger than
a ``grain`` of the total are packed one by one, and there can only be ``grains`` of these.
Smaller groups are first dealt by hash into ``grains`` atoms, which are packed as one
each.  So the driver packs at most twice ``grains`` items, whatever the number of documents.

A null text is an empty one.  Repeated rows are copies and share a shard.  Groups are never split: one
larger than an even share has a shard of its own, larger than the rest, which are levelled without it."""

from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, numbered, partitions


class Tree:
    """An AVL tree of (room, bin)."""

    def __init__(self):
        self.root = None

    # a node is [key, left, right, height]
    @staticmethod
    def _height(node):
        return node[3] if node else 0

    def _balanced(self, node):
        def fix(n):
            n[3] = 1 + max(self._height(n[1]), self._height(n[2]))
            return n

        def turn(n, near, far):
            top = n[far]
            n[far] = top[near]
            fix(n)
            top[near] = n
            return fix(top)

        lean = self._height(fix(node)[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        heavy, light = (1, 2) if lean > 0 else (2, 1)
        child = node[heavy]
        if self._height(child[light]) > self._height(child[heavy]):
            node[heavy] = turn(child, heavy, light)
        return turn(node, light, heavy)

    def add(self, key):
        def down(node):
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = down(node[side])
            return self._balanced(node)

        self.root = down(self.root)

    def remove(self, key):
        def down(node, key):
            if key == node[0]:
                if not (node[1] and node[2]):
                    return node[1] or node[2]
                heir = node[2]
                while heir[1]:
                    heir = heir[1]
                node[0] = heir[0]
                node[2] = down(node[2], heir[0])
            else:
                side = 1 if key < node[0] else 2
                node[side] = down(node[side], key)
            return self._balanced(node)

        self.root = down(self.root, key)

    def tightest(self, room):
        """The smallest key with at least ``room``, or None."""
        node, best = self.root, None
        while node:
            if node[0][0] >= room:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best


def best_fit_decreasing(sizes, capacity, bins=None):
    """The bin of each size, and the number of bins; None if more than ``bins`` are needed.

    An item beyond the capacity gets a bin of its own."""
    tree, places, used = Tree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        key = tree.tightest(sizes[i])
        if key:
            tree.remove(key)
            places[i] = key[1]
            tree.add((key[0] - sizes[i], key[1]))
        else:
            if used == bins:
                return None, used
            places[i] = used
            tree.add((max(0, capacity - sizes[i]), used))
            used += 1
    return places, used


def near_equal(sizes, bins):
    """Bins of near equal load: best-fit decreasing at the smallest capacity that needs no more.

    An item larger than an even share of what is left has a bin of its own, the last ones."""
    total, left, alone = sum(sizes), bins, {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] * left <= total:
            break
        left -= 1
        total -= sizes[i]
        alone[i] = left
    rest = [s for i, s in enumerate(sizes) if i not in alone]
    places = iter(levelled(rest, left) if rest else ())
    return [alone[i] if i in alone else next(places) for i in range(len(sizes))]


def levelled(sizes, bins):
    """Bins at the smallest capacity; no item is larger than an even share."""
    low = max([-(-sum(sizes) // bins), *sizes, 1])
    high = max(2 * low, 1)
    best = None
    while best is None:
        best, _ = best_fit_decreasing(sizes, high, bins)
        high *= 1 if best else 2
    while low < high:
        middle = (low + high) // 2
        places, _ = best_fit_decreasing(sizes, middle, bins)
        if places is None:
            low = middle + 1
        else:
            best, high = places, middle
    return best


def assign_shards(groups, shards, group, size, grains=8192):
    """``group, shard`` for big groups, ``atom, shard`` for all others, and the atom's column.

    ``groups`` has a row per part of a group (parts are summed), with a ``size``."""
    atom = F.pmod(F.xxhash64(group), F.lit(grains)).alias("atom")
    whole = groups.groupBy(group).agg(F.sum(size).alias("size"))
    total = whole.agg(F.sum("size")).first()[0] or 0
    big = F.col("size") * grains > total  # fewer than ``grains`` of these can exist
    # the atom of a big group stays null: it is packed by itself
    bigs = [(r[0], r[1]) for r in whole.where(big).select(group, "size").collect()]
    atoms = [
        (r[0], r[1])
        for r in whole.where(~big).groupBy(atom).agg(F.sum("size").alias("size")).collect()
    ]
    bigs.sort(), atoms.sort()
    places = near_equal([s for _, s in bigs + atoms], shards) if bigs or atoms else []
    big_shards = [(g, places[i]) for i, (g, _) in enumerate(bigs)]
    atom_shards = [(a, places[len(bigs) + i]) for i, (a, _) in enumerate(atoms)]
    return big_shards, atom_shards, atom


def shard_documents(docs, shards=24, doc_id="doc_id", text="text", grains=8192):
    """doc_id, size, text_crc32, shard, slot: near equal bytes, copies of a text together."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.md5(body.cast("binary")).alias("_group"),
        )
    )
    bigs, atoms, atom = assign_shards(rows, shards, "_group", "size", grains)
    big = spark.createDataFrame(bigs, "_group string, _big int")
    small = spark.createDataFrame(atoms, "_atom long, _small int")
    placed = (
        rows.withColumn("_atom", atom)
        .join(F.broadcast(big), "_group", "left")  # at most ``grains`` rows each
        .join(F.broadcast(small), "_atom", "left")
        .withColumn("shard", F.coalesce("_big", "_small"))
        .select("doc_id", "size", "text_crc32", "shard")
    )
    return numbered(
        placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", partitions(spark)
    ).select("doc_id", "size", "text_crc32", "shard", "slot")
