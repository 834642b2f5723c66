"""Merkle manifest of a dataset: a tree of digests per partition and one over their roots.

A leaf is the digest of a row's columns, each ``-`` if null, else its size in UTF-8 bytes, a colon and
its value.  Leaves are numbered in order within their tree.  Every level is stored and joins itself:
each node equijoins the nodes at its computed sibling indices (the index XOR 1 for two a run, slot
offsets otherwise), then the rows of slot zero emit the parents, the digests of their runs.  Proofs go the
other way: a node's proof is its siblings followed by its parent's proof, joined level by level.

Digests travel as 32 bytes and are hashed as lower-case hex text.  A proof is the siblings' digests
in order; slots and run sizes follow from a leaf's number and the size of its tree, so a root can be
folded from (leaf, number, size, proof) alone.  Texts are hashed where they are read and never shuffled.

Joins go by tree and number, so no tree is ever in one task, however large its share.  Levels that
are known to fit ``BROADCAST_BYTES`` are broadcast, the rest are shuffled; results are the same.

Nulls: a null partition value is a value of its own, the first; null ids come first.  Rows of one id are in
the order of their digests; repeated rows are leaves of their own with equal digests, and which of them has
which place is the only thing that is open (their proofs differ by place).  An empty table gives no
rows.  Only the columns named are read."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, partitions
from sluicegate.session import work_dir

BROADCAST_BYTES = 2 << 20
ROWS = 100_000  # of a stored level in one file, at least
NODE_BYTES = 64  # of a node in memory, without its proof


def digest(text):
    """The digest of a text, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def as_text(binary):
    """Digests, one or several in a row, as lower-case hex."""
    return F.lower(F.hex(binary))


def field(column):
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns, replaced=None):
    """The digest of a row's columns; ``replaced``: text columns in place of some of them."""
    replaced = replaced or {}
    return digest(F.concat(*[replaced.get(c, field(c)) for c in columns]))


def in_order(frame, order, name):
    """The rows, stored, with ``name``: 0, 1, 2, ... in the order of columns.

    Rows are dealt out by ranges of ``order``, which should tell all rows apart.  Numbers within a
    range are moved up by the rows of the ranges before: one row a range."""
    dealt = frame.repartitionByRange(partitions(frame.sparkSession), *order)
    at = F.monotonically_increasing_id()  # range above, turn in the range below
    stored = checkpointed(dealt.sortWithinPartitions(*order).withColumn("_at", at))
    parts = stored.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    turn = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(F.broadcast(parts), F.shiftright("_at", 33) == F.col("_part"))
        .withColumn(name, turn + F.col("_before"))
        .drop("_at", "_part", "_before")
    )


def placed(leaves, partition, order):
    """tree, idx, size of every leaf, beside its columns, and the trees (tree, partition value, size).

    Trees are numbered in the order of their partition values, leaves within their tree."""
    salt = F.monotonically_increasing_id()  # tells repeated rows apart, so that ranges can split them
    by = [F.col(partition).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    numbered = in_order(leaves.withColumn("_salt", salt), [*by, "_salt"], "_place").drop("_salt")
    groups = numbered.groupBy(partition).agg(
        F.min("_place").alias("_first"), F.count("*").alias("size")
    )
    trees = in_order(groups, [F.col("_first")], "tree")
    trees = kept(trees.withColumnRenamed(partition, "_value"), ROWS * partitions(trees.sparkSession))
    joined = numbered.join(
        sized(trees, trees.count(), 64), F.col(partition).eqNullSafe(F.col("_value"))
    )
    joined = joined.withColumn("idx", F.col("_place") - F.col("_first"))
    return joined.drop("_place", "_first", "_value"), trees


def sized(frame, rows, each):
    """The frame, to be broadcast if so many rows of so many bytes fit."""
    return F.broadcast(frame) if rows * each <= BROADCAST_BYTES else frame


def kept(frame, rows):
    """The frame, written to the shared folder and read again; small ones in few files.

    A checkpoint would do, but keeps what the optimizer knows about the columns: with a join per
    level that grows until planning takes minutes and most of the driver's memory."""
    spark, files = frame.sparkSession, max(1, math.ceil(rows / ROWS))
    path = work_dir(spark, "merkle")
    (frame.coalesce(files) if files < partitions(spark) else frame).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def level_rows(trees, fanout):
    """Nodes of each level in trees that have not ended there: one row of at most 64 numbers."""
    rows, sizes = [], trees.agg(F.max("size")).first()[0] or 0
    size = F.col("size")
    while sizes > 1:
        rows.append(F.coalesce(F.sum(F.when(size > 1, size)), F.lit(0)))
        size, sizes = F.ceil(size / fanout), -(-sizes // fanout)
    return list(trees.agg(*rows).first()) if rows else []


def siblings(nodes, rows, fanout):
    """The nodes with ``others``: their siblings' digests, in order of slots, and ``left``: how many
    of them are to the left."""
    found, slot = nodes, F.col("idx") % fanout
    names = []
    for offset in range(1, fanout):
        name, at = f"_o{offset}", F.col("idx") % fanout
        if fanout == 2:
            wanted = F.col("idx").bitwiseXOR(F.lit(1))
        else:  # where a node is a sibling at this offset of
            wanted = F.col("idx") - at + (at + fanout - offset) % fanout
        side = nodes.select(
            F.col("tree").alias("_tree"), wanted.alias("_idx"), F.col("digest").alias(name)
        )
        same = (F.col("tree") == F.col("_tree")) & (F.col("idx") == F.col("_idx"))
        found = found.join(sized(side, rows, NODE_BYTES), same, "left").drop("_tree", "_idx")
        names.append(name)
    none = F.lit(b"")
    if fanout == 2:
        others = F.coalesce(names[0], none)
    else:  # offsets that stay in the run come after the node, the others before it
        early = [F.when(slot + o >= fanout, F.coalesce(F.col(n), none)).otherwise(none) for o, n in enumerate(names, 1)]
        late = [F.when(slot + o < fanout, F.coalesce(F.col(n), none)).otherwise(none) for o, n in enumerate(names, 1)]
        others = F.concat(*early, *late)
    return found.withColumn("others", others).drop(*names)


def climb(nodes, trees, fanout):
    """(levels, roots): each level's nodes with their siblings, stored, and ``tree, root``.

    ``nodes``: tree, idx, size, digest of the leaves; ``trees``: tree, size."""
    levels, ended = [], nodes.where("size = 1").select("tree", F.col("digest").alias("root"))
    for rows in level_rows(trees, fanout):
        level = kept(siblings(nodes.where("size > 1"), rows, fanout), rows)
        levels.append((level, rows))
        nodes = level.where(F.col("idx") % fanout == 0).select(
            "tree",
            F.floor(F.col("idx") / fanout).alias("idx"),
            F.ceil(F.col("size") / fanout).alias("size"),
            digest(F.concat(as_text(F.col("digest")), as_text(F.col("others")))).alias("digest"),
        )
        done = nodes.where("size = 1").select("tree", F.col("digest").alias("root"))
        ended = ended.unionByName(done)
    return levels, kept(ended, trees.count())


def proofs(levels, fanout):
    """tree, idx, proof of every leaf that has siblings: digests in a row, from its level to the root."""
    above, count = None, 0
    for depth, (level, rows) in enumerate(reversed(levels)):
        if above is None:
            found = level.select("tree", "idx", F.col("others").alias("proof"))
        else:
            each = NODE_BYTES + 32 * (fanout - 1) * depth
            up = above.select(
                F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("proof").alias("_proof")
            )
            same = (F.col("tree") == F.col("_tree")) & (F.floor(F.col("idx") / fanout) == F.col("_idx"))
            proof = F.concat("others", F.coalesce("_proof", F.lit(b"")))
            found = level.join(sized(up, count, each), same, "left").select(
                "tree", "idx", proof.alias("proof")
            )
        above, count = kept(found, rows), rows
    return above


def folded(start, idx, size, proof, fanout=2):
    """Column: the root that a leaf's digest, number, tree size and proof lead to.

    With a null proof or size 1 the leaf is the root."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    state = F.struct(
        start.alias("node"), idx.cast("long").alias("idx"), size.cast("long").alias("size"), zero.alias("at")
    )
    part = lambda s, first, n: F.substring(F.coalesce(proof, F.lit(b"")), (first * 32 + 1).cast("int"), (n * 32).cast("int"))

    def step(s, _):
        slot = s["idx"] % fanout
        run = F.least(F.lit(fanout).cast("long"), s["size"] - s["idx"] + slot)
        before, after = part(s, s["at"], slot), part(s, s["at"] + slot, run - one - slot)
        up = digest(F.concat(as_text(before), as_text(s["node"]), as_text(after)))
        open_ = s["size"] > 1
        return F.struct(
            F.when(open_, up).otherwise(s["node"]).alias("node"),
            F.floor(s["idx"] / fanout).alias("idx"),
            F.ceil(s["size"] / fanout).alias("size"),
            F.when(open_, s["at"] + run - one).otherwise(s["at"]).alias("at"),
        )

    levels = F.ceil(F.log(float(fanout), F.greatest(size, F.lit(2)).cast("double"))) + 1
    steps = F.sequence(F.lit(1), levels.cast("int"))
    return F.aggregate(steps, state, step, lambda s: s["node"])


def manifest(leaves, partition, order, fanout=2, carried=()):
    """The rows of ``leaves`` (a binary column ``digest`` among them) with their place in the manifest.

    Gives the columns of partition and order, digest, those to be ``carried``, and tree, idx, size (of the row's tree), trees, subroot, root, proof, top_proof (binary; the proof
    leads from leaf to subroot, the top proof from there to root)."""
    named = dict.fromkeys([partition, *order, "digest", *carried])
    leaves, trees = placed(leaves.select(*named), partition, [*order, "digest"])
    leaves = kept(leaves, ROWS * partitions(leaves.sparkSession))
    nodes = leaves.select("tree", "idx", "size", "digest")
    levels, subroots = climb(nodes, trees, fanout)
    count = trees.count()
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
        F.lit(count).cast("long").alias("size"), F.col("root").alias("digest"),
    )
    whole = trees.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("size")
    )
    top_levels, roots = climb(tops, whole, fanout)
    root = F.broadcast(roots.select("root"))  # one row
    named = subroots.select(F.col("tree").alias("_tree"), F.col("root").alias("subroot")).crossJoin(root)
    top = proofs(top_levels, fanout)
    if top is None:
        named = named.withColumn("top_proof", F.lit(b""))
    else:
        named = named.join(
            top.select(F.col("idx").alias("_idx"), F.col("proof").alias("top_proof")),
            F.col("_tree") == F.col("_idx"), "left",
        ).drop("_idx")
    named = kept(named.withColumn("trees", F.lit(count).cast("long")), count)
    found = leaves.join(
        sized(named, count, NODE_BYTES + 96 + 32 * len(top_levels) * (fanout - 1)),
        F.col("tree") == F.col("_tree"),
    ).drop("_tree")
    below = proofs(levels, fanout)
    if below is None:
        return found.withColumn("proof", F.lit(b""))
    below = below.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("proof").alias("_proof"))
    same = (F.col("tree") == F.col("_tree")) & (F.col("idx") == F.col("_idx"))
    each = NODE_BYTES + 32 * len(levels) * (fanout - 1)
    joined = found.join(sized(below, levels[0][1], each), same, "left")
    return joined.withColumn("proof", F.coalesce("_proof", F.lit(b""))).drop("_tree", "_idx", "_proof")
