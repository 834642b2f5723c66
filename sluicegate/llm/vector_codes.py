"""Vector codes by Lloyd's method over cover trees, in whole numbers.

Components become floor(scale * x).  Vectors are cut into ``parts`` equal consecutive parts, each part
position with a codebook of its own.  Vectors of a partition are taken in chunks; a chunk has a
cover tree for each part position.  A node stands for a run of the chunk's points, its centre is the
first of them and its radius the largest distance from there.  A node's children are found by scale,
the largest power of two under the radius: the first point not yet covered is a child's centre and
covers what is within the scale, so children are further apart than it.  Cumulative sums over the
points in tree order give the sum of any node's points at once.

Assignment goes down all trees of a chunk together with, for each node, the entries that may be nearest
to some point of it: by the triangle inequality an entry whose distance less the radius is over the least
distance and the radius can't be.  Where one entry is left the whole subtree is assigned; only the points
of ambiguous leaves are compared exactly.  Trees do not change with the codebooks, so they are made once
and stored; a round sends one sum per part, entry and component from each task, and only the
codebooks (``parts`` x ``entries`` x width numbers) reach the driver.

Vectors that are null or have a null or non-finite component are dropped.  Vectors of another length than
most (of equally many, the longer), of a length that can't be cut into parts, or with a component of 2**17 or
more in size (sums would leave whole numbers) stay but take no part: code and error are null.  First
entries come from the vectors with the least ids, null ids last; ties go by the vectors.  With fewer
vectors than entries the codebooks are shorter.  Repeated rows are coded one by one.  An empty table gives no
rows.  Other columns are not looked at."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import checkpointed, tidy

LEAF = 16  # points of a node that is not divided
CHUNK = 1 << 19  # components of a chunk's vectors
LARGEST = 1 << 25  # of a whole number
BROADCAST_LABELS = 100_000


def squares(a, b):
    """Squared distances of rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def ranges(first, count):
    """Numbers first[0], first[0] + 1, ..., count[0] of them, then those of the next."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class Forest:
    """Cover trees of points ``[parts, n, width]``, one for each part.

    ``order``: row of ``points`` (flat) at each place; nodes by level, children of a node together:
    ``first``, ``last`` (places), ``radius``, ``child`` (the first) and ``children``."""

    def __init__(self, order, nodes, radius):
        self.order, self.radius = order, radius
        self.first, self.last, self.child, self.children = nodes

    @classmethod
    def grown(cls, points):
        parts, n, width = points.shape
        flat = points.reshape(parts * n, width)
        order = np.arange(parts * n)
        first = np.arange(parts) * n
        last = first + n
        kept, start = [], 0
        while len(first):
            where = ranges(first, last - first)
            own = np.repeat(np.arange(len(first)), last - first)
            at = np.concatenate([[0], np.cumsum(last - first)[:-1]])
            d = squares(flat[order[where]], flat[order[first]][own])
            far = np.maximum.reduceat(d, at)
            split = (last - first > LEAF) & (far > 0)
            exponent = np.zeros(len(first), np.int64)  # the scale is below the radius, its square is 4**e
            exponent[split] = np.ceil(np.log2(far[split]) / 2).astype(np.int64) - 1
            scale = 4.0**exponent
            inside = split[own]
            where, own = where[inside], own[inside]
            left, rank, turn = np.arange(len(where)), np.zeros(len(where), np.int64), 0
            while len(left):  # each node's first point left is a centre and covers others
                node = own[left]
                new = np.concatenate([[True], node[1:] != node[:-1]])
                centre = flat[order[where[left[new]]]][np.cumsum(new) - 1]
                covered = squares(flat[order[where[left]]], centre) <= scale[node]
                rank[left[covered]] = turn
                left, turn = left[~covered], turn + 1
            sort = np.lexsort((rank, own))  # keeps the order within a child
            order[where] = order[where[sort]]
            own, rank = own[sort], rank[sort]
            new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (rank[1:] != rank[:-1])])) if len(own) else np.zeros(0, np.int64)
            ends = np.concatenate([new[1:], [len(own)]]) if len(new) else new
            children = np.bincount(own[new], minlength=len(first))
            child = start + len(first) + np.cumsum(children) - children
            kept.append((first, last, child, children, np.sqrt(far.astype(float))))
            start += len(first)
            first, last = where[new], where[new] + (ends - new)
        columns = [np.concatenate(c) for c in zip(*kept)]
        return cls(order, columns[:4], columns[4])

    def assigned(self, flat, books, total):
        """The entry of each place's point; ``flat``: points in tree order, ``books``: [parts, entries,
        width].  Adds sums and counts of the points of each (part, entry) to ``total``."""
        parts, entries, width = books.shape
        n = len(flat) // parts
        cumulative = np.zeros((len(flat) + 1, width), np.int64)
        np.cumsum(flat, axis=0, out=cumulative[1:])
        entry = np.zeros(len(flat), np.int64)
        flat_books = books.reshape(parts * entries, width)
        sums, counts = total
        node = np.repeat(np.arange(parts), entries)  # the roots with all entries
        option = np.tile(np.arange(entries), parts)
        while len(node):
            part = self.first[node] // n
            d = np.sqrt(squares(flat[self.first[node]], flat_books[part * entries + option]).astype(float))
            new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            size = np.diff(np.concatenate([new, [len(node)]]))
            reach = np.minimum.reduceat(d, new) + 2 * self.radius[node[new]]
            may = d <= np.repeat(reach, size) * (1 + 1e-9) + 1e-6
            node, option = node[may], option[may]
            new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            size = np.diff(np.concatenate([new, [len(node)]]))
            one = size == 1
            whole, to = node[new[one]], option[new[one]]
            first, last = self.first[whole], self.last[whole]
            entry[ranges(first, last - first)] = np.repeat(to, last - first)
            slot = first // n * entries + to
            np.add.at(sums, slot, cumulative[last] - cumulative[first])
            np.add.at(counts, slot, last - first)
            open_ = np.repeat(~one, size)
            node, option = node[open_], option[open_]
            leaf = self.children[node] == 0
            self._compare(flat, flat_books, entries, n, node[leaf], option[leaf], entry, total)
            node, option = node[~leaf], option[~leaf]
            # each child with the node's entries
            new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else node
            size = np.diff(np.concatenate([new, [len(node)]])) if len(node) else node
            children = self.children[node[new]]
            below = ranges(self.child[node[new]], children)
            starts, sizes = np.repeat(new, children), np.repeat(size, children)
            option = option[ranges(starts, sizes)]
            node = np.repeat(below, sizes)
        return entry

    def _compare(self, flat, flat_books, entries, n, node, option, entry, total, step=1 << 20):
        """Exact comparison of the points of leaves with the entries left."""
        if not len(node):
            return
        sums, counts = total
        new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff(np.concatenate([new, [len(node)]]))
        leaves = node[new]
        points = self.last[leaves] - self.first[leaves]
        place = ranges(self.first[leaves], points)
        starts, sizes = np.repeat(new, points), np.repeat(size, points)
        ends = np.cumsum(sizes)
        low = 0
        while low < len(place):  # some points at a time
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + step)))
            own, many = place[low:high], sizes[low:high]
            choice = option[ranges(starts[low:high], many)]
            at = np.repeat(own, many)
            d = squares(flat[at], flat_books[at // n * entries + choice])
            begin = np.concatenate([[0], np.cumsum(many)[:-1]])
            least = np.repeat(np.minimum.reduceat(d, begin), many)
            hits = np.flatnonzero(d == least)  # the first of a point is the lower entry
            _, firsts = np.unique(at[hits], return_index=True)
            hits = hits[firsts]
            entry[at[hits]] = choice[hits]
            slot = at[hits] // n * entries + choice[hits]
            np.add.at(sums, slot, flat[at[hits]])
            np.add.at(counts, slot, 1)
            low = high


def whole_numbers(values, scale):
    """floor(scale * x) of an array, and whether all of them may be used."""
    found = np.floor(values.astype(float) * scale)
    fit = np.abs(found) < LARGEST
    return np.where(fit, found, 0).astype(np.int64), fit


def kept_vectors(vectors, vec_id, vector, label):
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    named = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).alias("label"),
    )
    return named.where(F.col("vector").isNotNull() & F.forall("vector", finite))


def usual_length(kept):
    found = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found[0] if found else 0


def first_books(kept, length, parts, entries, scale):
    """[parts, entries, width] of the usable vectors with the least ids."""
    fits = F.forall("vector", lambda x: (F.floor(x * scale) < LARGEST) & (F.floor(x * scale) > -LARGEST))
    small = F.forall("vector", lambda x: F.abs(x) < 2.0**40 / scale)  # else floor leaves a long
    least = (
        kept.where((F.size("vector") == length) & F.when(small, fits).otherwise(False))
        .select("vec_id", "vector")
        .orderBy(F.col("vec_id").asc_nulls_last(), "vector")
        .limit(entries)
        .collect()
    )
    found = np.array([r["vector"] for r in least], float).reshape(len(least), parts, length // parts)
    return np.ascontiguousarray(whole_numbers(found, scale)[0].transpose(1, 0, 2))


def stored_trees(kept, length, parts, scale):
    """A row per chunk: its ids and labels, points (rows in their order), and its forest."""
    kinds = [kept.schema["vec_id"].dataType, kept.schema["label"].dataType]
    rows_of = max(1, CHUNK // max(1, length))

    def grow(batches):
        for batch in batches:
            lists = batch.column(1)
            usable = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == length
            flat = lists.filter(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
            numbers, fit = whole_numbers(flat.reshape(-1, length), scale)
            fit = fit.all(axis=1)
            usable[np.flatnonzero(usable)[~fit]] = False
            numbers = numbers[fit]
            coded, plain = batch.filter(pa.array(usable)), batch.filter(pa.array(~usable))
            for low in range(0, coded.num_rows, rows_of):
                part = numbers[low : low + rows_of]
                points = np.ascontiguousarray(part.reshape(len(part), parts, -1).transpose(1, 0, 2))
                forest = Forest.grown(points)
                nodes = np.stack([forest.first, forest.last, forest.child, forest.children])
                yield packed(coded.slice(low, rows_of), [
                    part.astype("<i4"), forest.order.astype("<i4"), nodes.astype("<i4"), forest.radius.astype("<f8"),
                ])
            for low in range(0, plain.num_rows, 10_000):
                yield packed(plain.slice(low, 10_000), [None] * 4)

    def packed(rows, arrays):
        values = [pa.array([None if a is None else a.tobytes()], pa.binary()) for a in arrays]
        lists = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(i)) for i in (0, 2)]
        return pa.RecordBatch.from_arrays(lists + values, ["ids", "labels", "rows", "order", "nodes", "radius"])

    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(kinds[0])), T.StructField("labels", T.ArrayType(kinds[1]))]
        + [T.StructField(n, T.BinaryType()) for n in ("rows", "order", "nodes", "radius")]
    )
    return kept.mapInArrow(tidy(grow), schema)


def chunks(batch):
    """(row of the batch, points in tree order [parts * n, width], forest, vectors) of stored chunks."""
    for i in range(batch.num_rows):
        if not batch.column("rows")[i].is_valid:
            continue
        yield i, *(np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("rows", "<i4"), ("order", "<i4"), ("nodes", "<i4"), ("radius", "<f8")))


def restored(rows, order, nodes, radius, length, parts):
    width = length // parts
    points = rows.reshape(-1, parts, width).astype(np.int64).transpose(1, 0, 2).reshape(-1, width)
    order = order.astype(np.int64)
    return points[order], Forest(order, nodes.reshape(4, -1).astype(np.int64), radius)


def moved(trees, books, length):
    """The codebooks after a round: each entry the floor of its points' mean, unused entries as they are."""
    parts, entries, width = books.shape

    def add(batches):
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for _, *stored in chunks(batch):
                flat, forest = restored(*stored, length, parts)
                forest.assigned(flat, books, (sums, counts))
        used = np.flatnonzero(counts)
        values = np.concatenate([counts[used, None], sums[used]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width + 1)),
                pa.array(np.tile(np.arange(width + 1), len(used))),
                pa.array(values.reshape(-1)),
            ],
            ["entry", "place", "total"],
        )

    partial = trees.mapInArrow(tidy(add), "entry bigint, place bigint, total bigint")
    total = partial.groupBy("entry", "place").agg(F.sum("total").alias("total"))
    found = np.zeros((parts * entries, width + 1), np.int64)
    for entry, place, value in total.collect():  # at most parts x entries x (width + 1) rows
        found[entry, place] = value
    used = found[:, 0] > 0
    after = books.reshape(parts * entries, width).copy()
    after[used] = found[used, 1:] // found[used, :1]
    return after.reshape(books.shape)


def coded(trees, books, length, kinds):
    """vec_id, label, code (binary, a byte a part), error of every vector."""
    parts, entries, width = books.shape

    def code(batches):
        for batch in batches:
            found = {}
            for i, *stored in chunks(batch):
                flat, forest = restored(*stored, length, parts)
                n = len(flat) // parts
                entry = forest.assigned(
                    flat, books, (np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64))
                )
                d = squares(flat, books.reshape(-1, width)[np.arange(len(flat)) // n * entries + entry])
                codes, errors = np.empty(len(flat), np.uint8), np.empty(len(flat), np.int64)
                codes[forest.order], errors[forest.order] = entry, d
                found[i] = np.ascontiguousarray(codes.reshape(parts, n).T), errors.reshape(parts, n).sum(axis=0)
            for i in range(batch.num_rows):
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                n = len(ids)
                if i in found:
                    codes = pa.array([row.tobytes() for row in found[i][0]], pa.binary())
                    errors = pa.array(found[i][1])
                else:
                    codes, errors = pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, labels, codes, errors], ["vec_id", "label", "code", "error"])

    schema = T.StructType(
        [T.StructField("vec_id", kinds[0]), T.StructField("label", kinds[1])]
        + [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    )
    return trees.mapInArrow(tidy(code), schema)


def compress_vectors(
    vectors, parts=16, entries=64, rounds=2, scale=256, vec_id="vec_id", vector="embedding", label="label"
):
    """(vec_id, label, code, error of every vector kept, stored; codebooks [parts, entries, width])."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number takes one byte")
    kept = kept_vectors(vectors, vec_id, vector, label)
    length = usual_length(kept)
    if length % parts:
        length = 0
    books = np.zeros((parts, 0, 0), np.int64)
    if length:
        books = first_books(kept, length, parts, entries, scale)
    if not books.size:
        none = kept.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, books
    trees = checkpointed(stored_trees(kept, length, parts, scale))
    for _ in range(rounds):
        books = moved(trees, books, length)
    kinds = [kept.schema["vec_id"].dataType, kept.schema["label"].dataType]
    return checkpointed(coded(trees, books, length, kinds)), books


def with_label_error(found, label="label"):
    """Adds ``label_error``, the errors of all rows of a label (nulls together) in sum."""
    sums = checkpointed(found.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error")))
    side = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return found.join(side, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")


def books_text(books):
    """All entries' components as decimal numbers by part, entry and place."""
    return ",".join(map(str, books.reshape(-1).tolist()))
