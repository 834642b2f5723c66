"""Best-fit packing of token sequences by a configuration program.

A configuration is a multiset of lengths that fits one sequence.  The program over the histogram of
lengths (as few sequences as hold all pieces) is solved by multiplicative weights with a knapsack
dynamic program for pricing.  In a pass the knapsack gives the configuration of most weight among the
lengths still in demand, and it is taken as many whole times as the demand lasts, so the solution is rounded as
it grows and each step uses up a length; there is no limit to the steps.  The weights also give a bound: no
packing has fewer sequences than all pieces' weights over the most weight of a configuration.  While the
result is over the bound by more than ``TOLERANCE``, the weights of lengths that came into sequences with
room left are multiplied up and another pass is made, up to ``PASSES``; the best pass counts.

Best fit, longest first, then places the rest in the sequences' room or in new ones: the shortest lengths,
which are set aside to fill gaps (``SMALL`` of the tokens), and what a pass leaves at its end (``REST``).

Only the histogram (at most ``capacity`` numbers) reaches the driver.  Its answer is a list of
runs: places first, first+1, ... of a length in consecutive sequences; pieces take places by
their number within the length, which Spark counts.

Documents: null texts are empty, every document ends with ``end_id``.  A document longer than the
capacity, and only such a one, is cut into pieces of the capacity and a rest.  Repeated rows are packed
like others.  An empty table gives no pieces."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, numbered, partitions, text_batches, tidy
from sluicegate.llm.tokens import WORDS, array_slices, word_ids


SMALL, REST = 0.04, 0.05  # shares of the tokens that best fit places
TOLERANCE, PASSES = 0.001, 5


def best_values(values, capacity):
    """Unbounded knapsack: the most value of lengths that fit each room, 0 to ``capacity``.

    ``values[l]``: the value of length l, not above 0 for one that is not to be used."""
    lengths = np.flatnonzero(values > 0)
    low = int(lengths[0]) if len(lengths) else capacity + 1
    worth = np.where(values > 0, values, -np.inf)
    # rooms from low to low + low - 1 depend on smaller ones only, and so on: a block at a time
    padded = np.full(2 * capacity + 1, -np.inf)  # rooms below 0 in front
    best = padded[capacity:]
    best[:low] = 0
    for start in range(low, capacity + 1, low):
        rooms = min(low, capacity + 1 - start)
        most = start + rooms - 1  # the largest length that fits one of them
        before = np.lib.stride_tricks.as_strided(
            best[start - low :], (rooms, most - low + 1), (8, -8), writeable=False
        )
        found = (before + worth[low : most + 1]).max(axis=1)
        best[start : start + rooms] = np.maximum.accumulate(np.maximum(found, best[start - 1]))
    return best


def best_configuration(values, capacity):
    """The multiset of lengths (1..capacity) of the most value that fits, and the value."""
    values = np.zeros(capacity + 1) + np.pad(np.asarray(values, float), (0, capacity + 1 - len(values)))
    values[0] = 0
    best = best_values(values, capacity)
    lengths = np.flatnonzero(values > 0)
    items, room = [], capacity
    while len(lengths) and best[room] > 0:
        fits = lengths[lengths <= room]
        k = int(np.argmax(best[room - fits] + values[fits]))
        items.append(int(fits[k]))
        room -= int(fits[k])
    return items, float(best[capacity])


def one_pass(weights, demand, capacity, until):
    """``(plan, left, bound)``: configurations with how many sequences of each, in whole sequences, the
    demand they leave (at most ``until`` tokens), and the least sequences any packing of the demand has.

    ``weights``, ``demand``: by length; the weight of a length ends with its demand."""
    left, plan, bound = demand.copy(), [], 0.0
    size = np.arange(capacity + 1)
    while (left * size).sum() > until:
        items, value = best_configuration(np.where(left > 0, weights, 0.0), capacity)
        if not plan:
            bound = float((demand * weights).sum() / value)
        lengths, counts = np.unique(items, return_counts=True)
        counts = np.minimum(counts, left[lengths])
        times = int((left[lengths] // counts).min())
        left[lengths] -= times * counts
        plan.append((tuple(np.repeat(lengths, counts).tolist()), times))
    return plan, left, bound


def solve(histogram, capacity, tolerance=TOLERANCE, passes=PASSES, rate=0.5):
    """``(plan, left)``: configurations with how many sequences of each, and the pieces for best fit.

    ``histogram``: pieces by length."""
    demand = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        demand[length] = count
    size = np.arange(capacity + 1)
    tokens = demand * size
    small = np.cumsum(tokens) <= SMALL * tokens.sum()
    large = np.where(small, 0, demand)
    weights = size**1.1  # long pieces first: short ones fit later
    least = -(-int(tokens.sum()) // capacity)
    chosen = None
    for _ in range(passes):
        plan, left, bound = one_pass(weights, large, capacity, REST * tokens.sum())
        least = max(least, int(np.ceil(bound - 1e-9)))
        left = {int(x): int(n) for x, n in enumerate(left + np.where(small, demand, 0)) if n}
        filled = fill(left, capacity, plan)
        used = sum(times for _, times in filled)
        if chosen is None or used < chosen[0]:
            chosen = (used, plan, left)
        if chosen[0] <= least * (1 + tolerance):
            break
        room = np.zeros(capacity + 1)  # of the sequences a length is in, by piece
        for items, times in filled:
            free = (capacity - sum(items)) / capacity * times
            for length in items:
                room[length] += free
        weights = weights * np.exp(rate * room / np.maximum(demand, 1))
    return chosen[1], chosen[2]


def fill(left, capacity, plan):
    """Best fit, longest first, for what rounding left: [(sequence's lengths, times)].

    Equal sequences are treated together, so the work depends on lengths and runs, not on pieces.
    Open sequences are kept by their room."""
    rooms = {}  # room -> [(lengths, times)]
    for items, times in plan:
        rooms.setdefault(capacity - sum(items), []).append((tuple(items), times))
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            fits = [r for r in rooms if r >= length]
            if not fits:
                each = capacity // length
                full, rest = divmod(count, each)
                if full:
                    rooms.setdefault(capacity - each * length, []).append(((length,) * each, full))
                if rest:
                    rooms.setdefault(capacity - rest * length, []).append(((length,) * rest, 1))
                break
            room = min(fits)
            items, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            each = min(room // length, count)
            used = min(times, count // each)
            rooms.setdefault(room - each * length, []).append((items + (length,) * each, used))
            if times > used:
                rooms.setdefault(room, []).append((items, times - used))
            count -= used * each
    return [x for found in rooms.values() for x in found]


def runs(sequences):
    """Places by length: {length: (first number, per sequence, first sequence, offset)} arrays."""
    found, numbers, first = {}, {}, 0
    for items, times in sequences:
        offset = 0
        for length in sorted(set(items), reverse=True):
            each = items.count(length)
            start = numbers.get(length, 0)
            found.setdefault(length, []).append((start, each, first, offset))
            numbers[length] = start + each * times
            offset += each * length
        first += times
    return {x: np.array(rows, np.int64) for x, rows in found.items()}


def pieces(docs, path, capacity=2048, end_id=0, doc_id="doc_id", text="text", words=WORDS):
    """doc_id, piece, start, length, ids_crc32 of every document.

    ``words``: how many words a worker remembers the ids of; the result does not depend on it."""
    text_batches(docs)
    kind = docs.schema[doc_id].dataType.simpleString()

    def cut(batches):
        encoder = word_ids(path, words)
        for batch in batches:
            ids = batch.column(0)
            for low, texts in array_slices(batch.column(1)):
                found, counts = encoder.encode_array(texts)
                counts = counts + 1
                ends = np.cumsum(counts)
                tokens = np.empty(int(ends[-1]), "<u4")
                last = np.zeros(len(tokens), bool)
                last[ends - 1] = True
                tokens[~last], tokens[last] = found, end_id
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                at = (ends - counts)[row] + start
                data = memoryview(tokens).cast("B")
                crcs = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row + low)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        encoder.words.clear()  # the worker lives on

    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return wanted.mapInArrow(
        tidy(cut), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack(parts, capacity=2048, length="length", order=("doc_id", "piece")):
    """Adds sequence_id and offset.  ``parts`` is read more than once; give a stored table."""
    spark = parts.sparkSession
    histogram = {r[0]: r[1] for r in parts.groupBy(length).count().collect()}  # <= capacity rows
    if not histogram:
        empty = F.lit(None).cast("long")
        return parts.withColumn("sequence_id", empty).withColumn("offset", empty)
    plan, left = solve(histogram, capacity)
    table = spark.sparkContext.broadcast(runs(fill(left, capacity, plan)))
    names = parts.columns

    def place(batches):
        found = table.value
        for batch in batches:
            size = batch.column(names.index(length)).to_numpy(zero_copy_only=False)
            number = batch.column(len(names)).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for x in np.unique(size):
                at = np.flatnonzero(size == x)
                run = found[int(x)]
                k = np.searchsorted(run[:, 0], number[at], side="right") - 1
                turn = number[at] - run[k, 0]
                sequence[at] = run[k, 2] + turn // run[k, 1]
                offset[at] = run[k, 3] + turn % run[k, 1] * x
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + [pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    ranked = numbered(parts, [length], list(order), "_number", partitions(spark))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.select(*names, "_number").mapInArrow(
        place, f"{schema}, sequence_id bigint, offset bigint"
    )


def pack_documents(docs, path, capacity=2048, end_id=0, doc_id="doc_id", text="text", words=WORDS):
    """Pieces of all documents, packed; tokens are made once and kept as small rows."""
    return pack(checkpointed(pieces(docs, path, capacity, end_id, doc_id, text, words)), capacity)
