"""Byte-level BPE encoding and decoding with a rank file, in numpy.

A pattern cuts a text into pieces; a piece that is a token is that token.  The different other pieces
of a slice of texts are put, by length, into matrices of token numbers, one row each, padded on the
right.  In each round every row merges its leftmost pair of least rank: the pair's place takes the
merged token and the row is closed up, so the matrix gets a column narrower; rows without a pair to
merge leave it.  Ranks of pairs come from a hash table over all pairs of tokens that make a token.
Pieces of over ``WIDEST`` bytes take the same merges in the same order from a heap, as a round per
merge would cost the square of their length.  Decoding gathers the tokens' bytes.

The pattern is read with the ``regex`` module, whose letters and digits are of a newer Unicode than
those of the library that this must agree with.  Texts with a character on which they differ are cut
by a pattern with that library's classes written out, found by asking it.

Null texts are empty and have no ids.  Repeated rows and null document ids are encoded like others, an
empty table gives an empty one, other columns are not looked at.  Texts of any length are read whole, a
block of pieces at a time.  Decoding null ids gives no bytes; ids that are no tokens are an error."""

import base64
import heapq
import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import text_batches, tidy
from sluicegate.llm.tokens import text_slices

NONE = np.int32(2**31 - 1)  # the rank of a pair that is no token
WIDEST = 256
CELLS = 1 << 20  # of a matrix
LONG, BLOCK = 1 << 20, 200_000  # texts of more characters are read by blocks of pieces
MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path):
    """Token bytes and their ids, of a file with a token in base 64 and its id per line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(number) for token, number in pairs}


def pair_table(ranks):
    """Open addressing over all (left, right) whose bytes together are a token: keys and ids."""
    left, right, merged = [], [], []
    for token, number in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), merged.append(number)
    key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
    value = np.array(merged, np.int32)
    bits = max(4, int(2 * len(key)).bit_length())
    keys, values = np.full(1 << bits, -1), np.full(1 << bits, NONE)
    slot = slots(key, bits)
    while len(key):  # all keys try a place at once; of those for a free place the first has it
        free = np.flatnonzero(keys[slot] == -1)
        places, first = np.unique(slot[free], return_index=True)
        keys[places], values[places] = key[free[first]], value[free[first]]
        rest = np.ones(len(key), bool)
        rest[free[first]] = False
        key, value, slot = key[rest], value[rest], (slot[rest] + 1) & ((1 << bits) - 1)
    return keys, values


def slots(key, bits):
    with np.errstate(over="ignore"):
        return ((key.view(np.uint64) * MIX) >> np.uint64(64 - bits)).astype(np.int64)


def class_ranges(characters):
    """A set of characters as the inside of a pattern's brackets."""
    points = np.array(sorted(map(ord, characters)))
    cuts = np.flatnonzero(np.diff(points) != 1)
    first, last = points[np.r_[0, cuts + 1]].tolist(), points[np.r_[cuts, len(points) - 1]].tolist()
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first, last))


def patterns(pattern):
    """``pattern``, the same with classes written out, and the least character they differ on."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    exact, least = pattern, "\U0010ffff"
    for name in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(library.encode_ordinary(every)).decode())
        differ = theirs ^ set(regex.findall(name, every))
        if differ:
            least = min(least, min(differ))
            inside = class_ranges(theirs)
            # within brackets the ranges alone, elsewhere a class of their own
            exact = regex.sub(
                r"\[[^\]]*\]", lambda m, n=name, r=inside: m.group().replace(n, r), exact
            ).replace(name, f"[{inside}]")
    return pattern, exact, least


class Vocabulary:
    """Plain data of a rank file and a pattern (``data``), and what is done with it."""

    def __init__(self, data):
        self.ranks, self.keys, self.values, self.pattern, self.exact, self.least = data
        self.bits = len(self.keys).bit_length() - 1
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(self.ranks.values()) + 1
        tokens = [None] * size
        for token, number in self.ranks.items():
            tokens[number] = token
        self.tokens = tokens
        self.lengths = np.array([-1 if t is None else len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(np.maximum(self.lengths, 0)) - np.maximum(self.lengths, 0)
        self.bytes = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)
        self.plain, self.careful = None, None

    @staticmethod
    def data(path, pattern):
        ranks = read_ranks(path)
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("a vocabulary needs all 256 single bytes")
        return (ranks, *pair_table(ranks), *patterns(pattern))

    # Pieces

    def pieces(self, text):
        """Lists of the pieces of a text."""
        import regex

        if self.plain is None:
            self.plain = regex.compile(self.pattern)
        use = self.plain
        if not text.isascii() and max(text) >= self.least:
            if self.careful is None:
                self.careful = regex.compile(self.exact)
            use = self.careful
        if len(text) <= LONG:
            yield use.findall(text)
            return
        found = (m.group() for m in use.finditer(text))
        while block := list(itertools.islice(found, BLOCK)):
            yield block

    # Merging

    def pair_ranks(self, left, right):
        """The id of each pair's token, or NONE.  A pad (-1) is in no pair."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) << 32 | right)
        slot = slots(key, self.bits)
        at = self.keys[slot]
        out = np.where(at == key, self.values[slot], NONE)
        out[key == -1] = NONE
        open_ = np.nonzero((at != key) & (at != -1) & (key != -1))
        key, slot = key[open_], slot[open_]
        while len(key):
            slot = (slot + 1) & (len(self.keys) - 1)
            at = self.keys[slot]
            hit = at == key
            out[tuple(x[hit] for x in open_)] = self.values[slot[hit]]
            rest = ~hit & (at != -1)
            open_ = tuple(x[rest] for x in open_)
            key, slot = key[rest], slot[rest]
        return out

    def merge_rows(self, ids):
        """Yields (row numbers, their ids, how many) of a padded matrix when rows have no more merges."""
        row = np.arange(len(ids))
        rank = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while True:
            width = ids.shape[1]
            if width > 1:
                at = rank.argmin(axis=1)  # the leftmost of the least
                best = rank[np.arange(len(rank)), at]
                merges = best != NONE
            else:
                merges = np.zeros(len(ids), bool)
            if not merges.all():
                done = ids[~merges]
                yield row[~merges], done, (done >= 0).sum(axis=1)
                if not merges.any():
                    return
                ids, rank, row = ids[merges], rank[merges], row[merges]
                at, best = at[merges], best[merges]
            n = np.arange(len(ids))
            ids[n, at] = best
            keep = np.ones(ids.shape, bool)
            keep[n, at + 1] = False
            ids = ids[keep].reshape(len(n), width - 1)
            keep = np.ones(rank.shape, bool)
            keep[n, at] = False
            rank = rank[keep].reshape(len(n), width - 2)
            some = np.flatnonzero(at > 0)
            a = at[some]
            rank[some, a - 1] = self.pair_ranks(ids[some, a - 1], ids[some, a])
            some = np.flatnonzero(at < width - 2)
            a = at[some]
            rank[some, a] = self.pair_ranks(ids[some, a], ids[some, a + 1])

    def merge_long(self, piece):
        """The ids of one long piece, by a heap of (rank, place)."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        first = self.pair_ranks(ids[:-1], ids[1:])
        heap = [r << 40 | i for i, r in enumerate(first.tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(ids)
        rank = [*first.tolist(), int(NONE)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens, known = self.tokens, self.ranks

        def look(i):
            j = after[i]
            r = known.get(tokens[ids[i]] + tokens[ids[j]]) if j < n else None
            rank[i] = int(NONE) if r is None else r
            if r is not None:
                heapq.heappush(heap, r << 40 | i)

        while heap:
            r, i = divmod(heapq.heappop(heap), 1 << 40)
            if rank[i] != r:
                continue
            j = after[i]
            ids[i], rank[j], after[i] = r, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return [ids[i] for i in range(n) if rank[i] != -1]

    def encode_pieces(self, pieces):
        """Token ids of different pieces: a flat array and how many for each."""
        known = list(map(self.ranks.get, pieces))
        lists = [None] * len(pieces)
        counts = np.ones(len(pieces), np.int64)
        widths = defaultdict(list)
        for i, number in enumerate(known):
            if number is None and len(pieces[i]):
                n = len(pieces[i])
                widths[1 << (n - 1).bit_length() if n <= WIDEST else 0].append(i)
        found = []  # (piece numbers, padded ids, counts)
        for i in widths.pop(0, ()):
            ids = np.array(self.merge_long(pieces[i]), np.int32)
            found.append((np.array([i]), ids[None, :], np.array([len(ids)])))
        for width, members in widths.items():
            step = max(1, CELLS // width)
            for low in range(0, len(members), step):
                part = np.array(members[low : low + step])
                size = np.array([len(pieces[i]) for i in part])
                matrix = np.full((len(part), int(size.max())), -1, np.int32)
                raw = np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)
                matrix[np.arange(matrix.shape[1]) < size[:, None]] = self.single[raw]
                found += [(part[rows], ids, n) for rows, ids, n in self.merge_rows(matrix)]
        for members, _, n in found:
            counts[members] = n
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        starts = ends - counts
        direct = np.array([i for i, number in enumerate(known) if number is not None], np.int64)
        flat[starts[direct]] = np.array([known[i] for i in direct], np.int32)
        for members, ids, n in found:
            inside = np.arange(ids.shape[1]) < n[:, None]
            flat[(starts[members][:, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        return flat, counts

    def encode(self, texts):
        """Token ids of texts: a flat array and how many for each."""
        number = defaultdict(itertools.count().__next__)
        look, coded, sizes = number.__getitem__, [], []
        for text in texts:
            size = 0
            for block in self.pieces(text):
                coded.append(np.fromiter(map(look, block), np.int64, len(block)))
                size += len(block)
            sizes.append(size)
        flat, counts = self.encode_pieces([p.encode("utf-8") for p in number])
        coded = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(counts[coded])])
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return gathered(flat, (np.cumsum(counts) - counts)[coded], counts[coded]), np.diff(ends[at])

    def decode(self, ids):
        """The bytes of ids, and how many for each."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or self.lengths[ids].min() < 0):
            raise ValueError("an id is no token")
        return gathered(self.bytes, self.starts[ids], self.lengths[ids]), self.lengths[ids]


def gathered(flat, starts, counts):
    """Runs of a flat array, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


def offsets(counts):
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))


def broadcast_vocabulary(spark, path, pattern):
    """The vocabulary's plain data for all tasks: some MB, bounded by the file."""
    return spark.sparkContext.broadcast(Vocabulary.data(path, pattern))


def encode_documents(docs, path, pattern, doc_id="doc_id", text="text"):
    """doc_id, ids (array of int) of every whole text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = broadcast_vocabulary(docs.sparkSession, path, pattern)
    text_batches(docs)

    def encode(batches):
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in text_slices(texts):
                flat, counts = vocabulary.encode(texts[low:high])
                ids = pa.ListArray.from_arrays(offsets(counts), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), ids], ["doc_id", "ids"]
                )

    wanted = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return wanted.mapInArrow(tidy(encode), f"doc_id {kind}, ids array<int>")


def decode_documents(encoded, path, pattern, doc_id="doc_id", ids="ids"):
    """doc_id, ids, decoded (binary) of every row of ids."""
    kind = encoded.schema[doc_id].dataType.simpleString()
    shared = broadcast_vocabulary(encoded.sparkSession, path, pattern)

    def decode(batches):
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                rows = batch.slice(low, 500)
                lists = rows.column(1)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                made, lengths = vocabulary.decode(lists.flatten().to_numpy(zero_copy_only=False))
                ends = np.concatenate([[0], np.cumsum(lengths)])
                at = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(made)]
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), lists, decoded.cast(pa.binary())], ["doc_id", "ids", "decoded"]
                )

    wanted = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return wanted.mapInArrow(tidy(decode), f"doc_id {kind}, ids array<int>, decoded binary")
