"""Token ids in wavelet-matrix files, one compressed file per shard of documents.

A wavelet matrix keeps one plane of bits per bit of an id, from the highest; each plane lists the
ids stably sorted by the bits before.  With the counts of ones before each block, ``rank`` on a
plane costs one block, so a reader can give the id at a place (``access``), count an id up
to a place (``count``) and find its k-th place (``find``) and touch one block per plane.

File (little endian): the magic, a fixed header (ids, documents, planes, bits per block), then the
zeros of each plane, document ids, a byte per document that is 1 if its id is null, lengths, ones before
each block, ends of the compressed blocks, and the blocks, each a zstandard frame.

An empty table makes no file.  A document of any length is one run of ids; an empty or null text is the
end id alone."""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, partitions, text_batches
from sluicegate.llm.tokens import array_slices, word_ids
from sluicegate.session import work_dir

MAGIC = b"WVLTMTX2"
HEADER = "<QQII"
BLOCK_BITS = 1 << 19


def build(ids, documents, lengths, planes=16, block_bits=BLOCK_BITS, missing=None):
    """The file of ``ids`` (unsigned, below 2**planes), as bytes; ``missing``: documents without id."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    blocks, ones, zeros = [], [], []
    now = np.ascontiguousarray(ids)
    for plane in range(planes - 1, -1, -1):
        bits = (now & now.dtype.type(1 << plane)).astype(bool)
        for start in range(0, len(bits), block_bits):
            part = bits[start : start + block_bits]
            blocks.append(pack(np.packbits(part, bitorder="little").tobytes()))
            ones.append(np.count_nonzero(part))
        if plane:
            now = np.concatenate([now.compress(~bits), now.compress(bits)])
        zeros.append(len(bits) - np.count_nonzero(bits))
    per_plane = len(blocks) // planes
    before = np.zeros((planes, per_plane), "<u8")
    if per_plane:
        before[:, 1:] = np.cumsum(np.array(ones).reshape(planes, per_plane), axis=1)[:, :-1]
    return b"".join(
        [
            MAGIC,
            struct.pack(HEADER, len(ids), len(documents), planes, block_bits),
            np.array(zeros, "<u8").tobytes(),
            np.asarray(documents, "<i8").tobytes(),
            np.zeros(len(documents), "u1").tobytes() if missing is None else np.asarray(missing, "u1").tobytes(),
            np.asarray(lengths, "<u8").tobytes(),
            before.tobytes(),
            np.cumsum([len(b) for b in blocks]).astype("<u8").tobytes(),
            *blocks,
        ]
    )


class Reader:
    """Reads a file held as bytes (or a memory map); blocks are decompressed when needed."""

    def __init__(self, data):
        import zstandard

        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        self.data = memoryview(data)
        self.unpack = zstandard.ZstdDecompressor().decompress
        at = len(MAGIC)
        self.n, documents, self.planes, self.block_bits = struct.unpack_from(HEADER, data, at)
        at += struct.calcsize(HEADER)
        self.per_plane = -(-self.n // self.block_bits)

        def array(count, kind):
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.zeros = array(self.planes, "<u8").astype(np.int64)
        self.documents = array(documents, "<i8")
        self.missing = array(documents, "u1").astype(bool)
        self.lengths = array(documents, "<u8").astype(np.int64)
        blocks = self.planes * self.per_plane
        self.before = array(blocks, "<u8").astype(np.int64).reshape(self.planes, self.per_plane)
        self.ends = np.concatenate([[0], array(blocks, "<u8")]).astype(np.int64) + at
        self.kept = {}

    def _block(self, plane, block):
        """The bits of a block and the ones before each of them; the last block of a plane stays."""
        held = self.kept.get(plane)
        if held is None or held[0] != block:
            k = plane * self.per_plane + block
            packed = np.frombuffer(self.unpack(self.data[self.ends[k] : self.ends[k + 1]]), np.uint8)
            size = min(self.block_bits, self.n - block * self.block_bits)
            bits = np.unpackbits(packed, count=size, bitorder="little")
            held = self.kept[plane] = (block, bits, np.concatenate([[0], np.cumsum(bits)]))
        return held

    def _ones(self, plane, place):
        """Ones of a plane before a place."""
        if place <= 0:
            return 0
        if place >= self.n:
            return self.n - int(self.zeros[plane])
        block, inside = divmod(place, self.block_bits)
        return int(self.before[plane, block]) + int(self._block(plane, block)[2][inside])

    def _bit(self, plane, place):
        block, inside = divmod(place, self.block_bits)
        return int(self._block(plane, block)[1][inside])

    def _down(self, plane, place, bit):
        ones = self._ones(plane, place)
        return int(self.zeros[plane]) + ones if bit else place - ones

    def access(self, place):
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for plane in range(self.planes):
            bit = self._bit(plane, place)
            value = value << 1 | bit
            place = self._down(plane, place, bit)
        return value

    def _range(self, token, end):
        """Where the occurrences of an id before ``end`` lie in the order after the last plane."""
        start = 0
        for plane in range(self.planes):
            bit = token >> (self.planes - 1 - plane) & 1
            start, end = self._down(plane, start, bit), self._down(plane, end, bit)
        return start, end

    def count(self, token, end=None):
        """How often an id occurs before ``end``."""
        if token >> self.planes:
            return 0
        start, stop = self._range(token, self.n if end is None else min(end, self.n))
        return stop - start

    def _select(self, plane, bit, k):
        """The place of the k-th (from 0) such bit of a plane."""
        ones = self.before[plane]
        starts = np.arange(self.per_plane, dtype=np.int64) * self.block_bits
        block = int(np.searchsorted(ones if bit else starts - ones, k, side="right")) - 1
        first = int(ones[block] if bit else starts[block] - ones[block])
        _, bits, _ = self._block(plane, block)
        return block * self.block_bits + int(np.flatnonzero(bits == bit)[k - first])

    def find(self, token, k):
        """The place of the k-th occurrence (from 0) of an id, or None."""
        if token >> self.planes:
            return None
        start, stop = self._range(token, self.n)
        if not 0 <= k < stop - start:
            return None
        place = start + k
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            place = self._select(plane, bit, place - int(self.zeros[plane]) if bit else place)
        return place

    def all(self):
        """All ids in order."""
        ids = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            first = plane * self.per_plane
            bits = np.empty(self.n, bool)
            for block in range(self.per_plane):
                k, start = first + block, block * self.block_bits
                packed = self.unpack(self.data[self.ends[k] : self.ends[k + 1]])
                size = min(self.block_bits, self.n - start)
                bits[start : start + size] = np.unpackbits(
                    np.frombuffer(packed, np.uint8), count=size, bitorder="little"
                )
            back = np.empty_like(ids)
            zeros = int(self.zeros[plane])
            # places are given as numbers: several times faster than by masks
            back[np.flatnonzero(~bits)] = ids[:zeros]
            back[np.flatnonzero(bits)] = ids[zeros:] | (1 << (self.planes - 1 - plane))
            ids = back
        return ids


def filesystem(uri):
    """The file system of a folder's address, and the folder's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_shards(docs, folder, path, end_id=1, doc_id="doc_id", text="text", tokens=1_000_000):
    """Writes files of about so many ids, in ascending order of ``doc_id``.

    Returns a row per file: file, part, number (its turn within the part), first_id, n_ids,
    bytes.  Spark deals documents out by ranges of ``doc_id``; a file's name holds its attempt and
    appears only when it is complete, so a repeated task leaves at most a file that
    nobody names.  A document is never split, whatever its length; null ids come first, rows of one
    id in the order of their texts' hashes."""

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encoder, store = word_ids(path), filesystem(folder)
        files, home = store
        number, held, count = 0, [], 0  # held: (document ids, tokens, lengths)

        def flush():
            nonlocal number, held, count
            known = pa.concat_arrays([d for d, _, _ in held])
            documents = known.fill_null(0).to_numpy(zero_copy_only=False)
            missing = known.is_null().to_numpy(zero_copy_only=False)
            ids, lengths = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            data = build(ids, documents, lengths, missing=missing)
            name = f"{home}/part-{part:06d}-{number:06d}-{attempt}.wvm"
            with files.open_output_stream(f"{name}.tmp") as out:
                out.write(data)
            files.move(f"{name}.tmp", name)
            row = (name, part, number, known[0].as_py(), count, len(data))
            number, held, count = number + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.string(), *[pa.int64()] * 5))],
                ["file", "part", "number", "first_id", "n_ids", "bytes"],
            )

        for batch in batches:
            for low, texts in array_slices(batch.column(1)):
                found, lengths = encoder.encode_array(texts)
                lengths = lengths + 1
                ends = np.cumsum(lengths)
                ids = np.empty(int(ends[-1]), "<u2")
                last = np.zeros(len(ids), bool)
                last[ends - 1] = True
                ids[~last], ids[last] = found, end_id
                at = 0
                while at < len(lengths):  # up to the document that fills the file
                    done = ends[at - 1] if at else 0
                    to = int(np.searchsorted(ends, done + tokens - count)) + 1
                    to = min(to, len(lengths))
                    part_ids = ids[done : ends[to - 1]]
                    held.append((batch.column(0).slice(low + at, to - at), part_ids, lengths[at:to]))
                    count, at = count + len(part_ids), to
                    if count >= tokens:
                        yield flush()
        if held:
            yield flush()

    spark = docs.sparkSession
    text_batches(docs)
    files, home = filesystem(folder)
    files.create_dir(home, recursive=True)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))
    return (
        rows.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
        .withColumn("_tie", F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
        .select("doc_id", "text")
        .mapInArrow(
            write,
            "file string, part bigint, number bigint, first_id bigint, n_ids bigint, bytes bigint",
        )
    )


def read_shards(manifest, folder):
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    from pyspark.sql import Window

    def read(batches):
        files, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(row["file"]) as source:
                    reader = Reader(source.read())
                ids = reader.all().astype("<u4")
                ends = np.cumsum(reader.lengths)
                starts = ends - reader.lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.documents, pa.int64(), mask=reader.missing),
                        pa.array(starts + row["start"]),
                        pa.array(reader.lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # ids before each part, then within it: one row per part in the first window
    total = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = total.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.withColumn("_within", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
        .join(parts, "part")
        .select("file", (F.col("base") + F.col("_within")).alias("start"))
        .repartition(partitions(manifest.sparkSession))
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def store_documents(docs, path, folder=None, end_id=1, doc_id="doc_id", text="text"):
    """Writes all documents' ids as wavelet-matrix files under ``folder`` and reads them back.

    ``folder`` is by default a new one under the cluster's shared checkpoint folder."""
    folder = folder or work_dir(docs.sparkSession, "wavelet")
    manifest = checkpointed(write_shards(docs, folder, path, end_id, doc_id, text))
    return read_shards(manifest, folder)
