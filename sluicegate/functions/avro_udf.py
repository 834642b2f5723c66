"""The decoder as an Arrow UDF: rows grouped by schema, each group read at once."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions import avro_batch, avro_types
from sluicegate.functions.avro_batch import Batch, arrow_type, scatter
from sluicegate.functions.avro_types import parse_or_none, shape, slots_for

# Ship this code inside the pickled UDF, so executors need no installed copy.
for _module in (avro_types, avro_batch, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

PIECE_BYTES = 8 << 20  # payload read at a time: bounds the size of the position arrays
MAX_KEYS, MAX_TREES = 20_000, 4_000  # schemas a task remembers between batches


class Schemas:
    """Schema trees by key, read when first met and shared by schemas of the same shape."""

    def __init__(self, text_of):
        self.text_of = text_of
        self.by_key = {}
        self.by_shape = {}

    def tree(self, key):
        """The tree to read a body with, or ``None`` if there is no such record schema."""
        if key not in self.by_key:
            if len(self.by_key) >= MAX_KEYS or len(self.by_shape) >= MAX_TREES:
                self.by_key.clear()
                self.by_shape.clear()
            node = parse_or_none(self.text_of(key))
            usable = node is not None and node.kind in ("record", "union")
            self.by_key[key] = self.by_shape.setdefault(shape(node), node) if usable else None
        return self.by_key[key]


def decode_batch(payload, keys, schemas, slots):
    """Read ``payload[i]`` with the schema of ``keys[i]``.

    Returns ``(arrays, failed)``: one Arrow array per slot, null where a schema has no
    such slot, and a mask of the rows that could not be read.  Null payloads give nulls
    and do not count as failed."""
    results = [
        _decode_piece(payload.slice(at, n), keys.slice(at, n), schemas, slots)
        for at, n in _pieces(payload)
    ]
    if len(results) == 1:
        return results[0]
    arrays = [
        pa.concat_arrays([r[0][i] for r in results] or [pa.nulls(0, arrow_type(s.type))])
        for i, s in enumerate(slots)
    ]
    return arrays, np.concatenate([r[1] for r in results] or [np.zeros(0, bool)])


def _decode_piece(payload, keys, schemas, slots):
    failed = np.zeros(len(payload), bool)
    parts = {slot: [] for slot in slots}
    for node, rows in _by_tree(payload, keys, schemas):
        if node is None:
            failed[rows] = True
            continue
        whole = len(rows) == len(payload)
        batch = Batch(payload if whole else payload.take(pa.array(rows)))
        found, pos = batch.take(node, [(s.walk, s) for s in slots], *batch.spans)
        failed[rows[pos == batch.fail]] = True
        for slot, array in found.items():
            parts[slot].append((rows, array))
    return [scatter(parts[s], len(payload), arrow_type(s.type)) for s in slots], failed


def _by_tree(payload, keys, schemas):
    """Rows that have a payload, by schema tree: ``(tree, ascending row numbers)``."""
    present = np.flatnonzero(payload.is_valid().to_numpy(zero_copy_only=False))
    coded = keys.dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy(zero_copy_only=False)[present]
    groups, group_of = {}, np.zeros(len(coded.dictionary), np.int64)
    for code in np.unique(codes):
        tree = schemas.tree(coded.dictionary[int(code)].as_py())
        group_of[code] = groups.setdefault(tree, len(groups))
    order = np.argsort(group_of[codes], kind="stable")
    ends = np.cumsum(np.bincount(group_of[codes], minlength=len(groups)))
    for tree, rows in zip(groups, np.split(present[order], ends[:-1])):
        yield tree, rows


def _pieces(payload):
    """Row ranges of at most ``PIECE_BYTES`` of payload each, or of a single row."""
    size = pc.binary_length(payload).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < len(payload):
        before = total[start] - size[start]
        stop = max(start + 1, int(np.searchsorted(total, before + PIECE_BYTES, side="right")))
        yield start, stop - start
        start = stop


def make_decoder(slots, schemas=None, default=None):
    """Arrow UDF ``(payload, key) -> struct<failed, v0, v1, ...>``, one value per slot.

    ``schemas`` maps a key to schema text and ``default`` is the text for a null key; with
    ``schemas=None`` the keys are schema texts themselves.  The UDF counts as
    non-deterministic, so the optimizer neither repeats it nor moves filters below it."""
    returns = T.StructType(
        [T.StructField("failed", T.BooleanType())]
        + [T.StructField(f"v{i}", slot.type) for i, slot in enumerate(slots)]
    )

    def text_of(key):
        if key is None:
            return default
        return key if schemas is None else schemas[key]

    def decode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        trees = Schemas(text_of)  # kept for the task
        for payload, keys in batches:
            values, failed = decode_batch(payload, keys, trees, slots)
            yield pa.StructArray.from_arrays(
                [pa.array(failed), *values], names=[f.name for f in returns]
            )

    return F.arrow_udf(decode, returnType=returns).asNondeterministic()


def make_sorted_decoder(slots, default=None):
    """Arrow UDF ``(payload, schema_id, schema_json) -> struct<schema, known, failed, v0, ...>``.

    Rows come sorted by schema id, and before the messages of an id comes a row with its schema text,
    so the text travels once for all of them.  ``schema`` marks those rows; ``known`` is null for a null
    id, which ``default`` is for.  Rows after the last batch's end still know its last schema."""
    returns = T.StructType(
        [T.StructField(name, T.BooleanType()) for name in ("schema", "known", "failed")]
        + [T.StructField(f"v{i}", slot.type) for i, slot in enumerate(slots)]
    )

    def decode(batches):
        texts = {}  # of the batch's schemas and of the last one before it
        trees = Schemas(lambda key: default if key is None else texts[key])
        for payload, ids, found in batches:
            is_schema = found.is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(is_schema)
            new = ids.take(pa.array(at)).to_pylist()
            texts.update(zip(new, found.take(pa.array(at)).to_pylist()))
            framed = ids.is_valid().to_numpy(zero_copy_only=False)
            there = pc.is_in(ids, value_set=pa.array(list(texts), pa.int64())).to_numpy(zero_copy_only=False)
            read = pa.array(~is_schema & (~framed | there))
            body = pc.if_else(read, payload, pa.scalar(None, payload.type))
            values, failed = decode_batch(body, ids, trees, slots)
            known = pa.array(there, mask=~framed)
            yield pa.StructArray.from_arrays(
                [pa.array(is_schema), known, pa.array(failed), *values], names=[f.name for f in returns]
            )
            last = new[-1] if new else next(reversed(texts), None)
            texts = {last: texts[last]} if last is not None else {}

    def typed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return decode(batches)

    return F.arrow_udf(typed, returnType=returns).asNondeterministic()


def slot_describer(paths):
    """For ``mapInArrow`` over ``schema_json``: the distinct slots each path can end at."""

    def describe(batches):
        seen = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                root = parse_or_none(text)
                if root:
                    for i, (path, wanted) in enumerate(paths):
                        seen.update((i, s) for s in slots_for(root, path, wanted))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in seen], pa.int32()),
                pa.array([s.to_json() for _, s in seen], pa.string()),
            ],
            names=["path", "slot"],
        )

    return describe
