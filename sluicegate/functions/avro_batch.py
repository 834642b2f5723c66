"""Reading many Avro bodies at once.

A position per row moves through the bytes of an Arrow batch; every step (a varint, a
text, a union branch) is taken for all rows together with numpy, so the cost per row
is a few vector operations rather than a Python loop.  A row that cannot be read gets
the position ``fail``, which lies behind every row end and stays there: later steps
read nothing for it, and the other rows are not affected.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from sluicegate.functions.avro_types import Node, fixed_size, spark_type, type_or_none, union_shape

VARINTS = ("int", "long", "enum")
STRING = Node("string")
OWN = "own"  # the slot of a value wanted in its own type
PAD = 32  # zero bytes behind the buffer: more than any unchecked read can overrun
MAX_DEPTH = 2000  # nested records; deeper bodies fail instead of exhausting the stack
FRAMES = 6  # Python calls per nested record, at most
FEW_ROWS = 16  # below this a step for all rows costs more than a scan of each
MAX_EMPTY_ITEMS = 10_000_000  # per block that is wanted, for items that take no bytes and so have no other bound
MAX_LONG = 2**63 - 1


def arrow_type(node_or_type):
    if isinstance(node_or_type, Node):
        node_or_type = spark_type(node_or_type)
    return to_arrow_type(node_or_type)


def scatter(parts, n, target):
    """Put ``(rows, array)`` pieces at their rows of an array of length ``n``."""
    if not parts:
        return pa.nulls(n, target)
    if len(parts) == 1 and len(parts[0][0]) == n:
        return parts[0][1]
    at = np.full(n, -1, np.int64)
    start = 0
    for rows, array in parts:
        at[rows] = np.arange(start, start + len(rows))
        start += len(rows)
    joined = parts[0][1] if len(parts) == 1 else pa.concat_arrays([a for _, a in parts])
    return joined.take(pa.array(at, mask=at < 0))


def number_at(view, at, end):
    """One zig-zag integer: ``(value, position behind it)``, the position -1 if cut off."""
    raw = shift = 0
    while 0 <= at < end and shift < 70:
        byte = view[at]
        at += 1
        raw |= (byte & 0x7F) << shift
        if byte < 0x80:
            raw &= 0xFFFFFFFFFFFFFFFF
            return (raw >> 1) ^ -(raw & 1), at
        shift += 7
    return 0, -1


def value_end(node, view, at, end, depth):
    """The position behind one value, -1 if it cannot be read: what ``Batch.take`` finds for
    many rows together, for the elements of a few long arrays."""
    size = fixed_size(node)
    if at < 0 or (node.kind == "record" and size is None and depth >= MAX_DEPTH):
        return -1
    if size is not None:
        return at + size if size <= end - at else -1
    if node.kind == "record":
        for _, child in node.fields:
            at = value_end(child, view, at, end, depth + 1)
        return at
    number, at = number_at(view, at, end)
    if node.kind == "long" or at < 0:
        return at
    if node.kind == "int":
        return at if -(2**31) <= number < 2**31 else -1
    if node.kind == "enum":
        return at if 0 <= number < len(node.symbols) else -1
    if node.kind in ("string", "bytes"):
        return at + number if 0 <= number <= end - at else -1
    if node.kind == "union":
        known = 0 <= number < len(node.members)
        return value_end(node.members[number], view, at, end, depth) if known else -1
    while number and at >= 0:
        if number < 0:
            number = -number
            at = number_at(view, at, end)[1]
        empty = node.kind == "array" and fixed_size(node.item) == 0
        if number > (MAX_LONG if empty else end - at):
            return -1
        for _ in range(0 if empty else number):
            if node.kind == "map":
                at = value_end(STRING, view, at, end, depth)
            at = value_end(node.item, view, at, end, depth)
        number, at = number_at(view, at, end)
    return at


class Batch:
    """The bytes of some messages and vectorised reads on them.

    Every read takes ``pos`` and ``end`` (one entry per row it is for) and returns the
    new positions last."""

    def __init__(self, payload):
        _, offsets, data = payload.buffers()
        wide = pa.types.is_large_binary(payload.type)
        bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
        bounds = bounds[payload.offset : payload.offset + len(payload) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        raw = raw[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        self.bytes = np.concatenate([raw, np.zeros(PAD, np.uint8)])
        self.fail = len(raw) + 1
        self.spans = (bounds[:-1], bounds[1:])
        self.depth = 0
        self._stops = None
        deep = MAX_DEPTH * FRAMES + 1000
        sys.setrecursionlimit(max(sys.getrecursionlimit(), deep))

    def check(self, pos, end):
        return np.where(pos > end, self.fail, pos)

    # -- building blocks -------------------------------------------------------------

    def varint(self, pos, end):
        """Zig-zag variable-length integers."""
        byte = self.bytes[pos]
        raw = (byte & 0x7F).astype(np.uint64)
        after = pos + 1
        more = np.flatnonzero(byte & 0x80)
        shift = 7
        while more.size and shift < 70:
            byte = self.bytes[after[more]]
            raw[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            after[more] += 1
            more = more[(byte & 0x80) != 0]
            shift += 7
        after[more] = self.fail
        signed = (raw >> np.uint64(1)).astype(np.int64) ^ -(raw & np.uint64(1)).astype(np.int64)
        return signed, self.check(after, end)

    def jump(self, size, pos, end):
        """Move on by ``size`` bytes, which is untrusted."""
        ok = (size >= 0) & (size <= end - pos)
        return np.where(ok, size, 0), np.where(ok, pos + np.where(ok, size, 0), self.fail)

    def spans_of(self, start, size, target):
        """The given spans (ascending) as an array.

        Starts and ends interleaved are the offsets of an array in which every second
        entry is a span, so taking those copies the wanted bytes and nothing else."""
        start = np.maximum.accumulate(np.where(start >= self.fail, 0, start))
        offsets = np.stack([start, start + size], axis=1).reshape(-1).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.bytes)]
        n = max(2 * len(start) - 1, 0)
        return pa.Array.from_buffers(target, n, buffers).take(pa.array(np.arange(0, n, 2)))

    def elements(self, node, want, pos, end):
        """Array or map blocks: yields ``(rows, start, next)`` until every block is done.

        ``start`` are element positions, ``rows`` the row of each.  The caller puts the
        position behind every element into ``next``.  Elements whose ends are known without
        reading them come a whole block at a time; others come one per row and step, or,
        once few rows have any left, all at once after a scan for their ends."""
        size = fixed_size(node.item) if node.kind == "array" else None
        varints = node.kind == "array" and node.item.kind in VARINTS
        left = np.zeros(len(pos), np.int64)
        live = np.arange(len(pos))
        while True:
            need = live[left[live] == 0]
            if need.size:
                count, after = self.varint(pos[need], end[need])
                sized = np.flatnonzero(count < 0)
                if sized.size:  # a negative count is followed by the block's byte size
                    _, after[sized] = self.varint(after[sized], end[need][sized])
                count = np.abs(count)
                most = end[need] - after
                if size == 0:  # only counted, unless wanted
                    most = MAX_EMPTY_ITEMS if want else MAX_LONG
                bad = (count < 0) | (count > most)
                count[bad] = 0
                pos[need] = np.where(bad, self.fail, after)
                left[need] = count
                live = live[left[live] > 0]
            if not live.size:
                return
            if size is not None or varints:
                count, before = left[live], pos[live]
                pos[live] = self.behind(size, count, before, end[live])
                left[live] = 0
                if want or varints:
                    count = np.where(pos[live] == self.fail, 0, count)
                    start = self.starts(size, count, before)
                    yield np.repeat(live, count), start, np.empty(len(start), np.int64)
            elif live.size < FEW_ROWS:
                starts = [self.scan(node, r, left, pos, end) for r in live]
                left[live] = 0
                if want:
                    start = np.concatenate(starts)
                    rows = np.repeat(live, [len(s) for s in starts])
                    yield rows, start, np.empty(len(start), np.int64)
            else:
                after = pos[live]
                yield live, pos[live], after
                pos[live] = after
                left[live] -= 1
            left[live[pos[live] == self.fail]] = 0

    def scan(self, node, row, left, pos, end):
        """Starts of the ``left[row]`` next elements; moves ``pos[row]`` behind them."""
        view, at, stop = memoryview(self.bytes), int(pos[row]), int(end[row])
        starts = np.empty(int(left[row]), np.int64)
        for i in range(len(starts)):
            starts[i] = at
            if node.kind == "map":
                at = value_end(STRING, view, at, stop, self.depth)
            at = value_end(node.item, view, at, stop, self.depth)
            if at < 0:
                pos[row] = self.fail
                return starts[:0]
        pos[row] = at
        return starts

    @property
    def stops(self):
        """Where a varint can end: every byte without the continuation bit."""
        if self._stops is None:
            self._stops = np.flatnonzero(self.bytes < 0x80)
        return self._stops

    def behind(self, size, count, pos, end):
        """The position behind ``count`` elements of a fixed size, or one varint each."""
        if size is None:
            last = np.searchsorted(self.stops, pos) + count - 1
            return self.check(self.stops[np.minimum(last, len(self.stops) - 1)] + 1, end)
        if size == 0:
            return pos
        fits = count <= (end - pos) // size
        return np.where(fits, pos + np.where(fits, count, 0) * size, self.fail)

    def starts(self, size, count, pos):
        """The position of each of ``count`` such elements."""
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        if size is not None:
            return np.repeat(pos, count) + within * size
        first = np.repeat(np.searchsorted(self.stops, pos), count)
        return np.where(within == 0, np.repeat(pos, count), self.stops[first + within - 1] + 1)

    # -- values ----------------------------------------------------------------------

    def take(self, node, wanted, pos, end):
        """Move past one value per row and give the wanted parts: ``{slot: array}``.

        ``wanted`` lists ``(walk, slot)``: the record fields still to enter, and the slot
        to fill there if the type found is the slot's.  The slot ``OWN`` takes any type."""
        size = fixed_size(node)
        if not wanted and size is not None:
            return {}, self.jump(size, pos, end)[1]
        own = type_or_none(node)
        here = [slot for walk, slot in wanted if not walk and (slot is OWN or slot.type == own)]
        if node.kind in ("record", "union"):
            inner = [w for w in wanted if w[0] or (node.kind == "union" and w[1] not in here)]
            walk = self.walk_record if node.kind == "record" else self.walk_union
            value, found, pos = walk(node, inner, bool(here), pos, end)
            return found | dict.fromkeys(here, value), pos
        value, pos = getattr(self, "read_" + node.kind)(node, bool(here), pos, end)
        return dict.fromkeys(here, value), pos

    def own(self, node, want, pos, end):
        """A value in its own type, or ``None`` unless wanted."""
        found, pos = self.take(node, [((), OWN)] if want else [], pos, end)
        return found.get(OWN), pos

    def walk_record(self, node, wanted, want, pos, end):
        if self.depth >= MAX_DEPTH:
            value = pa.nulls(len(pos), arrow_type(node)) if want else None
            return value, {}, np.full(len(pos), self.fail)
        self.depth += 1
        arrays, columns = {}, []
        for name, child in node.fields:
            inner = [(walk[1:], slot) for walk, slot in wanted if walk[0] == name]
            found, pos = self.take(child, inner + [((), OWN)] * want, pos, end)
            columns.append(found.pop(OWN, None))
            arrays.update(found)
        self.depth -= 1
        if not want:
            return None, arrays, pos
        if not columns:
            return pa.array([{}] * len(pos), pa.struct([])), arrays, pos
        fields = list(arrow_type(node))
        return pa.StructArray.from_arrays(columns, fields=fields), arrays, pos

    def walk_union(self, node, wanted, want, pos, end):
        index, pos = self.varint(pos, end)
        index[pos == self.fail] = -1
        out = np.full(len(pos), self.fail)  # where the branch number is none of the union's
        parts = {}  # by slot, and by member for the union's own value
        for i, member in enumerate(node.members):
            rows = np.flatnonzero(index == i)
            if not rows.size:
                continue
            whole = [((), OWN)] * (want and member.kind != "null")
            if rows.size == len(pos):
                found, out = self.take(member, wanted + whole, pos, end)
            else:
                found, out[rows] = self.take(member, wanted + whole, pos[rows], end[rows])
            for slot, array in found.items():
                parts.setdefault(member if slot is OWN else slot, []).append((rows, array))
        value = self.union_value(node, parts, len(pos)) if want else None
        arrays = {
            slot: scatter(pieces, len(pos), pieces[0][1].type)
            for slot, pieces in parts.items()
            if slot not in node.members
        }
        return value, arrays, out

    @staticmethod
    def union_value(node, parts, n):
        kind, members = union_shape(node)
        target = arrow_type(node)
        if kind != "struct":
            pieces = [(rows, a.cast(target)) for m in members for rows, a in parts.get(m, [])]
            return scatter(pieces, n, target)
        columns = [scatter(parts.get(m, []), n, f.type) for m, f in zip(members, target)]
        empty = np.ones(n, bool)
        for member in members:
            for rows, _ in parts.get(member, []):
                empty[rows] = False
        return pa.StructArray.from_arrays(columns, fields=list(target), mask=pa.array(empty))

    def read_null(self, node, want, pos, end):
        return pa.nulls(len(pos)), pos

    def read_boolean(self, node, want, pos, end):
        return pa.array(self.bytes[pos] != 0), self.jump(1, pos, end)[1]

    def read_float(self, node, want, pos, end):
        width = fixed_size(node)
        data = np.empty((len(pos), width), np.uint8)
        for i in range(width):
            data[:, i] = self.bytes[pos + i]
        return pa.array(data.reshape(-1).view(f"<f{width}")), self.jump(width, pos, end)[1]

    read_double = read_float

    def read_int(self, node, want, pos, end):
        value, pos = self.varint(pos, end)
        pos = np.where((value < -(2**31)) | (value >= 2**31), self.fail, pos)
        if not want:
            return None, pos
        array = pa.array(np.where(pos == self.fail, 0, value).astype(np.int32))
        return (array.cast(pa.date32()) if node.logical else array), pos

    def read_long(self, node, want, pos, end):
        value, pos = self.varint(pos, end)
        if not want:
            return None, pos
        if node.logical.endswith("millis"):
            bad = np.abs(value // 1000) > 9_223_372_036_854
            pos = np.where(bad, self.fail, pos)
            value = np.where(bad, 0, value) * 1000
        array = pa.array(value)
        return (array.cast(arrow_type(node)) if node.logical else array), pos

    def read_enum(self, node, want, pos, end):
        value, pos = self.varint(pos, end)
        pos = np.where((value < 0) | (value >= len(node.symbols)), self.fail, pos)
        if not want:
            return None, pos
        value = np.where(pos == self.fail, 0, value)
        return pa.array(node.symbols, pa.string()).take(pa.array(value)), pos

    def read_bytes(self, node, want, pos, end):
        size, start = self.varint(pos, end)
        size, pos = self.jump(size, start, end)
        return self.binary_or_decimal(node, want, start, size, pos)

    def read_fixed(self, node, want, pos, end):
        size, after = self.jump(np.full(len(pos), node.size), pos, end)
        return self.binary_or_decimal(node, want, pos, size, after)

    def binary_or_decimal(self, node, want, start, size, pos):
        if want and node.is_decimal:
            return self.decimals(node, start, size, pos)
        return self.spans_of(start, size, pa.binary()) if want else None, pos

    def decimals(self, node, start, size, pos):
        """Big-endian numbers of any width, as the 16 little-endian bytes Arrow keeps."""
        negative = (size > 0) & (self.bytes[start] >= 0x80)
        number = np.where(negative, 0xFF, 0).astype(np.uint8).repeat(16).reshape(-1, 16)
        for i in range(16):
            rows = np.flatnonzero(size > i)
            number[rows, i] = self.bytes[start[rows] + size[rows] - 1 - i]
        low, high = number.view("<u8")[:, 0], number.view("<i8")[:, 1]
        fits = (high < 0) == negative
        for row in np.flatnonzero(size > 16):
            extra = self.bytes[start[row] : start[row] + size[row] - 16]
            fits[row] &= (extra == (0xFF if negative[row] else 0)).all()
        limit = 10**node.precision
        for bound, order in ((limit, np.less), (-limit, np.greater)):
            top, rest = bound >> 64, np.uint64(bound & 0xFFFFFFFFFFFFFFFF)
            fits &= order(high, top) | ((high == top) & order(low, rest))
        number[~fits] = 0
        buffers = [None, pa.py_buffer(np.ascontiguousarray(number))]
        value = pa.Array.from_buffers(arrow_type(node), len(size), buffers)
        return value, np.where(fits, pos, self.fail)

    def read_string(self, node, want, pos, end):
        size, start = self.varint(pos, end)
        size, pos = self.jump(size, start, end)
        if not want:
            return None, pos
        array = self.spans_of(start, size, pa.string())
        try:
            array.validate(full=True)
        except pa.ArrowInvalid:
            for i, raw in enumerate(array.view(pa.binary()).to_pylist()):
                try:
                    raw.decode("utf-8")
                except UnicodeDecodeError:
                    size[i], pos[i] = 0, self.fail
            array = self.spans_of(start, size, pa.string())
        return array, pos

    def read_array(self, node, want, pos, end):
        pos = pos.copy()
        owners, values = [], []
        for rows, start, after in self.elements(node, want, pos, end):
            value, after[:] = self.own(node.item, want, start, end[rows])
            owners.append(rows)
            values.append(value)
            pos[rows[after == self.fail]] = self.fail
        if not want:
            return None, pos
        offsets, order = self.regroup(owners, len(pos))
        value = self.joined(values, node.item).take(order)
        return pa.ListArray.from_arrays(offsets, value, type=arrow_type(node)), pos

    def read_map(self, node, want, pos, end):
        pos = pos.copy()
        owners, keys, values = [], [], []
        for rows, start, after in self.elements(node, want, pos, end):
            key, start = self.own(STRING, want, start, end[rows])
            value, after[:] = self.own(node.item, want, start, end[rows])
            owners.append(rows)
            keys.append(key)
            values.append(value)
            pos[rows[after == self.fail]] = self.fail
        if not want:
            return None, pos
        offsets, order = self.regroup(owners, len(pos))
        key = self.joined(keys, STRING).take(order)
        value = self.joined(values, node.item).take(order)
        return pa.MapArray.from_arrays(offsets, key, value, type=arrow_type(node)), pos

    @staticmethod
    def joined(arrays, node):
        return pa.concat_arrays(arrays) if arrays else pa.nulls(0, arrow_type(node))

    @staticmethod
    def regroup(owners, n):
        """Element order by row, and list offsets, from the row of each element read."""
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        offsets = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
        return pa.array(offsets.astype(np.int32)), pa.array(np.argsort(owner, kind="stable"))
