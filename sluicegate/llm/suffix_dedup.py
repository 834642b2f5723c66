"""Removal of byte strings that occur more than once in a corpus, by suffix sorting.

Every byte covered by a string of ``length`` bytes (a window) that also starts anywhere else goes.

1. Anchors.  In each window the span of some bytes (``anchor_size``) with the least hash is its anchor, so equal
   windows have equal anchors at equal places.  Neighbouring windows with one anchor are a segment; there is
   about one for each ``length / 2`` bytes.  Rows of a segment's key (the hash at its anchor) and
   digest (of all its bytes) are counted by Spark; segments that occur twice are repeats as a whole.
2. Suffix sort.  Different segments of one key meet in a task, each once.  Those of a key are sorted by
   the bytes from the anchor on and by the bytes before it (see suffix_sort).  Segments are joined in
   descending order of how far they agree forwards; whenever two sets join, each member of the
   smaller meets its neighbours in the backward order of the larger.  These few pairs hold the
   longest match of any two segments, forwards and backwards, and a pair that agrees over
   ``length`` bytes is a repeat.
3. Keys with more than ``most`` different segments do not meet in a task: their windows are counted one
   by one by Spark, by digests.

Repeats of whole words, whatever their length in bytes, are found by the same steps on texts in which each word
is a code of 8 bytes (``word_codes``): so many words are then as many bytes.

A null text is empty.  Texts shorter than ``length`` keep all their bytes.  Repeated rows are copies of
each other.  Long texts are read in blocks that overlap by a window, so memory is bounded.  An empty table
gives no rows; other columns are not looked at."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import checkpointed, row_key, text_batches, tidy, whole_groups
from sluicegate.llm.suffix_sort import BASE, BASE_INVERSE, Hashed, merge_sorted

GRAM = 32  # at most; see anchor_size
BLOCK = 1 << 18  # windows looked at together
MOST = 4096
BROADCAST_ROWS = 1_000_000  # 8 bytes each
CODE = 8  # bytes of a word's code
SPACES = np.isin(np.arange(256), [32, *range(9, 14)])  # what ends a word


def anchor_size(length):
    """Bytes of an anchor: a quarter of a window, so that windows have spans enough to share one."""
    return min(GRAM, max(16, length // 4))


def powers(n):
    """The base's powers and their inverses, as Hashed has them."""
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE), np.full(n, BASE_INVERSE)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def segments(raw, length, table):
    """Arrays first, last (windows), anchor, key of one block of bytes."""
    up, down = table
    n, gram = len(raw), anchor_size(length)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=prefix[1:])
    h = (prefix[gram:] - prefix[: n - gram + 1]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    # hash above, place below: the least is the leftmost of the least hashes
    packed = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    grams, reach = length - gram + 1, 1
    while reach * 2 <= grams:
        packed = np.minimum(packed[:-reach], packed[reach:])
        reach *= 2
    windows = n - length + 1
    rest = grams - reach
    least = np.minimum(packed[:windows], packed[rest : rest + windows])
    anchors = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [windows - 1]])
    at = anchors[first]
    return first, last, at, h[at].view(np.int64)


def pieces(texts, length, block=BLOCK):
    """Yields (raw bytes, [(row, start in text, start in bytes, bytes)]) of about a block each.

    Texts under ``length`` are left out; longer ones than a block come in overlapping parts."""
    held, where, size = [], [], 0
    for row, data in enumerate(texts):
        if data is None or len(data) < length:
            continue
        for start in range(0, len(data) - length + 1, block):
            part = data[start : start + block + length - 1]
            where.append((row, start, size, len(part)))
            held.append(part)
            size += len(part)
            if size >= block:
                yield b"".join(held), where
                held, where, size = [], [], 0
    if held:
        yield b"".join(held), where


def word_places(data):
    """Starts and ends of the words of a text's bytes."""
    space = np.ones(len(data) + 2, bool)
    np.take(SPACES, np.frombuffer(data, np.uint8), out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])  # a start, its end, and so on
    return edges[::2], edges[1::2]


def word_codes(texts, table, block=BLOCK):
    """Each text as the codes of its words, side by side: 64 bits of a hash of the word's bytes."""
    up, down = table
    data = b" ".join(texts)  # words never cross its spaces
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_places(data)
    codes, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        first = starts[at]
        stop = int(np.searchsorted(ends, first + block, side="right"))
        if stop <= at:  # a word of over a block
            word = hashlib.blake2b(data[first : ends[at]], digest_size=CODE)
            codes[at], at = int.from_bytes(word.digest(), "little"), at + 1
            continue
        part = raw[first : ends[stop - 1]]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=prefix[1:])
        a, b = starts[at:stop] - first, ends[at:stop] - first
        codes[at:stop] = (prefix[b] - prefix[a]) * down[a]
        at = stop
    codes ^= codes >> np.uint64(32)
    codes *= np.uint64(0xD6E8FEB86659FD93)
    codes ^= codes >> np.uint64(29)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    cuts = [0, *np.searchsorted(starts, np.cumsum(sizes)).tolist()]
    return [codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def batch_texts(column, words, table):
    """Bytes of a batch's texts, or of their words' codes; null stays null."""
    texts = (v.as_buffer() if v.is_valid else None for v in column.cast(pa.binary()))
    texts = [None if t is None else memoryview(t) for t in texts]
    return word_codes([b"" if t is None else t for t in texts], table) if words else texts


# A segment's place: start of its first window, windows less one, anchor's distance from the start.
def packed_place(start, count, ahead):
    return start << 24 | count << 12 | ahead


def unpacked_place(place):
    return place >> 24, place >> 12 & 0xFFF, place & 0xFFF


def segment_rows(docs, length, words=False, only_keys=False):
    """row, place, key, digest of every segment, or its key only; ``words``: of the texts' codes."""

    def find(batches):
        table = powers(3 * BLOCK + 2 * length)
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for data, where in pieces(batch_texts(batch.column(1), words, table), length):
                raw = np.frombuffer(data, np.uint8)
                view = memoryview(data)
                first, last, at, key = segments(raw, length, table)
                starts = np.array([w[2] for w in where])
                ends = np.array([w[2] + w[3] - length for w in where])  # last windows
                # cut at the borders of texts; windows across them are nobody's
                cuts = np.unique(np.concatenate([first, starts, ends + 1]))
                cuts = cuts[cuts < len(raw) - length + 1]
                k = np.searchsorted(first, cuts, side="right") - 1
                stop = np.concatenate([cuts[1:] - 1, [len(raw) - length]])
                text = np.searchsorted(starts, cuts, side="right") - 1
                good = cuts <= ends[text]
                cuts, stop, k, text = cuts[good], stop[good], k[good], text[good]
                if only_keys:
                    yield pa.RecordBatch.from_arrays([pa.array(key[k])], ["key"])
                    continue
                digests = [
                    hashlib.blake2b(view[a : b + length], digest_size=8).digest()
                    for a, b in zip(cuts.tolist(), stop.tolist())
                ]
                own, origin = np.array([(w[0], w[1]) for w in where]).T
                place = packed_place(cuts - starts[text] + origin[text], stop - cuts, at[k] - cuts)
                columns = (rows[own[text]], place, key[k], np.frombuffer(b"".join(digests), "<i8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], ["row", "place", "key", "digest"]
                )

    kinds = "key bigint" if only_keys else "row bigint, place bigint, key bigint, digest bigint"
    return docs.select("_row", "_text").mapInArrow(tidy(find), kinds)


def with_texts(docs, wanted):
    """_row, _text, _s of the documents with wanted segments.

    The segments are the side that is hashed: a few small rows for each text."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("place", "key", "sole")).alias("_s"))
    joined = docs.join(lists.hint("shuffle_hash"), docs["_row"] == lists["row"])
    return selected(joined)


def with_few_texts(docs, wanted):
    """The same where segments of few documents are wanted: only their texts are shuffled."""
    rows = wanted.select(F.col("row").alias("_few")).distinct()
    if rows.count() <= BROADCAST_ROWS:
        docs = docs.join(F.broadcast(rows), docs["_row"] == rows["_few"], "left_semi")
    return with_texts(docs, wanted)


def selected(joined):
    return joined.select("_row", "_text", "_s", "_id")  # _id: the exchange is shared, see below


def bodies(docs, wanted, length, words=False):
    """key, row, place, sole, body: the bytes of wanted segments."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    names = ["key", "row", "place", "sole", "body"]

    def cut(batches):
        table = powers(BLOCK) if words else None
        for batch in batches:
            found, size = [[], [], [], [], []], 0
            texts = batch_texts(batch.column(1), words, table)
            for i, (row, segments_) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            ):
                data = texts[i]
                for s in segments_:
                    start, count, _ = unpacked_place(s["place"])
                    body = bytes(data[start : start + count + length])
                    size += len(body)
                    for column, value in zip(found, (s["key"], row, s["place"], s["sole"], body)):
                        column.append(value)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(*x) for x in zip(found, kinds)], names)
                    found, size = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(*x) for x in zip(found, kinds)], names)

    return with_texts(docs, wanted).mapInArrow(
        tidy(cut), "key bigint, row bigint, place bigint, sole boolean, body binary"
    )


def single_windows(docs, wanted, length, words=False):
    """row, start, sole, window: a digest of each window of wanted segments, of ``words`` of each that starts with one."""
    step = CODE if words else 1

    def cut(batches):
        table = powers(BLOCK) if words else None
        for batch in batches:
            texts = batch_texts(batch.column(1), words, table)
            for i, (row, segments_) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            ):
                data = texts[i]
                for s in segments_:
                    start, count, _ = unpacked_place(s["place"])
                    at = range(start + -start % step, start + count + 1, step)
                    made = [hashlib.blake2b(data[w : w + length], digest_size=16).digest() for w in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(at), pa.int64()), pa.array(at, pa.int64()),
                         pa.array([s["sole"]] * len(at), pa.bool_()), pa.array(made, pa.binary())],
                        ["row", "start", "sole", "window"],
                    )

    return with_few_texts(docs, wanted).mapInArrow(
        tidy(cut), "row bigint, start bigint, sole boolean, window binary"
    )


def meeting_pairs(order, agree, backward, least):
    """Pairs of members that meet when sets join in descending order of agreement.

    ``order``: members in forward order; ``agree[i]``: bytes in which order[i] and order[i+1] agree;
    ``backward``: each member's rank in the backward order; ``least``: bytes of an anchor."""
    import bisect

    n = len(order)
    if n == 2:
        return [(order[0], order[1])]
    home = list(range(n))  # of a place in the order
    sets = [[backward[m]] for m in order]
    member = {backward[m]: m for m in order}

    def top(i):
        while home[i] != i:
            home[i] = home[home[i]]
            i = home[i]
        return i

    pairs = []
    for i in sorted(range(n - 1), key=lambda i: -agree[i]):
        if agree[i] < least:  # their anchors differ: a collision of keys
            break
        a, b = top(i), top(i + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large = sets[a]
        for rank in sets[b]:
            k = bisect.bisect_left(large, rank)
            if k:
                pairs.append((member[large[k - 1]], member[rank]))
            if k < len(large):
                pairs.append((member[large[k]], member[rank]))
            large.insert(k, rank)
        home[b], sets[b] = a, None
    return pairs


def ordered_badly(data, place, room, order, first, size, back=False):
    """Groups whose order by hash is not the order of the bytes."""
    wrong = set()
    for g in range(len(size)):
        before = None
        for i in order[first[g] : first[g] + size[g]]:
            a, n = int(place[i]), int(room[i])
            now = data[a - n : a][::-1] if back else data[a : a + n]
            if before is not None and now < before:
                wrong.add(g)
                break
            before = now
    return wrong


def repeats(keys, places, bodies_, length):
    """(member, start, end) of repeated byte ranges within bodies, for sorted groups of equal keys."""
    n = len(keys)
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate([first, [n]]))
    data = b"".join(bodies_)
    sizes = np.array([len(b) for b in bodies_])
    start = np.cumsum(sizes) - sizes
    ahead = places & 0xFFF
    anchor = start + ahead
    text = Hashed(np.frombuffer(data, np.uint8))
    room, behind = sizes - ahead, ahead
    with np.errstate(over="ignore"):
        forward = merge_sorted(text, anchor, room, first, size)
        backward = merge_sorted(text, anchor, behind, first, size, back=True)
        a, b = forward[:-1], forward[1:]
        agree = text.agreement(anchor[a], anchor[b], np.minimum(room[a], room[b]))
    wrong = ordered_badly(data, anchor, room, forward, first, size)
    wrong |= ordered_badly(data, anchor, behind, backward, first, size, back=True)
    for g in wrong:
        own = range(first[g], first[g] + size[g])
        cut = slice(first[g], first[g] + size[g])
        forward[cut] = sorted(own, key=lambda i: data[anchor[i] : anchor[i] + room[i]])
        backward[cut] = sorted(own, key=lambda i: data[anchor[i] - behind[i] : anchor[i]][::-1])
        for k in range(first[g], first[g] + size[g] - 1):
            agree[k] = exact_agreement(data, anchor[forward[k]], anchor[forward[k + 1]], room[forward[k]], room[forward[k + 1]])
    rank = np.empty(n, np.int64)
    rank[backward] = np.arange(n)
    rank, order, agree = rank.tolist(), forward.tolist(), agree.tolist()
    pairs = []
    for f, s in zip(first.tolist(), size.tolist()):
        if s > 1:
            pairs += meeting_pairs(order[f : f + s], agree[f : f + s - 1], rank, anchor_size(length))
    if not pairs:
        return np.zeros((0, 3), np.int64)
    pair = np.array(pairs)
    a, b = pair[:, 0], pair[:, 1]
    with np.errstate(over="ignore"):
        right = text.agreement(anchor[a], anchor[b], np.minimum(room[a], room[b]))
        left = text.agreement(anchor[a], anchor[b], np.minimum(behind[a], behind[b]), back=True)
    long = np.flatnonzero(left + right >= length)
    out = []
    for k in long.tolist():
        x, y, f, e = int(anchor[a[k]]), int(anchor[b[k]]), int(left[k]), int(right[k])
        if data[x - f : x + e] != data[y - f : y + e]:  # a collision of span hashes
            e = exact_agreement(data, x, y, room[a[k]], room[b[k]])
            f = exact_agreement(data[::-1], len(data) - x, len(data) - y, behind[a[k]], behind[b[k]])
            if e + f < length:
                continue
        for m, p in ((int(a[k]), x), (int(b[k]), y)):
            out.append((m, p - f - int(start[m]), p + e - int(start[m])))
    return np.array(out, np.int64).reshape(-1, 3)


def exact_agreement(data, x, y, room_x, room_y):
    most, n = int(min(room_x, room_y)), 0
    while n < most and data[x + n] == data[y + n]:
        n += 1
    return n


def sorted_repeats(rows, length):
    """row, start, end of repeats among the bodies of each key."""

    def find(batches):
        for table in whole_groups(batches, ["key"], 5_000):
            keys = table.column("key").to_numpy()
            places = table.column("place").to_numpy()
            own = table.column("row").to_numpy()
            found = repeats(keys, places, table.column("body").to_pylist(), length)
            sole = table.column("sole").to_numpy(zero_copy_only=False)
            found = found[sole[found[:, 0]]]  # segments that occur twice are repeats already
            origin = (places >> 24)[found[:, 0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[found[:, 0]]), pa.array(origin + found[:, 1]), pa.array(origin + found[:, 2])],
                ["row", "start", "end"],
            )

    return (
        rows.select("key", "row", "place", "sole", "body")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(tidy(find), "row bigint, start bigint, end bigint")
    )


def united(spans):
    """Sorted spans that do not touch, from any (start, end)."""
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return out


def with_rows(docs, doc_id, text):
    return docs.select(
        F.col(doc_id).alias("_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        row_key(doc_id, text).alias("_row"),
    )


def row_spans(keyed, length, most, words=False):
    """row, _spans: array of (start, end) of repeats in the bytes of texts, or (``words``) of their codes."""
    if length <= GRAM or length >= 1 << 11:
        raise ValueError(f"length must be over {GRAM} and under {1 << 11}")
    segments_ = segment_rows(keyed, length, words)
    # stored, so that both sides of the join are plain exchanges and a hot key can be split
    every = segment_rows(keyed, length, words, only_keys=True)
    common = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    common = checkpointed(common)
    found = checkpointed(segments_.join(common, "key", "left_semi"))
    kinds = checkpointed(  # stored for the same reason
        found.groupBy("key", "digest").agg(
            F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")
        )
    )
    shared = kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    meeting = checkpointed(
        kinds.join(shared, "key").select(
            "key",
            "one.row",
            "one.place",
            (F.col("n") == 1).alias("sole"),
            (F.col("kinds") > most).alias("hot"),
        )
    )
    copies = kinds.where("n > 1").select("key", "digest")
    start = F.shiftright("place", 24)
    count = F.shiftright("place", 12).bitwiseAND(F.lit(0xFFF))
    whole = found.join(copies, ["key", "digest"]).select(
        "row", start.alias("start"), (start + count + length).alias("end")
    )
    spans = whole.unionByName(
        sorted_repeats(bodies(keyed, meeting.where("not hot"), length, words), length)
    )
    if not meeting.where("hot").isEmpty():
        windows = checkpointed(single_windows(keyed, meeting.where("hot"), length, words))
        often = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
        spans = spans.unionByName(
            windows.where("sole")
            .join(often, "window")
            .select("row", "start", (F.col("start") + length).alias("end"))
        )
    return spans.distinct().groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))


def repeated_spans(docs, length=400, doc_id="doc_id", text="text", most=MOST, *, words=None):
    """_id, _text, _row of every document, and _spans: array of (start, end) in bytes, or null.

    ``words`` adds _runs: the same of repeats of so many words, in bytes of the text's codes."""
    text_batches(docs)
    # all three columns go into the joins with the texts, so one exchange serves them
    found = keyed = with_rows(docs, doc_id, text)
    kinds = [("_spans", length, False), *([("_runs", CODE * words, True)] if words else [])]
    for name, size, coded in kinds:
        spans = row_spans(keyed, size, most, coded).select(F.col("row").alias("_at"), F.col("_spans").alias(name))
        found = found.join(spans.hint("shuffle_hash"), F.col("_row") == F.col("_at"), "left").drop("_at")
    return found


def whole_characters(data, spans):
    """The bytes outside of sorted spans, and all bytes of characters of which one is outside."""
    kept, at = [], 0
    for a, b in spans:
        while a < len(data) and data[a] & 0xC0 == 0x80:
            a += 1  # the character began before the span
        while b < len(data) and b > a and data[b] & 0xC0 == 0x80:
            b -= 1  # the character goes on after the span
        kept.append(data[at:a])
        at = max(at, a, b)
    return b"".join([*kept, data[at:]])


def passages(data, runs, words):
    """Byte spans and the number of words of repeated passages, from runs in the codes of a text."""
    starts, ends = word_places(data)
    whole = ((-(-a // CODE), b // CODE) for a, b in united(runs))
    whole = [(a, b) for a, b in whole if b - a >= words]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in whole], sum(b - a for a, b in whole)


def outside(data, spans):
    """The bytes outside of sorted spans."""
    edges = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removed_repeats(docs, length=400, doc_id="doc_id", text="text", kept=None, words=None):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    ``kept`` names one more column: the text without its repeats, as ``without_repeats`` has it.
    ``words`` adds n_passage_words and text_without_passages: the text without each word covered by
    so many words that also start anywhere else, in bytes however few; white space is not compared.
    Bytes there that are not UTF-8 are replaced."""
    kind = docs.schema[doc_id].dataType.simpleString()
    more = [(kept, "string")] * bool(kept)
    more += [("n_passage_words", "bigint"), ("text_without_passages", "string")] * bool(words)
    columns = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), *more]
    names = ["doc_id", *(name for name, _ in columns)]
    kinds = [pa.string() if t == "string" else pa.int64() for _, t in columns]

    def judge(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            all_runs = batch.column(4).to_pylist() if words else [None] * batch.num_rows
            out = [[] for _ in kinds]
            for i, (spans, runs) in enumerate(zip(batch.column(2).to_pylist(), all_runs)):
                data = memoryview(texts[i].as_buffer())
                spans = united((s["start"], s["end"]) for s in spans or ())
                digest, at = hashlib.sha256(), 0
                for a, b in [*spans, (len(data), len(data))]:
                    digest.update(data[at:a])
                    at = b
                values = [len(data), sum(b - a for a, b in spans), len(spans), digest.hexdigest()]
                if kept:
                    values.append(whole_characters(data, spans).decode("utf-8", "replace"))
                if words:
                    runs = [(r["start"], r["end"]) for r in runs or ()]
                    cut, count = passages(data, runs, words) if runs else ([], 0)
                    values += [count, outside(data, cut).decode("utf-8", "replace")]
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, t) for x, t in zip(out, kinds)]], names
            )

    found = repeated_spans(docs, length, doc_id, text, words=words)
    return found.select("_id", "_text", "_spans", "_row", *["_runs"] * bool(words)).mapInArrow(
        tidy(judge), f"doc_id {kind}, " + ", ".join(f"`{name}` {t}" for name, t in columns)
    )


def without_repeats(docs, length=400, doc_id="doc_id", text="text"):
    """``_row, kept`` of the documents that lose bytes: texts without their repeats.

    A character goes only if all its bytes are repeated, so the text stays valid UTF-8."""

    def keep(batches):
        for batch in batches:
            out = []
            for value, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                kept = whole_characters(value.as_py(), united((s["start"], s["end"]) for s in spans))
                out.append(kept.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["_row", "kept"])

    found = repeated_spans(docs, length, doc_id, text).where("_spans is not null")
    return found.select("_row", "_text", "_spans", "_id").mapInArrow(tidy(keep), "_row bigint, kept string")
