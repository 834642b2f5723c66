"""Language identification by a byte convolutional network.

Bytes are embedded; filters of several widths slide over fixed-length windows of bytes; the
largest response of each filter over the window goes through a softmax layer.  All of it is
trained in numpy, by backpropagation, on every window of every labelled text, and applied to
every window of every whole text; a text's probabilities are the mean over its windows, weighted by
their bytes.

Training has two parts.  The driver leads a network from chance to a common start on a bounded number of
windows (``starting_windows``).  From there each task trains on all windows of all labelled texts it
reads, and the mean of the tasks' weights, by their windows, is the network (``trained_on_all``).

With ``reject`` the network also learns a class of windows that are no language: random and scrambled
characters.  Its probability rejects a text if it is over a limit, set on all windows of the labelled texts
that did not train, so that nearly all of them stay; the text gets ``und`` and score 0.

A text that is null or has no letter gets ``und`` and score 0.  Texts without label train nothing.
Without any labelled text every text is ``und``.  Ties go to the first language in order of name.
Repeated rows and null ids are judged like others.  Long texts are read whole, some thousand windows at a
time.  An empty table gives no rows."""

import copy
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluicegate.llm.common import text_batches, tidy
from sluicegate.llm.tokens import text_slices

WINDOW = 256
BLOCK = 4096  # windows that are shuffled together
STEPS = 1 << 16  # of the probability in which the limit is set
KEPT = 0.999  # of the windows that did not train are under the limit
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")  # and number signs such as ²


def has_letter(text):
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def windows(data, window=WINDOW):
    """Whole bytes of a text as rows of a fixed length; the last is filled up with zeros."""
    raw = np.frombuffer(data, np.uint8)
    rows = -(-len(raw) // window)
    out = np.zeros(rows * window, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(rows, window)


class Network:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, labels, embedding=8, widths=(2, 3, 4), filters=20, seed=7):
        rng = np.random.default_rng(seed)
        self.labels, self.widths, self.filters = tuple(labels), tuple(widths), filters
        self.limit = None  # with one, the last label is the class of no language
        self._rooms = {}
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {"embedding": draw(0.5, 256, embedding)}
        for k in widths:
            self.weights[f"filter{k}"] = draw((2 / (k * embedding)) ** 0.5, k * embedding, filters)
            self.weights[f"bias{k}"] = np.zeros(filters, np.float32)
        self.weights["out"] = draw(0.1, len(widths) * filters, len(self.labels))
        self.weights["shift"] = np.zeros(len(self.labels), np.float32)

    def copy(self):
        made = copy.copy(self)
        # weights that came by pickle have a type object of their own, with which np.add.at takes its slow path
        made.weights = {k: w.astype(np.dtype(np.float32)) for k, w in self.weights.items()}
        return made

    def __getstate__(self):
        return {**self.__dict__, "_rooms": {}}

    def _room(self, name, *shape):
        """An array whose memory is used again: fresh pages cost more than what is written to them."""
        room, size = self._rooms.get(name), math.prod(shape)
        if room is None or room.size < size:
            room = self._rooms[name] = np.empty(size, np.float32)
        return room[:size].reshape(shape)

    def _responses(self, batch, rooms):
        """Of all filters, in order of width, for every place: arrays of filters, rows, spans, one for each offset.

        Spans are as long as the widest filter and lie end to end, so that from each offset on they are rows
        of one matrix without a copy; a narrower filter is filled up with zeros.  The place is ``span * widest
        + offset``; a filter that would pass the end of a window has minus infinity there.  The arrays lie in
        ``rooms`` by turns."""
        rows, length = batch.shape
        size, wide = self.weights["embedding"].shape[1], max(self.widths)
        spans = -(-length // wide)
        data = np.zeros((rows * spans + 1) * wide, np.uint8)
        data[:-wide].reshape(rows, -1)[:, :length] = batch
        embedded = self._room("embedded", len(data), size)
        self.weights["embedding"].take(data, axis=0, out=embedded, mode="clip")
        joint = np.zeros((len(self.widths) * self.filters, wide * size), np.float32)
        for i, k in enumerate(self.widths):
            joint[i * self.filters : (i + 1) * self.filters, : k * size] = self.weights[f"filter{k}"].T
        for offset in range(wide):
            out = self._room(rooms[offset % len(rooms)], len(joint), rows, spans)
            matrix = embedded[offset : offset - wide].reshape(rows * spans, -1)
            np.matmul(joint, matrix.T, out=out.reshape(len(joint), -1))
            for i, k in enumerate(self.widths):
                fit_in = max(0, (length - k - offset) // wide + 1)
                out[i * self.filters : (i + 1) * self.filters, :, fit_in:] = -np.inf
            yield out

    def _largest(self, batch):
        top = None
        for out in self._responses(batch, ["top"] + ["other"] * (max(self.widths) - 1)):
            top = out if top is None else np.maximum(top, out, out=top)
        return top.max(axis=2).T

    def _largest_and_places(self, batch):
        """Of equal responses, the first place."""
        outs = list(self._responses(batch, [f"responses{k}" for k in range(max(self.widths))]))
        top = self._room("top", *outs[0].shape)
        top[:] = outs[0]
        for out in outs[1:]:
            np.maximum(top, out, out=top)
        span = top.argmax(axis=2)
        cells = np.arange(span.size).reshape(span.shape) * top.shape[2] + span
        found = np.stack([out.take(cells).T for out in outs])
        return found.max(axis=0), span.T * len(outs) + found.argmax(axis=0)

    def pooled(self, batch, places=False, step=32):
        """Each filter's largest response in each window, and its place if wanted; ``step`` windows at a time."""
        look = self._largest_and_places if places else lambda some: (self._largest(some), None)
        found = [look(batch[low : low + step]) for low in range(0, len(batch), step)]
        bias = np.concatenate([self.weights[f"bias{k}"] for k in self.widths])
        best = np.maximum(np.ascontiguousarray(np.concatenate([b for b, _ in found])) + bias, 0)
        return best, np.concatenate([at for _, at in found]) if places else None

    def _softmax(self, features):
        z = features @ self.weights["out"] + self.weights["shift"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, batch, step=256):
        parts = [self._softmax(self.pooled(batch[i : i + step])[0]) for i in range(0, len(batch), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def gradients(self, batch, wanted, worth=None):
        """Of the mean loss of the windows, each ``worth`` 1 if not told otherwise."""
        features, at = self.pooled(batch, places=True)
        p = self._softmax(features)
        p[np.arange(len(batch)), wanted] -= 1
        p /= len(batch)
        if worth is not None:
            p *= worth[:, None]
        grads = {"out": features.T @ p, "shift": p.sum(axis=0)}
        back = (p @ self.weights["out"].T) * (features > 0)
        d_embedding = np.zeros(self.weights["embedding"].shape, np.float32)
        size = d_embedding.shape[1]
        rows = np.arange(len(batch))[:, None]
        for i, k in enumerate(self.widths):
            own = slice(i * self.filters, (i + 1) * self.filters)
            g = back[:, own]
            span = at[:, own, None] + np.arange(k)  # rows, filters, k
            seen = batch[rows[:, :, None], span]
            inputs = self.weights["embedding"].take(seen, axis=0).reshape(len(batch), self.filters, -1)
            grads[f"filter{k}"] = np.einsum("rf,rfi->if", g, inputs)
            grads[f"bias{k}"] = g.sum(axis=0)
            to = g[:, :, None] * self.weights[f"filter{k}"].T[None]
            cells = seen.reshape(-1, 1).astype(np.intp) * size + np.arange(size)
            np.add.at(d_embedding.reshape(-1), cells.ravel(), to.ravel())  # flat, as rows take far longer
        grads["embedding"] = d_embedding
        return grads

    def train(self, batch, wanted, epochs=12, step=64, rate=4e-3, seed=7):
        """Adam over shuffled batches, the rate falling to zero."""
        rng = np.random.default_rng(seed)
        adam = Adam(self)
        total, t = epochs * -(-len(batch) // step), 0
        for _ in range(epochs):
            order = rng.permutation(len(batch))
            for low in range(0, len(order), step):
                some = order[low : low + step]
                t += 1
                adam.step(batch[some], wanted[some], rate * (1 - t / total))
        return self

    def predict(self, texts):
        """(label, score) of each text."""
        found, blocks, owners = [(UNKNOWN, 0.0)] * len(texts), [], []
        if not self.labels:
            return found
        sums = np.zeros((len(texts), len(self.labels)))
        sizes = np.zeros(len(texts))

        def flush():
            rows = np.concatenate(blocks)
            own = np.concatenate(owners)
            used = np.count_nonzero(rows, axis=1)
            np.add.at(sums, own, self.probabilities(rows) * used[:, None])
            np.add.at(sizes, own, used)
            blocks.clear(), owners.clear()

        held = 0
        for i, text in enumerate(texts):
            if text is None or not has_letter(text):
                continue
            rows = windows(text.encode("utf-8", "replace"))
            for low in range(0, len(rows), 4096):
                part = rows[low : low + 4096]
                blocks.append(part), owners.append(np.full(len(part), i))
                held += len(part)
                if held >= 4096:
                    flush()
                    held = 0
        if blocks:
            flush()
        for i in np.flatnonzero(sizes):
            share = sums[i] / sizes[i]
            if self.limit is not None:
                if share[-1] > self.limit:
                    continue
                share = share[:-1]
            best = int(np.argmax(share))
            found[i] = (self.labels[best], float(min(1.0, share[best])))
        return found


class Adam:
    """Steps of a network's weights, with the means of its gradients and their squares."""

    def __init__(self, network):
        self.network, self.t = network, 0
        self.first = {k: np.zeros_like(w) for k, w in network.weights.items()}
        self.second = {k: np.zeros_like(w) for k, w in network.weights.items()}

    def step(self, batch, wanted, rate, worth=None):
        self.t += 1
        first, second, weights = self.first, self.second, self.network.weights
        for k, g in self.network.gradients(batch, wanted, worth).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            m, v = first[k] / (1 - 0.9**self.t), second[k] / (1 - 0.999**self.t)
            weights[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def held_out(doc_id="doc_id"):
    """Rows that must not train: crc32 of the id's text leaves 1 on division by 3 (null: none)."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def lettered(labelled, text="text", label="lang"):
    """The rows that have a label, and a letter in their text."""
    return labelled.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))


def starting_windows(rows, counts, doc_id="doc_id", text="text", label="lang", documents=300, spans=8):
    """(label, text span) of about ``documents`` documents of each label, ``spans`` of each.

    Only for the common start: all windows train after it.  Documents are drawn by a hash of their ids,
    spans from all places of the whole text.  What the driver gets is bounded by the number of labels
    times ``documents`` times ``spans`` spans; ``counts`` has the documents of each label."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame(
        [(k, min(1.0, 1.3 * documents / n)) for k, n in counts.items()], "_label string, _share double"
    )
    draw = (F.pmod(F.xxhash64(doc_id, F.lit("draw")), F.lit(1 << 30)) / F.lit(1 << 30)).alias("_draw")
    length = F.greatest(F.length(text) - WINDOW, F.lit(0))
    span = F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("_span")
    drawn = (
        rows.select(F.col(label).alias("_label"), doc_id, text, draw)
        .join(F.broadcast(wanted), "_label")
        .where("_draw < _share")
        .select("_label", "_draw", doc_id, text, span)
    )
    at = F.pmod(F.xxhash64(doc_id, "_span"), length + 1).cast("int") + 1
    found = drawn.select(
        "_label", "_draw", "_span", F.substring(F.col(text), at, F.lit(WINDOW)).alias("part")
    )
    found = sorted(found.limit(2 * documents * spans * len(counts)).collect())
    return [(r[0], r[3]) for r in found if has_letter(r[3])]


ASCII = np.array([chr(c) for c in range(33, 127)])
ALPHABETS = (ASCII, ASCII[15:25], np.array(list("0123456789abcdef")), np.array(list("abcdefghijklmnopqrstuvwxyz")))


def no_language(part, kind, rng):
    """A text of the length of ``part`` that is none: shuffled, drawn from an alphabet, or repeated."""
    signs = list(part)
    spaces = [i for i, c in enumerate(signs) if c.isspace()]
    if kind % 3 == 0:  # the same characters, the words where they were or not
        letters = [c for c in signs if not c.isspace()]
        rng.shuffle(letters)
        drawn = iter(letters)
        return "".join(c if c.isspace() else next(drawn) for c in signs)
    if kind % 3 == 1:
        own = np.array(sorted({c for c in signs if not c.isspace()}) or ["a"])
        choices = (*ALPHABETS, own, np.array(list(ASCII[32:58]) + list(ASCII[64:90])))
        drawn = rng.choice(choices[rng.integers(len(choices))], len(signs))
        if rng.random() < 0.7:
            drawn[spaces] = " "
        return "".join(drawn)
    unit = "".join(rng.choice(ALPHABETS[3], rng.choice([1, 1, 1, 2, 3, 4, 6])))
    unit += " " if rng.random() < 0.4 else ""
    return (unit * len(signs))[: max(len(signs), 1)]


def as_windows(parts, rng):
    batch = np.zeros((len(parts), WINDOW), np.uint8)
    for row, part in zip(batch, parts):
        data = np.frombuffer(part.encode("utf-8", "replace")[:WINDOW], np.uint8)
        if rng.random() < 0.4:  # short texts are met too
            data = data[: rng.integers(12, 120)]
        row[: len(data)] = data
    return batch


def window_blocks(batches, number):
    """(windows, labels' numbers) of all texts in batches of text and label, about ``BLOCK`` at a time.

    An eighth of the windows is cut in two: short texts are met too, and no byte is lost."""

    def block():
        rows, own = np.concatenate(held), np.concatenate(owners)
        held.clear(), owners.clear()
        rng = np.random.default_rng(zlib.crc32(rows))
        cut = np.flatnonzero(rng.random(len(rows)) < 1 / 8)
        tails = np.zeros((len(cut), WINDOW), np.uint8)
        for i, n, tail in zip(cut.tolist(), rng.integers(12, 120, len(cut)).tolist(), tails):
            tail[: WINDOW - n] = rows[i, n:]
            rows[i, n:] = 0
        some = tails.any(axis=1)
        return np.concatenate([rows, tails[some]]), np.concatenate([own, own[cut[some]]]), rng

    held, owners, count = [], [], 0
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            rows = windows(text.as_py().encode("utf-8", "replace"))
            for low in range(0, len(rows), BLOCK):
                part = rows[low : low + BLOCK]
                held.append(part), owners.append(np.full(len(part), number[label]))
                count += len(part)
                if count >= BLOCK:
                    yield block()
                    count = 0
    if held:
        yield block()


def trained_on_all(network, rows, sizes, text="text", label="lang", step=64, rate=1e-3):
    """The network after every window of all labelled texts has trained it.

    Each task goes on from the network given; the result is the mean of their weights, by windows.  A
    window is worth more if its label is rare (``sizes``: bytes by label), 8 times at most so that
    steps stay small.  What the driver gets is a network of some 16 KB a task."""
    text_batches(rows)
    number = {k: i for i, k in enumerate(sorted(sizes))}
    even = sum(sizes.values()) / len(sizes)
    worth = np.array([min(8.0, even / max(sizes[k], 1)) for k in sorted(sizes)] + [1.0], np.float32)
    names = sorted(network.weights)

    def train(batches):
        own, seen = network.copy(), 0
        adam = Adam(own)
        for block, wanted, rng in window_blocks(batches, number):
            if len(own.labels) > len(number):  # twice a label's share is no language
                some = rng.permutation(len(block))[: max(1, 2 * len(block) // len(number))]
                parts = [block[i].tobytes().rstrip(b"\0").decode("utf-8", "ignore") for i in some]
                none = as_windows([no_language(p, k, rng) for k, p in enumerate(parts)], rng)
                block = np.concatenate([block, none])
                wanted = np.concatenate([wanted, np.full(len(none), len(number))])
            order = rng.permutation(len(block))
            for low in range(0, len(order), step):
                part = order[low : low + step]
                adam.step(block[part], wanted[part], rate, worth[wanted[part]])
            seen += len(block)
        if seen:
            flat = np.concatenate([own.weights[k].ravel() for k in names])
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["seen", "weights"]
            )

    found = rows.select(text, label).mapInArrow(tidy(train), "seen bigint, weights binary").collect()
    if not found:
        return network
    total = sum(r.seen for r in found)
    mean = sum(np.frombuffer(r.weights, np.float32) * (r.seen / total) for r in found)
    made, at = network.copy(), 0
    for k in names:
        size = made.weights[k].size
        made.weights[k] = mean[at : at + size].reshape(made.weights[k].shape).astype(np.float32)
        at += size
    return made


def rejection_limit(network, rows, text="text", label="lang"):
    """A probability of no language that ``KEPT`` of all windows of the labelled texts do not exceed.

    All windows are counted by steps of ``1 / STEPS``; the limit is the upper end of a step, 0.5 at least."""
    text_batches(rows)

    def judge(batches):
        counts = np.zeros(STEPS + 1, np.int64)
        for block, _, _ in window_blocks(batches, {UNKNOWN: 0}):
            found = network.probabilities(block)[:, -1]
            counts += np.bincount((found * STEPS).astype(np.int64), minlength=STEPS + 1)
        steps = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(steps, pa.int64()), pa.array(counts[steps], pa.int64())], ["step", "n"]
        )

    judged = rows.select(text, F.lit(UNKNOWN).alias(label)).mapInArrow(tidy(judge), "step bigint, n bigint")
    found = sorted(judged.groupBy("step").agg(F.sum("n").alias("n")).collect())
    left = KEPT * sum(r.n for r in found)
    for r in found:
        left -= r.n
        if left <= 0:
            return max(0.5, min(1.0, (r.step + 1) / STEPS))
    return 0.5


def fit(
    labelled, doc_id="doc_id", text="text", label="lang", documents=300, spans=8, reject=None, **settings
):
    """A network for the labels of ``labelled`` rows.

    ``documents`` and ``spans`` bound the start on the driver; all windows of all rows train.
    ``reject``: labelled rows that do not train, on which the limit of the class of no language is set."""
    rows = lettered(labelled, text, label)
    found = rows.groupBy(label).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("size"))
    found = sorted(found.collect())  # one row per language
    labels, sizes = [r[0] for r in found], {r[0]: r.size for r in found}
    network = Network(labels if reject is None or not labels else [*labels, UNKNOWN], **settings)
    if not labels:
        return network
    counts = {r[0]: r.n for r in found}
    sample = starting_windows(rows, counts, doc_id, text, label, documents, spans)
    wanted = [labels.index(k) for k, _ in sample]
    parts = [part for _, part in sample]
    if reject is not None:
        rng = np.random.default_rng(11)
        count = min(len(parts), max(600, 2 * len(parts) // len(labels)))
        for kind, i in enumerate(rng.permutation(len(parts))[:count].tolist()):
            parts.append(no_language(parts[i], kind, rng))
            wanted.append(len(labels))
    if parts:
        network.train(as_windows(parts, np.random.default_rng(5)), np.array(wanted))
    network = trained_on_all(network, rows, sizes, text, label)
    if reject is not None:
        network.limit = rejection_limit(network, lettered(reject, text, label), text, label)
    return network


def identify(docs, network, text="text", label="lang_pred", score="score"):
    """Adds ``label`` and ``score`` to ``docs`` (in place of columns so named); only the text is read."""
    text_batches(docs)
    docs = docs.drop(label, score)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def predict(batches):
        for batch in batches:
            texts, found = batch.column(names.index(text)).to_pylist(), []
            for low, high in text_slices([t or "" for t in texts]):
                found += network.predict(texts[low:high])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k for k, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                [*names, label, score],
            )

    return docs.mapInArrow(tidy(predict), f"{schema}, `{label}` string, `{score}` double")


def identify_documents(docs, doc_id="doc_id", text="text", label="lang", **settings):
    """doc_id, held_out, lang_pred, score; learns from the documents that are not held out."""
    network = fit(docs.where(~held_out(doc_id)), doc_id, text, label, **settings)
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("_text")
    )
    return identify(slim, network, "_text").drop("_text")
