"""Token ids of a word-level BPE file of the tokenizers library, with a cache of words.

The file's pre-tokenizer splits a text at white space first and never joins across it, so the ids
of a text are the ids of its words in order.  Words made only of common Latin letters, digits and
ASCII signs, whose lower case and normal form do not depend on context, are encoded once and
remembered; any text with other characters goes to the library as it is."""

import gc
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters for which Arrow and the library agree on lower case, normal form and classes.
PLAIN = "^[\t\n\r -~¡-¬®-ÿ]*$"
WORDS = 1_000_000  # a cache is emptied at this size (about 200 MB); ids do not depend on it


class WordIds:
    """Ids as little-endian unsigned 16-bit integers (the vocabulary has fewer than 2**16)."""

    def __init__(self, path, most=WORDS):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        # for words that are cut and in lower case already: the same model with less before it
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 << 16, bool)  # tokens that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = {}  # words and their pieces
        letters = "a-zªµºß-öø-ÿ"
        digits = "0-9²³¹¼-¾"
        self.piece = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+"
        )

    def _encode(self, texts):
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in encoded]

    def _encode_words(self, words, step=4000):
        """The ids of words of one piece each, encoded many at a time."""
        out = []
        for start in range(0, len(words), step):
            part = words[start : start + step]
            (found,) = self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, "<u2")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # a vocabulary that doesn't mark word ends
                out.extend(self._encode(part))
                continue
            data, stops = ids.tobytes(), (2 * stops).tolist()
            out.extend(map(data.__getitem__, map(slice, [0, *stops[:-1]], stops)))
        return out

    def _learn(self, new):
        known, split = self.words, self.piece.findall
        unknown = {w for w in new if w.isalpha()}
        others = []
        for word in new - unknown:
            if word[-1] in ".,;:!?" and word[:-1].isalpha():  # the usual case
                others.append((word, [word[:-1], word[-1]]))
            else:
                others.append((word, split(word)))
        unknown.update([p for _, parts in others for p in parts if p not in known])
        unknown = list(unknown)
        known.update(zip(unknown, self._encode_words(unknown)))
        for word, parts in others:
            if len(parts) > 1:
                known[word] = b"".join([known[p] for p in parts])

    def encode(self, texts):
        """The ids of each text as bytes."""
        flat, counts = self.encode_array(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        return [flat[b - n : b].tobytes() for b, n in zip(ends.tolist(), counts.tolist())]

    def encode_array(self, texts):
        """All ids of an Arrow array of texts in a row, and how many each text has."""
        collects = gc.isenabled()
        gc.disable()  # nothing here has cycles, and a collection walks the whole cache
        try:
            return self._ids(texts)
        finally:
            if collects:
                gc.enable()

    def _ids(self, texts):
        plain = pc.and_not(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))
        mask = plain.to_numpy(zero_copy_only=False)
        whole = mask.all()
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts if whole else texts.filter(plain)))
        # Arrow numbers the words, so Python looks at each different one once
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = {w for w in words if w and w not in self.words}
        if len(self.words) + len(new) > self.most:
            self.words.clear()
            new = {w for w in words if w}
        self.words[""] = b""  # what stands before a space at the start of a text, and the like
        self._learn(new)
        found = list(map(self.words.__getitem__, words))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) >> 1
        ids = np.frombuffer(b"".join(found), "<u2")
        number = coded.indices.to_numpy(zero_copy_only=False)
        each = lengths[number]
        flat = gathered(ids, (np.cumsum(lengths) - lengths)[number], each)
        ends = np.concatenate([[0], np.cumsum(each)])
        at = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        counts = np.diff(ends[np.concatenate([[0], at])])
        if whole:
            return flat, counts
        return self._with_others(texts, mask, flat, counts)

    def _with_others(self, texts, mask, flat, counts):
        """The same with the other texts, which the library takes as they are."""
        others = [np.frombuffer(x, "<u2") for x in self._encode(texts.filter(pa.array(~mask)).to_pylist())]
        total = np.zeros(len(mask), np.int64)
        total[mask], total[~mask] = counts, list(map(len, others))
        out = np.empty(int(total.sum()), "<u2")
        ours = np.repeat(mask, total)
        out[ours] = flat
        out[~ours] = np.concatenate(others)
        return out, total


def gathered(flat, starts, counts):
    """Runs of a flat array, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


def word_ids(path, most=WORDS):
    """The encoder of this worker process, kept from task to task; ``most``: words it remembers."""
    import sys
    import types

    name = "_sluicegate_word_ids"
    home = sys.modules.setdefault(name, types.ModuleType(name))
    if getattr(home, "path", None) != path:
        home.path, home.encoder = path, WordIds(path)
    home.encoder.most = most
    return home.encoder


def array_slices(texts, size=4_000_000):
    """Slices of an Arrow array of texts, of about so many bytes: (first row, slice)."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield low, texts.slice(low, high - low)
        low = high


def text_slices(texts, characters=3_000_000):
    """Index ranges of about so many characters, so that a batch of long texts needs little memory."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= characters:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
