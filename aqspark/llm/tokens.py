"""Token ids of whole texts with a public byte-level BPE tokenizer.

Most words of a corpus occur many times, so a Python worker encodes each of them once, and looks those of a batch up together. A text may be cut before a blank that stands between two
characters that aren't white space: no piece of the tokenizer's pattern spans that place. Nor does one span the place between a letter and the
punctuation that ends a word, so that a word is encoded once for all marks that follow it. Texts with any other blank, or with a
special token, are encoded whole. Either way the ids equal those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from aqspark.llm.common import prefix

#: Words that a worker remembers, some 200 bytes each; the half that wasn't met for longest is forgotten when there are more.
REMEMBERED = 600_000
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ENDS = f"^$|^{_BLANK}|{_BLANK}$"
#: Marks that may be cut off the end of a word, if a letter up to U+024F stands before them. The apostrophe isn't one, as it begins contractions.
_MARKS = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]\z"
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.after_blank = np.zeros(self.size, dtype=bool)  # tokens that begin with a blank
        for token, i in vocabulary.items():
            self.after_blank[i] = token.startswith("Ġ")
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.place: dict[str, int] = {}  # of words met after a blank; their ids lie in the pool one after another
        self.pool, self.begin = np.zeros(0, dtype=self.kind), np.zeros(1, dtype=np.int64)
        self.met, self.turn = np.zeros(0, dtype=np.int32), 0

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Append words to those known. Many are encoded at a time, each after a blank, and cut where a token begins with one."""
        parts, sizes = [], []
        for at in range(0, len(words), 500):
            own = words[at : at + 500]
            ids = np.array(self._raw([" " + " ".join(own)])[0], dtype=self.kind)
            cuts = np.append(np.flatnonzero(self.after_blank[ids]), len(ids))
            if len(cuts) != len(own) + 1:
                each = self._raw([" " + w for w in own])
                ids, cuts = np.concatenate([np.array(x, dtype=self.kind) for x in each]), prefix(np.array(list(map(len, each))))
            parts.append(ids)
            sizes.append(np.diff(cuts))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.pool = np.concatenate([self.pool, *parts])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        self.met = np.concatenate([self.met, np.full(len(words), self.turn, dtype=np.int32)])

    def _taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words, one after another, and where each begins."""
        size = self.begin[at + 1] - self.begin[at]
        end = prefix(size)
        return self.pool[np.repeat(self.begin[at] - end[:-1], size) + np.arange(end[-1])], end

    def _forget(self) -> None:
        kept = np.sort(np.argsort(self.met, kind="stable")[-(REMEMBERED // 2) :])
        words = list(self.place)
        self.place = {words[at]: i for i, at in enumerate(kept.tolist())}
        self.pool, self.begin = self._taken(kept)
        self.met = self.met[kept]

    def _known(self, words: list[str]) -> np.ndarray:
        """The place of each word among those known, or -1."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of different words that stand after a blank, as bytes."""
        stems = pc.ascii_rtrim(words, _MARKS)
        stems = pc.if_else(pc.match_substring_regex(stems, _LETTER), stems, words)
        marks = _rest(words, stems).dictionary_encode()
        stems = stems.dictionary_encode()
        spelled = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = self._known(spelled)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new = [spelled[i] for i in missing.tolist()]
            self._learn(new)
            place[missing] = self._known(new)
        self.met[place] = self.turn
        ids = _binary(*self._taken(place)).take(stems.indices)
        after = pa.array([self._bytes(x) for x in self._raw(marks.dictionary.to_pylist())], pa.large_binary()).take(marks.indices)
        return pc.binary_join_element_wise(ids, after, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch, and where each text's ids begin (one more number at the end). Null counts as empty."""
        if len(self.place) > REMEMBERED:
            self._forget()
        self.turn += 1
        texts = pc.fill_null(texts.cast(pa.string()), "")
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        words = split.flatten().dictionary_encode()
        code, spelled = np.array(words.indices), words.dictionary
        # a blank beside white space leaves a chunk that is empty or has white space at an end
        strange = pc.match_substring_regex(spelled, _ENDS).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(strange[code], starts[:-1], dtype=np.int64) > 0 if len(code) else np.zeros(len(texts), dtype=bool)
        if self.special:
            odd |= pc.match_substring_regex(texts, self.special.pattern).to_numpy(zero_copy_only=False)
        # a table of the batch: words after a blank, then the first chunks of texts, which have none before them, and nothing, for texts encoded whole
        n, first = len(spelled), starts[:-1][~odd]
        leading, which = np.unique(code[first], return_inverse=True)
        nothing = n + len(leading)
        code[first] = n + which
        if odd.any():
            code[np.repeat(odd, np.diff(starts))] = nothing
        used = np.zeros(nothing + 1, dtype=bool)
        used[code] = True
        used = np.flatnonzero(used[:n])
        after = self._words(spelled.take(pa.array(used)))
        own = [self._bytes(x) for x in self._raw(spelled.take(pa.array(leading)).to_pylist())]
        sizes, width = np.zeros(nothing + 1, dtype=np.int64), self.pool.itemsize
        sizes[used] = np.diff(_edges(after)) // width
        sizes[n:nothing] = np.array(list(map(len, own)), dtype=np.int64) // width
        found = _binary(np.concatenate([_data(after, self.kind), np.frombuffer(b"".join(own), dtype=self.kind)]), prefix(sizes)).take(pa.array(code))
        ids, offsets, whole = _data(found, self.kind), _edges(found)[starts] // width, np.flatnonzero(odd).tolist()
        return _with(ids, offsets, whole, self._raw(texts.take(pa.array(whole)).to_pylist())) if whole else (ids, offsets)


def _binary(ids: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin * ids.itemsize), pa.py_buffer(ids)])


def _edges(values: pa.Array) -> np.ndarray:
    """Where the bytes of each value begin, and the last one's end."""
    return np.frombuffer(values.buffers()[1], dtype=np.int64, count=len(values) + 1, offset=8 * values.offset)


def _data(values: pa.Array, kind: type) -> np.ndarray:
    edges, data = _edges(values), values.buffers()[2]
    width = np.dtype(kind).itemsize
    size = int(edges[-1] - edges[0]) // width
    return np.frombuffer(data, dtype=kind, count=size, offset=int(edges[0])) if size else np.zeros(0, dtype=kind)


def _rest(words: pa.Array, stems: pa.Array) -> pa.Array:
    """What each word has after its stem."""
    words, stems = words.cast(pa.large_binary()), stems.cast(pa.large_binary())
    size, own = np.diff(_edges(words)), np.diff(_edges(stems))
    more = np.repeat(np.arange(len(size)), size - own)
    begin = prefix(size - own)
    at = (_edges(words)[:-1] + own - begin[:-1])[more] + np.arange(begin[-1])
    return _binary(np.frombuffer(words.buffers()[2], dtype=np.uint8)[at] if len(at) else np.zeros(0, dtype=np.uint8), begin).cast(pa.large_string())


def _with(ids: np.ndarray, offsets: np.ndarray, at: list[int], own: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Put the ids of single texts, which are empty so far, into their places."""
    sizes = np.diff(offsets)
    sizes[at] = [len(x) for x in own]
    out, new = np.empty(int(sizes.sum()), dtype=np.uint32), prefix(sizes)
    blank = np.zeros(len(out), dtype=bool)
    for i, x in zip(at, own):
        out[new[i] : new[i + 1]] = x
        blank[new[i] : new[i + 1]] = True
    out[~blank] = ids
    return out, new
