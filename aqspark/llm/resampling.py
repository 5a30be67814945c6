"""Importance resampling towards a target distribution, over hashed runs of words.

Each run of 1 to ``runs`` consecutive words is a feature; its bucket is the CRC-32 of its bytes modulo ``buckets``. A bucket gains by how much more often the target
has it than the raw documents, and a document weighs the floored mean of the gains of its features. Seeded noise of its id is added, and the highest scores are drawn.

A worker keeps an Aho-Corasick dictionary of words between two delimiters, which carry their CRC and length as payload. One scan of a batch emits payloads; the payloads
of adjacent words compose to the CRC of their run without reading bytes again. A word that the dictionary doesn't know is hashed by itself, so results don't depend
on the dictionary, which is bounded (``DICTIONARY`` words) and learns words that a batch repeats. Buckets are written once, two bytes a feature, and
read for counting and for scoring; only the ``buckets`` counts and gains meet in the driver.

Texts are lower-cased for A-Z and cut into words of digits, a-z and characters beyond ASCII. A null or empty text has no features and weighs 0. A null id is spelled as nothing and
ranks behind ties; rows with equal score and id are ranked in the order of the scan. Repeated rows are drawn separately. Long texts are scanned whole, in slices. Empty tables give
no rows, and an empty target no counts. Columns other than those named are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from aqspark.llm.common import batches, byte_rows, prefix, small_side, stage, stage_compact
from aqspark.llm.contamination import NORMAL

BUCKETS, RUNS, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: Words that a worker's dictionary holds (some 10 MB), and the longest of them.
DICTIONARY, WORD_BYTES = 60_000, 64
#: Bytes of text scanned at a time.
SLICE = 1 << 20


# ---- composition of CRCs --------------------------------------------------------------------------


def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by the images of single bits."""
    out = np.zeros_like(values)
    for b in range(32):
        out ^= np.where(values >> np.uint32(b) & np.uint32(1), columns[b], np.uint32(0))
    return out


@lru_cache(maxsize=4096)
def _shift_tables(length: int) -> np.ndarray:
    """What ``length`` more bytes of zeros make of each byte of a CRC, by repeated squaring of the step of one bit."""
    bits = (1 << np.arange(32, dtype=np.uint64)).astype(np.uint32)
    power, out, n = np.where(bits & np.uint32(1), np.uint32(0xEDB88320), bits >> np.uint32(1)), bits, 8 * length
    while n:
        if n & 1:
            out = _apply(power, out)
        power, n = _apply(power, power), n >> 1
    return np.stack([_apply(out, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = np.empty_like(crc)
    for n in np.unique(length).tolist():
        own, t = length == n, _shift_tables(n)
        c = crc[own]
        out[own] = t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]
    return out


_BLANK = np.uint32(zlib.crc32(b" "))


def joined(crc: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC of texts, a blank and the words after them, from the CRCs of both and the words' lengths."""
    return shift(shift(crc, np.ones_like(length)) ^ _BLANK, length) ^ after


# ---- the dictionary -------------------------------------------------------------------------------


class Dictionary:
    def __init__(self, limit: int = DICTIONARY) -> None:
        self.limit, self.scanned, self.waiting = limit, 0, {}
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.crc = np.zeros(limit + 1, dtype=np.uint32)  # the last place is read for unknown words

    def payloads(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, CRC and length of each word of a normalised text with a blank at both ends."""
        edge = np.flatnonzero(np.diff((np.frombuffer(blob, dtype=np.uint8) != 32).view(np.int8))) + 1
        begin, end = edge[::2], edge[1::2]
        value = np.full(len(begin), -1, dtype=np.int64)
        if self.scanned:
            found = np.fromiter(chain.from_iterable(self.trie.iter(blob.decode("latin-1"))), dtype=np.int64)
            value[np.searchsorted(end, found[::2])] = found[1::2]
        crc, length = self.crc[value], end - begin
        missing = np.flatnonzero(value < 0)
        if len(missing):
            words = [blob[a:b] for a, b in zip(begin[missing].tolist(), end[missing].tolist())]
            crc[missing] = list(map(zlib.crc32, words))
            self._learn(words)
        return begin, crc, length

    def _learn(self, words: list[bytes]) -> None:
        """Words that occur again are kept; the automaton is made anew when it would grow by an eighth."""
        room = self.limit - self.scanned - len(self.waiting)
        if room > 0:
            self.waiting.update((w, None) for w, n in Counter(words).most_common(room) if n > 1 and len(w) <= WORD_BYTES)
        if len(self.waiting) > self.scanned // 8 or (self.waiting and self.scanned + len(self.waiting) == self.limit):
            for at, w in enumerate(self.waiting, self.scanned):
                self.trie.add_word(f" {w.decode('latin-1')} ", at)
                self.crc[at] = zlib.crc32(w)
            self.trie.make_automaton()
            self.scanned, self.waiting = len(self.trie), {}


_dictionary: list[Dictionary] = []


def worker_dictionary() -> Dictionary:
    if not _dictionary:
        _dictionary.append(Dictionary())
    return _dictionary[0]


def features(texts: list[bytes], runs: int, buckets: int, dictionary: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features, text by text; where each text's begin (one more at the end); and words of each text."""
    clean = [x.translate(NORMAL) for x in texts]
    blob = b" " + b" ".join(clean) + b" "
    at, parts = 0, []
    while at < len(blob) - 1:
        end = blob.find(b" ", min(at + SLICE, len(blob) - 1))  # a slice ends with the blank that the next one begins with
        begin, crc, length = dictionary.payloads(blob[at : end + 1])
        parts.append((begin + at, crc, length))
        at = end
    begin, crc, length = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
    first = 1 + prefix(np.array([len(x) + 1 for x in clean], dtype=np.int64))[:-1]
    doc = np.searchsorted(first, begin, side="right") - 1
    words = np.bincount(doc, minlength=len(texts))
    found, owner, run = [crc % buckets], [doc], crc
    for r in range(1, runs):
        run = joined(run[:-1], crc[r:], length[r:])
        own = doc[r:] == doc[:-r]
        found.append(run[own] % buckets)
        owner.append(doc[r:][own])
    bucket, owner = np.concatenate(found), np.concatenate(owner)
    if runs > 1:
        bucket = bucket[np.argsort(owner, kind="stable")]
    return bucket, prefix(np.bincount(owner, minlength=len(texts))), words


# ---- the jobs -------------------------------------------------------------------------------------


def bucketed(rows: DataFrame, key: Column, text: str, runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """Written table of ``key``, ``n_words``, ``n_features`` and ``buckets`` (little-endian bytes, 2 or 4 each)."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = worker_dictionary()
        for batch in batches(batches_, "text"):
            bucket, at, words = features(byte_rows(batch.column("text")), runs, buckets, dictionary)
            raw, edge = bucket.astype(kind).tobytes(), (at * np.dtype(kind).itemsize).tolist()
            columns = [batch.column("key"), pa.array(words), pa.array(np.diff(at)), pa.array([raw[a:b] for a, b in zip(edge, edge[1:])], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_features", "buckets"])

    narrow = rows.select(key.alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {narrow.schema['key'].dataType.simpleString()}, n_words long, n_features long, buckets binary"
    return stage_compact(narrow.mapInArrow(run, schema), "features")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds; tasks add up their own before one row per bucket reaches the driver."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches(rows, "buckets"):
            total += np.bincount(np.frombuffer(b"".join(batch.column("buckets").to_pylist()), dtype=kind), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier the target has each bucket; one feature is added to each."""
    s, t, n = raw.astype(float), target.astype(float), len(raw)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the floored mean of the gains (0 without features)."""
    shared, kind = found.sparkSession.sparkContext.broadcast(gain), "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "buckets"):
            n = batch.column("n_features").to_numpy(zero_copy_only=False).astype(np.int64)
            each = shared.value[np.frombuffer(b"".join(batch.column("buckets").to_pylist()), dtype=kind)]
            sums, at = prefix(each), prefix(n)
            weight = (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n_words"), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    kind_of = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind_of}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate from the seed and the id."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(spelled, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(scored: DataFrame) -> DataFrame:
    """``scored`` with ``place``, the rank from 1 by score, id and place in the scan. Ranges are sorted apart; their row counts give the rest."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("at")]
    # partition number and row inside it, fixed by the written table
    inside = stage(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("nth", F.monotonically_increasing_id()), "ranges")
    numbered = inside.withColumn("part", F.shiftright("nth", 33))
    totals = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))  # as many rows as ranges
    place = F.col("before") + F.col("nth").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return numbered.join(small_side(before), "part").withColumn("place", place)


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", runs: int = RUNS, buckets: int = BUCKETS,
    seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null unless drawn) for each row of ``docs``."""
    found = bucketed(docs, F.col(doc_id), text, runs, buckets)
    aimed = bucketed(target, F.lit(0), target_text, runs, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aimed, buckets))
    weights = weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stage(weights.withColumn("at", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= least_words
    drawn = percent * scored.where(enough).count() // 100
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = _ranked(scored.where(enough)).select(*names, rank.cast("long").alias("rank"))
    return ranked.unionByName(scored.where(~enough).select(*names, F.lit(None).cast("long").alias("rank")))
