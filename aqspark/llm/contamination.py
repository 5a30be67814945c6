"""Benchmark decontamination with one Aho-Corasick automaton over normalised test texts.

Texts are lower-cased for A-Z and cut into words of digits, a-z and characters beyond ASCII. A window is ``window`` consecutive words
of a test item, or all its words if it has fewer. One automaton over the words of all distinct windows scans each document once;
a document word inside any occurrence is hit, and hits are mapped to code point offsets of the original text. A document is
contaminated if it has a hit and at least one in ``share`` of its words is hit.

At its root the automaton tries one word after another, so a word that leads nowhere costs as much as the tests have words. It gets
stretches only: words that follow each other in some window, as many as the shortest window with one of these words at least.
No occurrence reaches beyond its stretch. Arrow cuts the words and looks them up, for all texts of a batch at once.

A null or empty text has no words and is clean; so is every document if the test table is empty. Test items without words match
nothing; rows with a null id add hits, but no id. Repeated test rows count once. Repeated documents get a row each. Other columns,
also with the names used here, are ignored by ``find_passages`` and kept by ``clean``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from aqspark.llm.common import batches, byte_rows, judged, prefix, release, stage

WINDOW, SHARE = 13, 20
#: Words and item ids in the windows of one automaton (about 100 bytes each). Longer lists of tests are scanned in blocks of this size.
BLOCK_WORDS = 1_500_000
#: Bytes of the texts whose words are looked up at once, or a single text.
CUT_BYTES = 1 << 19
#: Bytes that belong to words map to their lower case, others to a blank.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_built: dict[str, Windows] = {}


class Windows(NamedTuple):
    """The windows of one block, as a worker has them."""

    words: pa.Array  #: A word's number is its place here; 0 stands for all words that no window has.
    pairs: pa.Array  #: Two words that follow each other in a window, as ``_pairs`` writes them.
    least: np.ndarray  #: Words of the shortest window with the word of this number.
    automaton: ahocorasick.Automaton  #: Over the numbers; finds a window's place in the list and its number of words.


def words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows(tests: DataFrame, size: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """``window`` (words joined by blanks) and ``items``, the ids of the items that have it."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text"):
            found = [{b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if (w := words(x)) else set() for x in byte_rows(batch.column("text"))]
            ids = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            flat = pa.array([w.decode() for x in found for w in x], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(ids)), flat], names=["item", "window"])

    kind = tests.select(item).schema[0].dataType.simpleString()
    cut = tests.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"item {kind}, window string")
    return cut.groupBy("window").agg(F.collect_set("item").alias("items"))


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each text has."""
    normal = pa.array([x.translate(NORMAL).strip() or None for x in byte_rows(texts)], pa.binary())
    parts = pc.ascii_split_whitespace(normal.view(pa.string()))  # a view, because texts may have bytes that aren't UTF-8
    return parts.flatten(), parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbers(cut: pa.Array, known: pa.Array) -> np.ndarray:
    return pc.index_in(cut, value_set=known).fill_null(0).to_numpy(zero_copy_only=False)


def _pairs(numbers: np.ndarray, sizes: np.ndarray, known: int) -> np.ndarray:
    """Each word and the one after it as a number; 0, which is no pair of words of a window, at the end of a text."""
    out = np.zeros(len(numbers), dtype=np.int64)
    out[:-1] = numbers[:-1]
    out[:-1] *= known
    out[:-1] += numbers[1:]
    out[np.cumsum(sizes)[sizes > 0] - 1] = 0
    return out


def _automaton(key: str, rows: list[tuple[str, list]]) -> Windows:
    """Built once in a Python worker."""
    if key not in _built:
        _built.clear()
        cut, sizes = _cut(pa.array([window for window, _ in rows], pa.string()))
        known = pa.concat_arrays([pa.array([""]), cut.unique()])
        numbers = _numbers(cut, known)
        del cut
        pairs = np.unique(_pairs(numbers, sizes, len(known)))
        least = np.full(len(known), np.iinfo(np.int32).max, dtype=np.int32)
        np.minimum.at(least, numbers, np.repeat(sizes.astype(np.int32), sizes))
        release()
        found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        ends = prefix(sizes).tolist()
        for at, (a, b) in enumerate(zip(ends, ends[1:])):
            found.add_word(tuple(numbers[a:b].tolist()), (at, b - a))
        if rows:
            found.make_automaton()
        _built[key] = Windows(known, pa.array(pairs[pairs > 0]), least, found)
    return _built[key]


def _stretches(numbers: np.ndarray, sizes: np.ndarray, windows_: Windows) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each stretch of words in which a window may lie."""
    if not len(numbers):
        return numbers, numbers
    pairs = pa.array(_pairs(numbers, sizes, len(windows_.words)))
    apart = ~pc.is_in(pairs, value_set=windows_.pairs).to_numpy(zero_copy_only=False)
    first, end = np.flatnonzero(np.concatenate(([True], apart[:-1]))), np.flatnonzero(apart) + 1
    fits = end - first >= np.minimum.reduceat(windows_.least[numbers], first)
    return first[fits], end[fits]


def _spans(text: bytes, runs: list[int]) -> list[dict]:
    """Code point offsets of the runs of words that are hit."""
    at = [m.span() for m in _WORD.finditer(text.translate(NORMAL))]
    point = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(point[at[a][0]]), "end": int(point[at[b - 1][1]])} for a, b in zip(runs[::2], runs[1::2])]


def find_passages(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids, sorted as strings) and ``spans`` (start, end in code points) per document."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _passages(whole, tests, size, ("doc_id",))


def _blocks(tests: DataFrame, size: int) -> Iterator[tuple]:
    """Broadcast windows, block by block: the key of the automaton, its windows, and the ids of the items that have each."""
    spark = tests.sparkSession
    listed = stage(windows(tests, size).withColumn("n", F.size(F.split("window", " ")) + F.size("items")), "windows")
    blocks = listed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // BLOCK_WORDS + 1
    for k in range(blocks):
        # windows are spread over the blocks by their hash, so each block has about BLOCK_WORDS words at most
        own = listed.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k) if blocks > 1 else listed
        rows = [(r["window"], sorted(str(x) for x in r["items"])) for r in own.select("window", "items").toLocalIterator()]
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, rows)), 0 < k < blocks - 1, k == blocks - 1  # the automata of two blocks are in memory at a time


def _passages(whole: DataFrame, tests: DataFrame, size: int, keep: tuple[str, ...]) -> DataFrame:
    """``whole`` (``keep`` and ``text``) with the words hit, counted and located."""
    found = whole.select(*keep, "text", F.lit(None).cast("array<long>").alias("hits"), F.lit(None).cast("array<string>").alias("items"))
    for shared, cut, last in _blocks(tests, size):
        found = _scan(found, shared, keep, last)
        if cut:
            found = stage(found, "passages")
    return found.select(*keep, "n_words", "n_hit", "items", "spans")


def _kinds(df: DataFrame, keep: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` {df.select(c).schema[0].dataType.simpleString()}" for c in keep)


def _runs(texts: pa.Array, before: list[list[int] | None], windows_: Windows) -> tuple[np.ndarray, list, list[set[int]]]:
    """Of each text the number of words, first word and end of each run of words that are hit, now or ``before`` (null: none), and the windows found."""
    cut, sizes = _cut(texts)
    numbers, starts = _numbers(cut, windows_.words), prefix(sizes)
    del cut
    first, end = _stretches(numbers, sizes, windows_)
    runs, found = list(before), [set() for _ in before]
    row = np.searchsorted(starts, first, side="right") - 1
    for k, own in groupby(zip(row.tolist(), first.tolist(), end.tolist()), key=lambda x: x[0]):
        marks = np.zeros(sizes[k] + 1, dtype=np.int64)
        for _, a, b in own:
            at = a - starts[k]
            for last, (window, n) in windows_.automaton.iter(tuple(numbers[a:b].tolist())):
                marks[at + last - n + 1] += 1
                marks[at + last + 1] -= 1
                found[k].add(window)
        if found[k]:
            if before[k]:
                np.add.at(marks, before[k][::2], 1)
                np.add.at(marks, before[k][1::2], -1)
            runs[k] = np.flatnonzero(np.diff(np.concatenate(([False], np.cumsum(marks) > 0))))
    return sizes, runs, found


def _scan(found: DataFrame, shared, keep: tuple[str, ...], last: bool) -> DataFrame:
    """Add the occurrences of the windows in ``shared``; ``hits``: first word and end of each run of words that are hit. The last scan counts and locates
    these words too, so that texts needn't come back from Python."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, listed = shared.value
        windows_ = _automaton(key, listed)
        for batch in batches(rows, "text", CUT_BYTES):
            texts = batch.column("text")
            n_words, hits, new = _runs(texts, batch.column("hits").to_pylist(), windows_)
            items = [sorted({*(known or ()), *(i for at in x for i in listed[at][1])}) for known, x in zip(batch.column("items").to_pylist(), new)]
            columns = {c: batch.column(c) for c in keep} | {"items": pa.array(items, pa.list_(pa.string()))}
            columns |= {"n_words": pa.array(n_words), **_located(texts, hits)} if last else {"text": texts, "hits": pa.array(hits, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(columns)

    out = "n_words long, n_hit long, spans array<struct<start: long, end: long>>" if last else "text string, hits array<long>"
    return found.mapInArrow(run, f"{_kinds(found, keep)}, items array<string>, {out}")


def _located(texts: pa.Array, hits: list) -> dict[str, pa.Array]:
    """How many words of each text are hit, and where they are."""
    n = [0 if x is None else sum(x[1::2]) - sum(x[::2]) for x in hits]
    hit = [i for i, x in enumerate(hits) if x is not None]
    found = dict(zip(hit, byte_rows(texts.take(pa.array(hit, pa.int64())))))
    spans = [_spans(found[i], x) if i in found else [] for i, x in enumerate(hits)]
    return {"n_hit": pa.array(n, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}


def contaminated(share: int = SHARE) -> Column:
    """True if at least one word in ``share`` is hit, and any."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, tests: DataFrame, text: str = "text", size: int = WINDOW, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns. Texts are scanned in the tasks that read them; nothing but texts goes to
    Python and nothing but the runs of words that are hit comes back."""
    name = f"found_{uuid.uuid4().hex}"

    def scan(shared):
        def judge(texts: pa.Array, known: pa.Array) -> pa.Array:
            n, hits, _ = _runs(texts, known.to_pylist(), _automaton(*shared.value))
            return pa.StructArray.from_arrays([pa.array(n), pa.array(hits, pa.list_(pa.int64()))], names=["n", "hits"])

        return judge

    found = docs.withColumn(name, F.lit(None).cast("struct<n: long, hits: array<long>>"))
    for shared, cut, _ in _blocks(tests, size):
        found = found.withColumn(name, judged(found, text, "struct<n: long, hits: array<long>>", scan(shared), F.col(f"{name}.hits"), limit=CUT_BYTES))
        if cut:
            found = stage(found, "passages")
    ends = F.transform(F.col(f"{name}.hits"), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.coalesce(F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    return found.where(~((n_hit > 0) & (share * n_hit >= F.col(f"{name}.n")))).drop(name)
