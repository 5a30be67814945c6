"""Toxicity by class-conditional Kneser-Ney models of the letters in words.

Both classes have a model of the next byte of a word given the bytes before it. Only the longest context has counts of its own in each class (the number of
training documents with the word); rare contexts fall back on one shared model, built from continuation counts over all
documents: how many different longer grams end in a gram. A word's score is the difference of its log-likelihoods under the two models over its length;
a document's features are the mean over its words and its peaks. A logistic curve, fitted to scores that a document got from models without its
half of the training rows, turns them into a probability. The curve of five numbers is fitted on ``CURVE_ROWS`` labelled ids at most; everything else covers all rows.

The order is the same at every size. Ratios are whole multiples of 2**-24, so a word's sum doesn't depend on the order of its grams. A model of few grams is
sent to the tasks; a larger one stays a table, is joined with the grams of the distinct words, and the words' ratios are joined with the documents.

A null or empty text, or one without words, has features of zero. Labels that are null are ignored; if a label is repeated the largest counts. Rows with a null id are never trained on. Repeated rows
are scored alike. Without training rows every score is 0.5. Words may have any length. The join of words with their ratios is left to adaptive execution, which splits a
hot word. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from aqspark.llm.common import batches, byte_rows, small_side, stage, stage_compact
from aqspark.llm.contamination import NORMAL

ORDER, DISCOUNT, MASS = 6, 0.75, 1.0
#: Entries of a model that is sent to the tasks (20 bytes each). A larger one is joined; the result is the same.
ENTRIES = 1 << 22
#: Ratios are stored in units of one over this; they stay far below 128.
UNIT = float(1 << 24)
#: The documented bound of the labelled ids, one row each, that the logistic curve of five numbers is fitted on: those with the smallest hashes.
CURVE_ROWS = 100_000
FEATURES = ("mean", "peak", "peaks", "excess", "upper")


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)).cast("int")


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Document and word number of each word of a batch, and the distinct words."""
    plain = pa.array([x.translate(NORMAL) for x in byte_rows(column)], pa.binary()).cast(pa.string())
    split = pc.split_pattern(plain, " ")
    n = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    code, doc = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(n)), n)
    blank = pc.index(coded.dictionary, "").as_py()
    real = code != blank
    return doc[real], code[real], coded.dictionary


def grams(distinct: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of each distinct word, as whole numbers of ``order`` bytes, and the word of each. Blanks stand before and after a word."""
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int32)[distinct.offset : distinct.offset + len(distinct) + 1].astype(np.int64)
    data = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    word, begin = np.repeat(np.arange(len(size)), size), np.cumsum(size + order) - (size + order)
    padded = np.full(int((size + order).sum()), 32, dtype=np.int64)
    padded[begin[word] + order - 1 + np.arange(len(data)) - (offsets[:-1] - offsets[0])[word]] = data
    of = np.repeat(np.arange(len(size)), size + 1)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1) + begin[of] + order - 1
    out = np.zeros(len(place), dtype=np.int64)
    for back in range(order - 1, -1, -1):
        out = (out << 8) | padded[place - back]
    return out, of


def count_grams(docs: DataFrame) -> DataFrame:
    """``gram`` and, by class and half of the training rows, ``n00``, ``n01``, ``n10``, ``n11``: documents' distinct words that have it.

    ``docs``: ``text``, ``label`` (null outside the training rows) and ``half``. Grams of all documents are listed.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text"):
            doc, code, distinct = words(batch.column("text"))
            if not len(doc):
                continue
            label, half = (np.array([-1 if x is None else x for x in batch.column(c).to_pylist()]) for c in ("label", "half"))
            pair = np.unique(doc * len(distinct) + code)
            doc, code = pair // len(distinct), pair % len(distinct)
            gram, of = grams(distinct, ORDER)
            seen = np.zeros(len(distinct), dtype=bool)
            seen[code] = True
            gram, of = gram[seen[of]], of[seen[of]]
            key, where = np.unique(gram, return_inverse=True)
            counts = []
            for c in (0, 1):
                for h in (0, 1):
                    per_word = np.bincount(code[(label[doc] == c) & (half[doc] == h)], minlength=len(distinct))
                    counts.append(pa.array(np.bincount(where, weights=per_word[of], minlength=len(key)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(key), *counts], names=["gram", "n00", "n01", "n10", "n11"])

    each = docs.select("text", "label", "half").mapInArrow(run, "gram long, n00 long, n01 long, n10 long, n11 long")
    return each.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")])


def _tail(gram: str | Column, size: int) -> Column:
    return F.expr(f"{gram} & {(1 << 8 * size) - 1}L")


def shared_model(counted: DataFrame, order: int) -> DataFrame:
    """``gram`` (of ``order`` - 1 bytes) and its probability ``p``, by Kneser-Ney from continuation counts."""
    levels = {order - 1: counted.select(_tail("gram", order - 1).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))}
    for k in range(order - 2, 0, -1):
        levels[k] = levels[k + 1].select(_tail("gram", k).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    p = None
    for k in range(1, order):
        level = levels[k].withColumn("context", F.shiftright("gram", 8))
        total = level.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        joined = level.join(total, "context")
        own, back = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)), DISCOUNT * F.col("kinds")
        if p is None:
            p = joined.select("gram", ((own + back / 256) / F.col("total")).alias("p"))
        else:
            lower = p.select(F.col("gram").alias("lower"), F.col("p").alias("q"))
            p = joined.join(lower, _tail("gram", k - 1) == F.col("lower")).select("gram", ((own + back * F.col("q")) / F.col("total")).alias("p"))
    return p


def model(counted: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios of the grams seen in training (``gram``, ``r``, ``r0``, ``r1``) and of other grams by context (``context``, ...).

    ``r`` uses all training rows, ``r0`` the first half, ``r1`` the second.
    """
    named = counted.select("gram", F.shiftright("gram", 8).alias("context"), *[
        e.alias(f"{c}{v}") for c in "ab" for v, e in (("", F.expr("n00 + n01" if c == "a" else "n10 + n11")), ("0", F.col("n00" if c == "a" else "n10")), ("1", F.col("n01" if c == "a" else "n11")))
    ])
    kinds = [f"{c}{v}" for v in ("", "0", "1") for c in "ab"]
    sums = [F.sum(k).cast("double").alias(f"h_{k}") for k in kinds] + [F.sum(F.least(F.col(k).cast("double"), F.lit(DISCOUNT))).alias(f"d_{k}") for k in kinds]
    contexts = named.groupBy("context").agg(*sums).where("h_a + h_b > 0")
    trained = named.where("a + b > 0").join(contexts, "context").withColumn("lower", _tail("gram", order - 1))
    p = shared_model(counted, order).withColumnRenamed("gram", "lower")

    def log(k: str, own: bool) -> Column:
        back = F.col(f"d_{k}") + MASS
        top = F.greatest(F.col(k) - DISCOUNT, F.lit(0.0)) + back * F.col("p") if own else back
        return F.log(top / (F.col(f"h_{k}") + MASS))

    ratios = lambda own: [F.round((log(f"b{v}", own) - log(f"a{v}", own)) * UNIT).cast("int").alias(f"r{v}") for v in ("", "0", "1")]
    return trained.join(p, "lower").select("gram", *ratios(True)), contexts.select(F.col("context").alias("gram"), *ratios(False))


def _arrays(table: DataFrame) -> list[np.ndarray]:
    found = table.toArrow().combine_chunks()
    columns = [found.column(c).to_numpy() for c in ("gram", "r", "r0", "r1")]
    rank = np.argsort(columns[0])
    return [c[rank] for c in columns]


def _fetch(keys: list[np.ndarray], asked: np.ndarray) -> np.ndarray:
    """The place of each number in sorted ``keys``, or their count."""
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64)
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    return np.where(keys[at] == asked, at, len(keys))


def _peaks(doc: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
    """The features of ``n`` documents from the ratios of their words."""
    out = np.zeros((n, len(FEATURES)))
    if not len(doc):
        return out
    rank = np.lexsort((-r, doc))
    r = r[rank]
    size = np.bincount(doc, minlength=n)
    has = np.flatnonzero(size)
    begin = (np.cumsum(size) - size)[has]
    count = size[has]
    out[has, 0] = np.add.reduceat(r, begin) / count
    out[has, 1] = r[begin]
    out[has, 2] = sum(np.where(count > k, r[begin + np.minimum(k, count - 1)], 0) for k in range(3)) / np.minimum(count, 3)
    out[has, 3] = np.add.reduceat(np.maximum(r - 0.3, 0), begin) / count * 10
    out[has, 4] = r[begin + np.minimum(count - 1, count // 50)]
    return out


def _names() -> list[str]:
    return [*FEATURES, *(f"x_{f}" for f in FEATURES)]


def _schema(rows: DataFrame, keep: tuple[str, ...]) -> str:
    kinds = ", ".join(f"`{c}` {rows.select(c).schema[0].dataType.simpleString()}" for c in keep)
    return f"{kinds}, " + ", ".join(f"{c} double" for c in _names())


def _described(batch: pa.RecordBatch, keep: tuple[str, ...], doc: np.ndarray, ratios: list[np.ndarray]) -> pa.RecordBatch:
    """``keep`` and the features of a batch's documents; ``ratios`` of each word by all rows, the first half and the second half."""
    half = np.array([-1 if x is None else x for x in batch.column("half").to_pylist()])
    whole = _peaks(doc, ratios[0], batch.num_rows)
    other = _peaks(doc, np.where(half[doc] == 0, ratios[2], ratios[1]), batch.num_rows) if (half >= 0).any() else whole
    columns = [pa.array(x) for x in np.concatenate([whole, other], axis=1).T]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *_names()])


def features(docs: DataFrame, shared, order: int, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, the features of the whole model, and ``x_``-features of the model without the document's half."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, context = shared.value
        for batch in batches(rows, "text"):
            doc, code, distinct = words(batch.column("text"))
            gram, of = grams(distinct, order)
            known, around = _fetch(seen[0], gram), _fetch(context[0], gram >> 8)
            length = np.maximum(np.bincount(of, minlength=len(distinct)), 1)
            per_word = []
            for v in (1, 2, 3):
                r = np.where(known < len(seen[0]), np.append(seen[v], 0)[known], np.append(context[v], 0)[around])
                per_word.append(np.bincount(of, weights=r, minlength=len(distinct)) / (length * UNIT))
            yield _described(batch, keep, doc, [r[code] for r in per_word])

    return docs.select(*dict.fromkeys([*keep, "text", "half"])).mapInArrow(run, _schema(docs, keep))


def joined_features(docs: DataFrame, seen: DataFrame, context: DataFrame, order: int, keep: tuple[str, ...]) -> DataFrame:
    """Like :func:`features`, with the model as tables: nothing in a task grows with the corpus, only with a batch or a document."""

    def bag(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text"):
            doc, code, distinct = words(batch.column("text"))
            pair, times = np.unique(doc * max(1, len(distinct)) + code, return_counts=True)
            doc, code = pair // max(1, len(distinct)), pair % max(1, len(distinct))
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))]).astype(np.int32))
            lists = (pa.ListArray.from_arrays(offsets, x) for x in (distinct.take(pa.array(code)), pa.array(times.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *lists], names=[*carried, "words", "times"])

    def spell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "word", limit=1 << 20):
            gram, of = grams(pa.array(byte_rows(batch.column("word")), pa.binary()), order)
            number = batch.column("number").to_numpy(zero_copy_only=False)[of]
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(gram)], names=["number", "gram"])

    def describe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = batch.column("found")
                flat, size = found.flatten(), np.array([x or 0 for x in pc.list_value_length(found).to_pylist()], dtype=np.int64)
                times = flat.field("times").to_numpy(zero_copy_only=False)
                doc = np.repeat(np.repeat(np.arange(batch.num_rows), size), times)
                yield _described(batch, keep, doc, [np.repeat(flat.field(c).to_numpy(zero_copy_only=False), times) for c in ("r", "r0", "r1")])

    carried = list(dict.fromkeys([*keep, "half"]))
    kinds = ", ".join(f"`{c}` {docs.select(c).schema[0].dataType.simpleString()}" for c in carried)
    bags = docs.select(*carried, "text").mapInArrow(bag, f"{kinds}, words array<string>, times array<int>")
    bags = stage_compact(bags.withColumn("at", F.monotonically_increasing_id()), "bags")
    # a word of any length is carried once; its grams have its number
    distinct = stage_compact(bags.select(F.explode("words").alias("word")).distinct().withColumn("number", F.monotonically_increasing_id()), "words")
    spelled = distinct.mapInArrow(spell, "number long, gram long").groupBy("number", "gram").agg(F.count("*").alias("n"))
    ratios = ("r", "r0", "r1")
    known = spelled.join(seen, "gram", "left")
    # every word begins in the context of blanks, so only unknown grams ask for theirs
    unknown = known.where("r IS NULL").select("number", "gram", "n").withColumn("context", F.shiftright("gram", 8))
    around = unknown.join(context.withColumnRenamed("gram", "context"), "context").select("number", "n", *ratios)
    sums = known.where("r IS NOT NULL").select("number", "n", *ratios).unionByName(around).groupBy("number").agg(*[F.sum(F.col("n") * F.col(r)).alias(r) for r in ratios])
    size = (F.octet_length("word") + 1) * F.lit(UNIT)
    per_word = distinct.join(sums, "number", "left").select("word", *[(F.coalesce(F.col(r), F.lit(0)).cast("double") / size).alias(r) for r in ratios])
    asked = bags.select("at", F.explode(F.arrays_zip("words", "times")).alias("x")).select("at", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    each = asked.join(per_word, "word").groupBy("at").agg(F.collect_list(F.struct("times", *ratios)).alias("found"))
    return bags.select("at", *carried).join(each, "at", "left").drop("at").mapInArrow(describe, _schema(docs, keep))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression, by Newton's method on scaled features."""
    if not len(y):
        return np.zeros(x.shape[1]), 0.0
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(y))]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for each row; rows whose remainder is 0 are never learnt from."""
    spark = docs.sparkSession
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = stage(known.where(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("label").alias("label")), "labels")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(small_side(known), "doc_id", "left")
    rows = rows.withColumn("half", F.when(F.col("label").isNotNull(), remainder(F.col("doc_id")) % 2))
    counted = stage(count_grams(rows), "grams")
    seen, context = (stage(x, "ratios") for x in model(counted, ORDER))
    keep = ("doc_id", "label", "half")
    if seen.count() + context.count() <= ENTRIES:
        found = features(rows, spark.sparkContext.broadcast((_arrays(seen), _arrays(context))), ORDER, keep)
    else:
        found = joined_features(rows, seen, context, ORDER, keep)
    found = stage(found, "features")
    one = F.min(F.struct("label", *[f"x_{f}" for f in FEATURES])).alias("one")  # a repeated id counts once
    sample = found.where("label IS NOT NULL").groupBy("doc_id").agg(one).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CURVE_ROWS).select("one.*").toPandas()
    weights, offset = fit_curve(sample.iloc[:, 1:].to_numpy(dtype=float), sample["label"].to_numpy(dtype=float))
    total = F.lit(offset)
    for f, w in zip(FEATURES, weights.tolist()):
        total = total + F.col(f) * w
    p = 1 / (1 + F.exp(-total))
    return found.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), p.alias("score"), (p >= 0.5).cast("int").alias("predicted"))
