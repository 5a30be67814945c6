"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

All grades share one weight per hashed feature; ordered thresholds cut the latent score into grades: P(grade > k) = 1 / (1 + exp(threshold_k - w x)).
The model gives the expected grade and the tail probability P(grade >= ``least``), by which documents are selected.

Features of a text are the shares of its words, of the words' shapes (letters, capitals, digits and other signs with runs shortened), of pairs of shapes and of words
that repeat the one before, hashed into ``DIMENSIONS`` places, and a few figures of length and variety. The whole text is read.

The model is fitted on ``SAMPLE_ROWS`` rated rows at most, those with the smallest hashes of their ids; everything else covers all rows. Null ratings are
ignored; of several ratings of an id the lowest counts. A null or empty text has no words and is scored by the thresholds and its length features. Without ratings, or with one grade
alone, nothing can be told apart: the tail probability is 1 and every document is kept. Repeated rows are scored alike. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from aqspark.llm.common import batches, byte_rows, judged

DIMENSIONS, FIGURES = 1 << 15, 8
#: The documented bound of the rated rows that are fitted on.
SAMPLE_ROWS = 20_000
RIDGE, STEPS = 1e-4, 60
_SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"))
_RUN = re.compile(rb"(.)\1+", re.S)
_SPACES = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))


def shape(word: bytes) -> bytes:
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return _RUN.sub(rb"\1", word)


def _place(kind: bytes, value: bytes) -> int:
    return FIGURES + xxhash.xxh64_intdigest(kind + value, 7) % (DIMENSIONS - FIGURES)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of each feature of a batch of texts."""
    raw = byte_rows(column)
    n = len(raw)
    split = pc.split_pattern(pa.array([x.translate(_SPACES) for x in raw], pa.binary()).cast(pa.string()), " ")
    size = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    code, doc = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(n), size)
    spelled = [x.encode() for x in coded.dictionary.to_pylist()]
    real = np.array([bool(x) for x in spelled], dtype=bool)[code] if len(code) else np.zeros(0, dtype=bool)
    code, doc = code[real], doc[real]
    shapes: dict[bytes, int] = {}
    of = np.array([shapes.setdefault(shape(x), len(shapes)) for x in spelled], dtype=np.int64)
    names = list(shapes)
    word_place = np.array([_place(b"w", x.lower()) for x in spelled], dtype=np.int64)
    shape_place = np.array([_place(b"s", x) for x in names], dtype=np.int64)
    count = np.bincount(doc, minlength=n)
    share = 1 / np.maximum(count, 1)
    next_same = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, dtype=bool)
    first, second = code[:-1][next_same], code[1:][next_same]
    pair = of[first] * len(names) + of[second]
    kinds, where = np.unique(pair, return_inverse=True)
    pair_place = np.array([_place(b"p", names[k // len(names)] + b" " + names[k % len(names)]) for k in kinds.tolist()], dtype=np.int64)
    rows = np.concatenate([doc, doc, doc[:-1][next_same]])
    places = np.concatenate([word_place[code], shape_place[of[code]], pair_place[where]]) if len(doc) else np.zeros(0, dtype=np.int64)
    key, value = np.unique(rows * DIMENSIONS + places, return_inverse=True)
    total = np.bincount(value, weights=share[rows], minlength=len(key))
    distinct = np.bincount(np.unique(doc * max(1, len(spelled)) + code) // max(1, len(spelled)), minlength=n)
    repeats = np.bincount(doc[:-1][next_same][first == second], minlength=n)
    letters = np.bincount(doc, weights=np.array([len(x) for x in spelled], dtype=float)[code], minlength=n) if len(doc) else np.zeros(n)
    figures = np.stack([np.ones(n), np.log1p(count) / 5, np.log1p(count) ** 2 / 25, distinct * share, np.sqrt(distinct * share), repeats * share * 3, letters * share / 10, (count == 0) * 1.0], axis=1)
    return (
        np.concatenate([key // DIMENSIONS, np.repeat(np.arange(n), FIGURES)]),
        np.concatenate([key % DIMENSIONS, np.tile(np.arange(FIGURES), n)]),
        np.concatenate([np.sqrt(total), figures.ravel()]),
    )


# ---- the model ------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def cuts(steps: np.ndarray) -> np.ndarray:
    """Ordered thresholds from a first one and logarithms of the gaps."""
    return np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


def loss(theta: np.ndarray, row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, weight: np.ndarray, top: int) -> tuple[float, np.ndarray]:
    """Weighted mean negative log-likelihood with a ridge, and its gradient; ``theta``: weights, then ``top`` threshold steps."""
    w, steps = theta[:DIMENSIONS], theta[DIMENSIONS:]
    edge = np.concatenate([[-np.inf], cuts(steps), [np.inf]])
    latent = np.bincount(row, weights=value * w[place], minlength=len(grade))
    low, high = _sigmoid(edge[grade] - latent), _sigmoid(edge[grade + 1] - latent)
    low[grade == 0], high[grade == top] = 0, 1
    p = np.maximum(high - low, 1e-12)
    slope_low, slope_high = low * (1 - low), high * (1 - high)
    by_latent = weight * (slope_high - slope_low) / p  # derivative of -log p
    g = np.zeros_like(theta)
    g[:DIMENSIONS] = np.bincount(place, weights=value * by_latent[row], minlength=DIMENSIONS) + RIDGE * w
    by_cut = np.bincount(grade, weights=-weight * slope_high / p, minlength=top + 1)[:top]
    by_cut[: top] += np.bincount(grade, weights=weight * slope_low / p, minlength=top + 1)[1 : top + 1]
    after = np.cumsum(by_cut[::-1])[::-1]
    g[DIMENSIONS:] = after * np.concatenate([[1.0], np.exp(steps[1:])])
    return float(-(weight * np.log(p)).sum() + RIDGE / 2 * (w**2).sum()), g


def fit(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray) -> np.ndarray | None:
    """Parameters by limited-memory quasi-Newton steps; None if there is one grade alone."""
    top = int(grade.max()) if len(grade) else 0
    if len(np.unique(grade)) < 2:
        return None
    weight = np.full(len(grade), 1 / len(grade))
    theta = np.zeros(DIMENSIONS + top)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=top + 1))[:top] / len(grade), 1e-3, 1 - 1e-3)
    edge = np.log(share / (1 - share))
    theta[DIMENSIONS:] = np.concatenate([edge[:1], np.log(np.maximum(np.diff(edge), 1e-2))])
    run = lambda t: loss(t, row, place, value, grade, weight, top)
    f, g = run(theta)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        d, used = -g, []
        for s, y in reversed(pairs):
            a = s @ d / (s @ y)
            used.append(a)
            d = d - a * y
        if pairs:
            s, y = pairs[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(used)):
            d = d + (a - y @ d / (s @ y)) * s
        step, slope = (1.0 if pairs else 1.0 / max(1e-9, np.abs(g).sum())), g @ d
        while step > 1e-10:
            f1, g1 = run(theta + step * d)
            if f1 <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = step * d, g1 - g
        theta, small, f, g = theta + s, f - f1 < 1e-7, f1, g1
        if s @ y > 1e-12:
            pairs = [*pairs[-9:], (s, y)]
        if small:
            break
    return theta


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade", rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Fit on a bounded sample of the rated rows, in one task; ``ratings`` holds whole grades from 0."""
    known = ratings.select(F.col(doc_id).alias("rated"), F.col(grade).cast("int").alias("grade")).where("rated IS NOT NULL AND grade IS NOT NULL")
    chosen = known.groupBy("rated").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("rated"), "rated").limit(rows)
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sample = whole.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated")).select("rated", "grade", "text")  # at most ``rows`` pairs are sent
    # one text of each rated id, the same in every run; copies are combined before they are shuffled
    sample = sample.groupBy("rated", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("rated", "grade", "one.text")

    def sparse(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(batches_, "text"):
            row, place, value = text_features(batch.column("text"))
            rank = np.argsort(row, kind="stable")
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32))
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x[rank].astype(t))) for x, t in ((place, np.int32), (value, np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("rated"), batch.column("grade"), *lists], names=["rated", "grade", "place", "value"])

    def solve(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches_ if b.num_rows]
        if got:
            each = pa.Table.from_batches(got)
            n = pc.list_value_length(each["place"]).to_numpy()
            flat = lambda c: pc.list_flatten(each[c]).to_numpy()
            theta = fit(np.repeat(np.arange(len(n), dtype=np.int32), n), flat("place"), flat("value"), each["grade"].to_numpy().astype(np.int64))
            if theta is not None:
                yield pa.RecordBatch.from_arrays([pa.array([theta], pa.list_(pa.float64()))], names=["theta"])

    kind = sample.schema["rated"].dataType.simpleString()
    vectors = sample.mapInArrow(sparse, f"rated {kind}, grade int, place array<int>, value array<float>")
    # in the order of the ids, so that sums come out alike in every run
    found = vectors.repartition(1).sortWithinPartitions("rated").mapInArrow(solve, "theta array<double>").collect()
    return np.array(found[0]["theta"]) if found else None


def _chances(theta: np.ndarray, texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The probabilities of more than each grade, and of grade ``least`` or better."""
    w, edge = theta[:DIMENSIONS], cuts(theta[DIMENSIONS:])
    row, place, value = text_features(texts)
    latent = np.bincount(row, weights=value * w[place], minlength=len(texts))
    above = _sigmoid(latent[:, None] - edge[None, :])
    return above, above[:, least - 1] if least <= len(edge) else np.zeros(len(latent))


def predict(docs: DataFrame, theta: np.ndarray | None, text: str = "text", keep: Column | str = "doc_id", name: str = "doc_id", least: int = 1) -> DataFrame:
    """``name``, ``expected_grade`` and ``tail`` for each row. ``tail``: the probability of grade ``least`` or better."""
    rows = docs.select((F.col(keep) if isinstance(keep, str) else keep).alias(name), F.col(text).cast("string").alias("text"))
    if theta is None:
        return rows.select(name, F.lit(None).cast("double").alias("expected_grade"), F.lit(1.0).alias("tail"))
    shared = docs.sparkSession.sparkContext.broadcast(theta)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(batches_, "text"):
            above, tail = _chances(shared.value, batch.column("text"), least)
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.array(above.sum(axis=1)), pa.array(tail)], names=[name, "expected_grade", "tail"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{name}` {kind}, expected_grade double, tail double")


def select(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade", least: int = 1, share: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, whose probability of grade ``least`` or better is at least ``share``."""
    theta = train(docs, ratings, doc_id, text, grade)
    if theta is None:
        return docs.where(F.lit(share <= 1))
    shared = docs.sparkSession.sparkContext.broadcast(theta)
    return docs.where(judged(docs, text, "boolean", lambda x: pa.array(_chances(shared.value, x, least)[1] >= share)))


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from the label table: 0 poor, 1 sound but toxic, 2 sound. A null quality is no rating; a null toxicity counts as none."""
    sound, toxic = F.col("quality") > 0, F.coalesce(F.col("toxic") > 0, F.lit(False))
    return labels.select("doc_id", F.when(F.col("quality").isNull(), None).when(~sound, 0).when(toxic, 1).otherwise(2).alias("grade"))
