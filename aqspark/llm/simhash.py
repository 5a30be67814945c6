"""Near-duplicates by SimHash fingerprints, found with the general pigeonhole principle.

A fingerprint has 64 bits. Two texts are linked if their fingerprints differ in at most ``radius`` bits. The bits are dealt into
parts, correlated ones into the same part. A query gets a threshold for each part, -1 to skip it, such that the thresholds plus one
sum to ``radius + 1``; then every fingerprint within the radius is within the threshold in some part. The thresholds are
chosen for each fingerprint by dynamic programming over estimated candidates, so that crowded part values are skipped.

Nulls, empty texts and texts of white space have no words and the fingerprint zero, which is linked like any other. Repeated rows
share a fingerprint and are linked as one node. A null ``doc_id`` is never the smallest of its component unless it is alone. An
empty table gives an empty result. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from aqspark.llm.common import batches, byte_rows, stage, stage_compact, unsigned_hex
from aqspark.llm.graph import components

BITS, RADIUS, WORDS, SEED = 64, 3, 3, 42
#: Candidates are estimated from this many leading bits of a part.
ESTIMATE_BITS = 16
_BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint: each bit is set if it is set in over half of the shingles' XXH64 values."""
    parts = text.lower().split()  # both only know ASCII letters and white space
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, n)
    first, last = starts[: n - k + 1].tolist(), ends[k - 1 :].tolist()
    total, ones, digest = len(first), np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for at in range(0, total, _BLOCK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[at : at + _BLOCK], last[at : at + _BLOCK])])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` for each row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text):
            found = pa.array([fingerprint(x) for x in byte_rows(batch.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], names=[*keep, "fp"])

    schema = ", ".join(f"`{c}` {docs.select(c).schema[0].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text).mapInArrow(run, f"{schema}, fp long")


# ---- dealing the bits into parts -----------------------------------------------------------------


def part_count(n: int, radius: int = RADIUS) -> int:
    """The number of parts with the fewest probes and expected candidates for ``n`` evenly spread fingerprints."""

    def cost(m: int) -> float:
        width, extra = BITS / m, radius + 1
        depth = [extra // m + (i < extra % m) for i in range(m)]  # thresholds plus one, spread evenly
        probes = sum(sum(comb(round(width), u) for u in range(t)) for t in depth)
        return probes * (1 + n / 2**width)

    return min(range(2, radius + 2), key=cost)


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, as a matrix; on the diagonal how often one is set. 4,096 sums, combined in the tasks."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for batch in rows:
            v = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(v), _BLOCK):
                x = _bit_rows(v[at : at + _BLOCK]).astype(np.float32)
                both += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(both.ravel())], names=["cell", "n"])

    cells = fps.select("fp").mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for r in cells:
        out[r["cell"]] = r["n"]
    return out.reshape(BITS, BITS)


def _bit_rows(v: np.ndarray) -> np.ndarray:
    """Column b holds bit b, counted from the lowest."""
    return np.unpackbits(v.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def deal_bits(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal width; each grows from the bit with the strongest remaining correlations."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (corr[b, part].sum(), -b)))
            left.remove(part[-1])
        parts.append(part)
    return parts


def part_values(v: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of a part, the first in the lowest place."""
    out, u = np.zeros(len(v), dtype=np.int64), v.astype(np.int64).view(np.uint64)
    for place, b in enumerate(part):
        out |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << place
    return out


def masks(width: int, depth: int) -> np.ndarray:
    """All differences of at most ``depth`` bits."""
    return np.array([sum(1 << b for b in bits) for k in range(depth + 1) for bits in combinations(range(width), k)], dtype=np.int64)


# ---- thresholds -----------------------------------------------------------------------------------


def estimates(histogram: np.ndarray, width: int, radius: int = RADIUS) -> np.ndarray:
    """Row t: the candidates expected within t bits, by the leading bits of a part value; the bits beyond count as even."""
    lead = int(len(histogram)).bit_length() - 1
    rest, index = width - lead, np.arange(len(histogram))
    shells, done = [], 0
    for t in range(radius + 1):
        own = masks(lead, t)
        shells.append(sum((histogram[index ^ x] for x in own[done:]), np.zeros(len(histogram))))
        done = len(own)
    inside = lambda k: sum(comb(rest, u) for u in range(k + 1)) / 2**rest
    return np.stack([sum(shells[s] * inside(t - s) for s in range(t + 1)) for t in range(radius + 1)])


def allocate(values: list[np.ndarray], widths: list[int], expected: list[np.ndarray], radius: int = RADIUS) -> np.ndarray:
    """Thresholds plus one of each part (rows) for each fingerprint (columns), which sum to ``radius + 1`` at the least cost."""
    n, m, total = len(values[0]), len(values), radius + 1
    best = np.full((total + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, total + 1, n), dtype=np.int8)
    for i in range(m):
        lead = values[i] & (expected[i].shape[1] - 1)
        cost = np.zeros((total + 1, n))
        for t in range(total):
            cost[t + 1] = expected[i][t][lead] + sum(comb(widths[i], u) for u in range(t + 1))
        after = np.full_like(best, np.inf)
        for s in range(total + 1):
            for t in range(s + 1):
                value = best[s - t] + cost[t]
                better = value < after[s]
                after[s][better], choice[i, s][better] = value[better], t
        best = after
    out, s, column = np.zeros((m, n), dtype=np.int8), np.full(n, total), np.arange(n)
    for i in reversed(range(m)):
        out[i] = choice[i, s, column]
        s = s - out[i]
    return out


# ---- links ----------------------------------------------------------------------------------------


def links(fps: DataFrame, radius: int = RADIUS, parts_wanted: int | None = None) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints within ``radius`` bits, each at least once; ``fps``: distinct values in ``fp``."""
    spark, n = fps.sparkSession, fps.count()
    m = parts_wanted or part_count(n, radius)
    parts = deal_bits(bit_counts(fps), n, m)
    widths = [len(p) for p in parts]

    def index(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            v = batch.column("fp").to_numpy(zero_copy_only=False)
            for i, part in enumerate(parts):
                yield _rows(np.full(len(v), i), part_values(v, part), v)

    indexed = fps.select("fp").mapInArrow(index, "part int, value long, fp long")
    # the histogram has at most m * 2**ESTIMATE_BITS rows, however many fingerprints there are
    lead = [min(w, ESTIMATE_BITS) for w in widths]
    leading = F.col("value").bitwiseAND(F.element_at(F.array(*[F.lit((1 << x) - 1) for x in lead]), F.col("part") + 1))
    histogram = [np.zeros(1 << x) for x in lead]
    for r in indexed.groupBy("part", leading.alias("lead")).count().collect():
        histogram[r["part"]][r["lead"]] = r["count"]
    shared = spark.sparkContext.broadcast([estimates(h, w, radius).astype(np.float32) for h, w in zip(histogram, widths)])

    def probe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            v = batch.column("fp").to_numpy(zero_copy_only=False)
            values = [part_values(v, p) for p in parts]
            depth = allocate(values, widths, shared.value, radius)
            for i in range(m):
                for t in range(1, radius + 2):
                    own = np.flatnonzero(depth[i] == t)
                    differences = masks(widths[i], t - 1)
                    step = max(1, (1 << 18) // len(differences))
                    for at in range(0, len(own), step):
                        rows_ = own[at : at + step]
                        near = (values[i][rows_][:, None] ^ differences[None, :]).ravel()
                        yield _rows(np.full(len(near), i), near, np.repeat(v[rows_], len(differences)))

    left = fps.select("fp").mapInArrow(probe, "part int, value long, fp long").withColumnRenamed("fp", "a")
    right = indexed.withColumnRenamed("fp", "b")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return left.join(right, (left["part"] == right["part"]) & (left["value"] == right["value"]) & near).select("a", "b")


def _rows(part: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(value), pa.array(fp)], names=["part", "value", "fp"])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Each row's id as ``doc_id``, its ``fingerprint`` in hex and ``component_id``, the smallest id that links reach."""
    found = stage(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), "fingerprints")
    return _grouped(found, radius).select("doc_id", unsigned_hex("fp").alias("fingerprint"), "component_id")


def _grouped(found: DataFrame, radius: int) -> DataFrame:
    """``found`` (with ``doc_id``, ``fp``), ``component_id`` and ``component``, a fingerprint of it; ids may be repeated or null, so only that tells components apart."""
    nodes = stage(found.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    pairs = stage(links(nodes, radius), "links")
    linked = components(pairs)
    of = nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", "smallest", F.coalesce("component", "fp").alias("component"))
    least = of.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return found.join(of.join(least, "component").select("fp", "component_id", "component"), "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: the one with the smallest id, of repeated ids one."""
    whole = stage_compact(docs.select(F.monotonically_increasing_id().alias("at"), F.struct("*").alias("row")), "rows")
    narrow = whole.select("at", F.col(f"row.`{doc_id}`").alias("doc_id"), F.col(f"row.`{text}`").alias("text"))
    found = stage(fingerprints(narrow, keep=("at", "doc_id")), "fingerprints")
    kept = _grouped(found, radius).groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("first"))
    return whole.join(kept.select(F.col("first.at").alias("at")), "at", "left_semi").select("row.*")
