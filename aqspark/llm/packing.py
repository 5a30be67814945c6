"""Packing by concatenating and cutting into windows of a fixed number of tokens.

Pass one encodes each text once, appends an end token and writes the ids with the task's number. Prefix sums over the tasks' token
totals then give every document its offset in the concatenation. Pass two cuts documents where a window ends: a boundary record per piece tells
which part of the document lies where in which sequence. Only the last sequence can have padding.

The order is that of the scan. A null or empty text is a document of one token, the end. A document of any length is cut into
consecutive pieces. Repeated ids and rows are separate documents. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from aqspark.llm.common import batches, prefix, small_side, stage_compact
from aqspark.llm.tokens import encoder

LENGTH = 2048


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1) -> DataFrame:
    """Written table of ``part``, ``before`` (tokens of the part before the document), ``doc_id``, ``n`` and ``ids`` (little-endian bytes)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        kind = _kind(max(encode.size, end_id + 1))
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in batches(rows, "text", limit=8 << 20):
            ids, offsets = encode.encode(batch.column("text"))
            sizes, raw = np.diff(offsets) + 1, ids.astype(kind).tobytes()
            cut = (offsets * np.dtype(kind).itemsize).tolist()
            columns = [
                pa.array(np.full(len(sizes), part, dtype=np.int64)),
                pa.array(before + prefix(sizes)[:-1]),
                batch.column("doc_id"),
                pa.array(sizes),
                pa.array([raw[a:b] + end for a, b in zip(cut, cut[1:])], pa.binary()),
            ]
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(columns, names=["part", "before", "doc_id", "n", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stage_compact(rows.mapInArrow(run, "part long, before long, doc_id long, n long, ids binary"), "encoded")


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """A row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    whole = encoded(docs, tokenizer, doc_id, text, end_id)
    # as many rows as there were tasks
    totals = whole.groupBy("part").agg(F.sum("n").alias("total"))
    parts = totals.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("parts_before"))
    placed = whole.join(small_side(parts), "part").select("doc_id", (F.col("parts_before") + F.col("before")).alias("place"), "n", "ids")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "ids", limit=8 << 20):
            place, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "n"))
            pieces = (place + n - 1) // length - place // length + 1
            doc, nth = np.repeat(np.arange(len(n)), pieces), np.arange(pieces.sum()) - np.repeat(prefix(pieces)[:-1], pieces)
            sequence = place[doc] // length + nth
            begin = np.maximum(sequence * length, place[doc])
            size = np.minimum((sequence + 1) * length, place[doc] + n[doc]) - begin
            start = begin - place[doc]
            raw = batch.column("ids").to_pylist()
            width = np.array(list(map(len, raw))) // n
            cut = [np.frombuffer(raw[d], dtype=f"<u{width[d]}", count=k, offset=s * width[d]).astype("<u4").tobytes() for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist())]
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(cut, pa.binary()), pa.array(n[doc]), pa.array(sequence), pa.array(begin - sequence * length)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
