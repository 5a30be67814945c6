"""Token ids on disk: a concatenated id array with document boundaries in Elias-Fano code.

The boundaries of a chunk are a rising sequence of n + 1 offsets up to u. Each keeps its lowest ``log2(u / n)`` bits in a packed array;
the rest is written in unary into a bit array of at most 3 n bits. ``select`` finds the i-th boundary from 32-bit samples of every 64th set
bit, so a document costs about ``2 + log2(u / n)`` bits and no table of 64-bit offsets exists.

A table of chunks is the file format: Parquet rows, in a store that Spark reaches, each with a chunk's number, its ids, the number of ids and the
encoded bytes. Chunks are in ascending id order. A null text is empty and still gets the end token. Null ids come first. Repeated ids and rows are
separate documents, in the order of the scan. A document is never cut, however long. An empty table gives no chunks. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from aqspark.llm.common import batches, new_path, prefix, small_side
from aqspark.llm.tokens import encoder

MAGIC, SAMPLE = b"IDEF0001", 64
_HEAD = struct.Struct("<8sBBIQI")  # magic, bytes of an id, low bits, documents, ids, samples
CHUNK_IDS = 2_000_000
#: Bytes of text in a range of ids, which one task sorts and encodes.
RANGE_BYTES = 128 << 20


class Boundaries:
    """Elias-Fano coded offsets of ``n`` documents: ``select(i)`` is where document i begins, ``select(n)`` the number of ids."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, dtype=np.uint8), np.frombuffer(high, dtype=np.uint8)
        self.samples = np.frombuffer(samples, dtype="<u4")

    @staticmethod
    def encode(offsets: np.ndarray) -> "Boundaries":
        n, top = len(offsets) - 1, int(offsets[-1])
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = (offsets[:, None] >> np.arange(low_bits)) & 1
        place = (offsets >> low_bits) + np.arange(n + 1)
        high = np.zeros(int(place[-1]) + 1, dtype=np.uint8)
        high[place] = 1
        packed = np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return Boundaries(n, low_bits, packed, np.packbits(high, bitorder="little").tobytes(), place[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
        return (((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        if left:
            byte = (at + 1) >> 3
            skip = (at + 1) & 7  # bits of that byte that lie before
            while True:
                bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
                bits[:skip] = 0
                ones = np.flatnonzero(bits)
                if left <= len(ones):
                    at = byte * 8 + int(ones[left - 1])
                    break
                left, byte, skip = left - len(ones), byte + 64, 0
        return ((at - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def span(self, a: int, b: int) -> np.ndarray:
        """Boundaries ``a`` to ``b``, decoded from the sample before the first to the one after the last."""
        k, end = a // SAMPLE, b // SAMPLE + 1
        at = int(self.samples[k])
        stop = int(self.samples[end]) if end < len(self.samples) else 8 * len(self.high)
        place = np.flatnonzero(np.unpackbits(self.high[at >> 3 : (stop >> 3) + 1], bitorder="little")) + (at >> 3 << 3)
        place = place[np.searchsorted(place, at) :][a - k * SAMPLE : b - k * SAMPLE + 1]
        i = np.arange(a, b + 1)
        return ((place - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        return self.span(0, self.n)


def encode_chunk(ids: np.ndarray, offsets: np.ndarray, id_bytes: int) -> bytes:
    edge = Boundaries.encode(offsets)
    head = _HEAD.pack(MAGIC, id_bytes, edge.low_bits, edge.n, len(ids), len(edge.samples))
    sizes = struct.pack("<II", len(edge.low), len(edge.high))
    return b"".join([head, sizes, edge.samples.tobytes(), edge.low.tobytes(), edge.high.tobytes(), ids.astype(f"<u{id_bytes}").tobytes()])


def decode_chunk(data: bytes) -> tuple[Boundaries, np.ndarray]:
    magic, id_bytes, low_bits, n, n_ids, n_samples = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    n_low, n_high = struct.unpack_from("<II", data, _HEAD.size)
    at = _HEAD.size + 8
    cuts = np.cumsum([at, 4 * n_samples, n_low, n_high]).tolist()
    edge = Boundaries(n, low_bits, data[cuts[1] : cuts[2]], data[cuts[2] : cuts[3]], data[cuts[0] : cuts[1]])
    return edge, np.frombuffer(data, dtype=f"<u{id_bytes}", count=n_ids, offset=cuts[3])


def write_ids(docs: DataFrame, tokenizer: str, path: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, chunk_ids: int = CHUNK_IDS) -> str:
    """Encode every text, append ``end_id``, write the chunks in ascending id order, and return the path."""
    spark = docs.sparkSession
    path = path or new_path(spark, "ids")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        id_bytes = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
        waiting, held = [], 0

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate([x[1] for x in waiting])
            sizes = np.concatenate([x[2] for x in waiting])
            names = [d for x in waiting for d in x[0]]
            data = encode_chunk(ids, prefix(sizes), id_bytes)
            columns = [pa.array([part]), pa.array([number]), pa.array([names], pa.list_(pa.int64())), pa.array([len(ids)]), pa.array([data], pa.large_binary() if len(data) >> 31 else pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "number", "doc_ids", "n_ids", "data"])

        for batch in batches(rows, "text", limit=8 << 20):
            ids, offsets = encode.encode(batch.column("text"))
            sizes = np.diff(offsets) + 1
            ended = np.full(len(ids) + len(sizes), end_id, dtype=np.uint32)
            inside = np.ones(len(ended), dtype=bool)
            inside[prefix(sizes)[1:] - 1] = False
            ended[inside] = ids
            names = batch.column("doc_id").to_pylist()
            edges, a = prefix(sizes), 0
            while a < len(sizes):
                b = max(a + 1, int(np.searchsorted(edges, edges[a] + chunk_ids - held, side="right")) - 1)
                waiting.append((names[a:b], ended[edges[a] : edges[b]], sizes[a:b]))
                held += int(edges[b] - edges[a])
                a = b
                if held >= chunk_ids or a < len(sizes):
                    yield chunk()
                    waiting, held, number = [], 0, number + 1
        if waiting:
            yield chunk()

    # repeated ids may be many: the place in the scan spreads them over the ranges too
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("at"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "at").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "at")
    found = ordered.select("doc_id", "text").mapInArrow(run, "part long, number long, doc_ids array<long>, n_ids long, data binary")
    found.write.option("compression", "zstd").parquet(path)
    return path


def read_ids(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and the ``ids`` as bytes.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for before, names, data in zip(*(batch.column(c).to_pylist() for c in ("before", "doc_ids", "data"))):
                edge, ids = decode_chunk(data)
                step = max(1, (4 << 20) * edge.n // max(1, len(ids)))
                for a in range(0, edge.n, step):
                    b = min(edge.n, a + step)
                    offsets = edge.span(a, b)
                    raw = ids[offsets[0] : offsets[-1]].astype("<u4").tobytes()
                    at = ((offsets - offsets[0]) * 4).tolist()
                    columns = [pa.array(names[a:b], pa.int64()), pa.array(offsets[:-1] + before), pa.array(np.diff(offsets)), pa.array([raw[x:y] for x, y in zip(at, at[1:])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return _placed(spark, path).mapInArrow(run, _READ)


def read_documents(spark, path: str, doc_ids: list[int]) -> DataFrame:
    """Like :func:`read_ids` for a few documents, each found by ``select``; other chunks are not decoded."""
    wanted = frozenset(doc_ids)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for before, names, data in zip(*(batch.column(c).to_pylist() for c in ("before", "doc_ids", "data"))):
                edge, ids = decode_chunk(data)
                for i in (i for i, name in enumerate(names) if name in wanted):
                    a, b = edge.select(i), edge.select(i + 1)
                    columns = [pa.array([names[i]], pa.int64()), pa.array([a + before]), pa.array([b - a]), pa.array([ids[a:b].astype("<u4").tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    has = F.exists("doc_ids", lambda x: x.isin(list(wanted)))
    return _placed(spark, path).where(has).mapInArrow(run, _READ)


_READ = "doc_id long, start long, n_tokens long, ids binary"


def _placed(spark, path: str) -> DataFrame:
    """The chunks with ``before``, the number of ids of all chunks before."""
    chunks = spark.read.schema("part long, number long, doc_ids array<long>, n_ids long, data binary").parquet(path)
    # sums before each part (as many rows as tasks wrote), then before each chunk of the part
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("parts_before"))
    own = chunks.select("part", "number", (F.sum("n_ids").over(W.partitionBy("part").orderBy("number")) - F.col("n_ids")).alias("own_before"))
    starts = own.join(parts, "part").select("part", "number", (F.col("parts_before") + F.col("own_before")).alias("before"))
    return chunks.join(small_side(starts), ["part", "number"]).select("before", "doc_ids", "data")
