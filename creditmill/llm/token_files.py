"""Token ids as binary segments: a concatenated id array with Elias-Fano encoded document boundaries.

A segment holds consecutive documents in key order:

    magic "EFT1" | u32 documents, of these u32 without key | u64 tokens | u64 tokens of the shard before the segment
    | u8 bytes an id | boundaries | keys (less the smallest) | i64 smallest key | ids

Boundaries and keys are non-decreasing, so both are Elias-Fano sequences: n values below u take about 2 + log2(u / n)
bits each, where a table of 64-bit offsets takes 64. Segments are rows of a table that Spark writes (one shard per
partition, in key order), so a lost executor's shard is written again and no half file is ever seen.
"""

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill.llm.bpe import Encoder
from creditmill.llm.common import per_worker
from creditmill.session import scratch_path, shuffle_width

MAGIC = b"EFT1"
SEGMENT_TOKENS = 1 << 20
SAMPLE = 256  # every so many ones of the upper bits have their place stored
READ_DOCS = 8 * SAMPLE  # documents that are read at a time
SEGMENT = "shard int, segment int, n_docs int, n_tokens bigint, data binary"


class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"),
                   np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _low(self, at: np.ndarray) -> np.ndarray:
        """Low bits of the values at the given places."""
        out = np.zeros(len(at), np.uint64)
        for b in range(self.low_bits):
            bit = at * self.low_bits + b
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """Value i: the sample before it gives where in the upper bits to start counting ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        seen = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        seen[:at & 7] = 0
        while left >= (n := int(seen.sum())):
            left, byte = left - n, byte + 1
            seen = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        place = byte * 8 + int(np.flatnonzero(seen)[left])
        return (place - i) << self.low_bits | int(self._low(np.array([i]))[0])

    def select_range(self, i: int, j: int) -> np.ndarray:
        """Values i to j - 1 at once: the samples around them bound the stretch of upper bits that holds their ones."""
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j))
        if i == j:
            return np.array([], np.int64)
        first, last = i // SAMPLE, (j - 1) // SAMPLE + 1
        start = int(self.samples[first])
        end = (int(self.samples[last]) >> 3) + 1 if last < len(self.samples) else len(self.high)
        seen = np.unpackbits(self.high[start >> 3:end], bitorder="little")
        seen[:start & 7] = 0
        at = np.arange(i, j)
        ones = np.flatnonzero(seen)[at - first * SAMPLE] + (start >> 3) * 8
        upper = (ones - at).astype(np.uint64) << np.uint64(self.low_bits)
        return (upper | self._low(at)).astype(np.int64)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple["EliasFano", int]:
        """The sequence stored at `at`, and where it ends."""
        n, low_bits, low, high, samples = struct.unpack_from("<QBQQQ", data, at)
        at += struct.calcsize("<QBQQQ")
        parts = []
        for kind, count in (("u1", low), ("u1", high), ("<u4", samples)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts), at


def pack_segment(keys: list, ids: list[bytes], before: int) -> bytes:
    """Documents in key order, keys without value last; ids come as little-endian unsigned 32-bit integers."""
    lengths = np.array([len(i) // 4 for i in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(flat) or flat.max() < 1 << 16 else 4
    known = np.array([k for k in keys if k is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = EliasFano.of(np.concatenate([[0], np.cumsum(lengths)])).to_bytes()
    named = EliasFano.of(known.astype(np.uint64) - np.int64(least).astype(np.uint64)).to_bytes()
    head = struct.pack("<4sIIQQB", MAGIC, len(keys), len(keys) - len(known), len(flat), before, width)
    return head + bounds + named + struct.pack("<q", least) + flat.astype(f"<u{width}").tobytes()


class Segment:
    """Reads a packed segment; a document's ids are sliced out by its boundaries, and these come from select."""

    def __init__(self, data: bytes):
        magic, self.n_docs, self.no_key, self.n_tokens, self.before, width = struct.unpack_from("<4sIIQQB", data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.bounds, at = EliasFano.read(data, struct.calcsize("<4sIIQQB"))
        self.named, at = EliasFano.read(data, at)
        self.least = struct.unpack_from("<q", data, at)[0]
        self.ids = np.frombuffer(data, f"<u{width}", self.n_tokens, at + 8)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]

    def keys(self, i: int, j: int) -> list:
        """Keys of documents i to j - 1; those without key come last."""
        known = min(j, self.named.n)
        found = [k + self.least for k in self.named.select_range(min(i, known), known).tolist()]
        return found + [None] * (j - i - len(found))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id",
                      segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every whole text, append `end_id`, and write segments in ascending key order.

    Null and empty texts have just the end id. Null keys come last; rows that share a key are ordered by their ids. Other
    columns are not read. The cuts between shards come from the key column alone, so each text is encoded once and only
    packed ids are shuffled. A document longer than a segment gets a segment of its own.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    width = shuffle_width(spark)
    cuts = sorted(set(rows.select("doc_id").approxQuantile("doc_id", [i / width for i in range(1, width)], 0.2 / width)))

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("library", tokenizer), lambda: Encoder(tokenizer, by_library=True))
        end = struct.pack("<I", end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [np.frombuffer(encoder.encode(t or "") + end, "<u4") for t in part.column(1).to_pylist()]
                narrow = [bytes([2]) + i.astype("<u2").tobytes() if i.max() < 1 << 16 else bytes([4]) + i.tobytes() for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(narrow, pa.binary())], ["doc_id", "ids"])
        pa.default_memory_pool().release_unused()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, before, size = -1, 0, 0, 0
        keys: list = []
        ids: list[bytes] = []

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal segment, before, keys, ids, size
            if keys:
                row = [[shard], [segment], [len(keys)], [size], [pack_segment(keys, ids, before)]]
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)],
                                                 ["shard", "segment", "n_docs", "n_tokens", "data"])
                segment, before, keys, ids, size = segment + 1, before + size, [], [], 0

        for batch in batches:
            for s, k, b in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))):
                if s != shard or size and size + len(b) // b[0] > segment_tokens:
                    yield from out()
                if s != shard:
                    shard, segment, before = s, 0, 0
                wide = np.frombuffer(b, f"<u{b[0]}", offset=1).astype("<u4").tobytes()
                keys.append(k)
                ids.append(wide)
                size += len(wide) // 4
        yield from out()

    passed = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    shard = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(passed)
    (rows.mapInArrow(encoded, "doc_id bigint, ids binary").withColumn("shard", shard.cast("int"))
     .repartitionById(len(cuts) + 1, F.col("shard"))
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "ids")
     .mapInArrow(packed, SEGMENT).write.parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32, and the ids themselves.

    `start` counts the ids of all documents before. The shards' totals, one row each, are summed up; within a shard the
    segments know their place.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    upto = F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    base = (segments.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
            .select("shard", F.coalesce(upto, F.lit(0)).alias("base")))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base_of, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Segment(data.as_py())
                for i in range(0, s.n_docs, READ_DOCS):
                    j = min(i + READ_DOCS, s.n_docs)
                    bounds = s.bounds.select_range(i, j + 1)
                    wide = s.ids[bounds[0]:bounds[-1]].astype("<u4")
                    at = (bounds - bounds[0]).tolist()
                    docs = [wide[a:b].tobytes() for a, b in zip(at, at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.keys(i, j), pa.int64()), pa.array(bounds[:-1] + base_of + s.before, pa.int64()),
                         pa.array(np.diff(bounds), pa.int64()), pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                         pa.array(docs, pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return (segments.select("shard", "data").join(F.broadcast(base), "shard").select("base", "data")  # base: one row a shard
            .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, **options) -> DataFrame:
    """Write the files into the shared folder and read them back. An empty table gives no rows."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, end_id, **options)
    return read_token_files(docs.sparkSession, path)
