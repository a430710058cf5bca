"""Token ids stored at a fixed number of bits, in blocks with offsets.

A table of token ids is a folder of Parquet files whose rows are blocks. A block
holds whole documents, as many as make about ``BLOCK`` ids: their ids, each in the
fewest bits that the vocabulary needs, little-endian, one after the other
(``payload``), and where each document begins (``offsets``). Any run of ids can be
unpacked by itself, in numpy, from its bit position; any block can be read by its
file and block number. Spark's committer writes the files, so repeated or lost
tasks leave nothing behind, on any store that Spark can write to.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftlab.llm import tokens
from shiftlab.llm.common import own_columns, ship

BLOCK = 1 << 16


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, little-endian."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for at in range(0, len(ids), 8 * BLOCK):
        part = ids[at:at + 8 * BLOCK].astype(np.uint64)
        spread = (part[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        out.append(np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` as uint32, without those before them (bits at most 32)."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    low = first * bits // 8
    high = ((first + count) * bits + 7) // 8
    data = np.frombuffer(payload[low:high] + bytes(8), np.uint8)
    place = (first + np.arange(count, dtype=np.int64)) * bits - low * 8
    words = np.lib.stride_tricks.sliding_window_view(data, 8)[place >> 3]
    value = np.ascontiguousarray(words).view("<u8").ravel() >> (place & 7).astype(np.uint64)
    return (value & np.uint64((1 << bits) - 1)).astype(np.uint32)


FIELDS = [("file", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("bits", pa.int32()),
          ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]
SCHEMA = "file int, block long, base long, bits int, doc_ids array<long>, offsets array<long>, payload binary"


def writer(path: str, end: int, size: int):
    def run(batches):
        encode = tokens.id_encoder(path)
        bits = bits_for(max(encode.vocabulary, end + 1))
        tail = np.array([end], "<u4").astype(encode.dtype).tobytes()
        file, block, base = 0, 0, 0
        ids, chunks, offsets = [], [], [0]

        def flush():
            nonlocal block, base, ids, chunks, offsets
            row = pa.record_batch([pa.array([v], kind) for v, (_, kind) in zip(
                [file, block, base, bits, ids, offsets, pack(np.frombuffer(b"".join(chunks), encode.dtype), bits)],
                FIELDS)], [n for n, _ in FIELDS])
            block, base = block + 1, base + offsets[-1]
            ids, chunks, offsets = [], [], [0]
            return row

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if len(names):
                file = batch.column("file")[0].as_py()
            for a, b in tokens.portions(texts):
                for name, found in zip(names[a:b], encode(texts[a:b])):
                    ids.append(name)
                    chunks.append(found + tail)
                    offsets.append(offsets[-1] + len(chunks[-1]) // encode.dtype.itemsize)
                    if offsets[-1] >= size:
                        yield flush()
        if ids:
            yield flush()
    return run


def write(docs: DataFrame, folder: str, path: str, end: int, size: int = BLOCK) -> None:
    """Write the ids of ``docs`` (doc_id integer, text), each text's followed by ``end``, to ``folder``.

    Files, blocks and documents stand in ascending order of doc_id (null first;
    rows with one doc_id in the order of their texts). A null text is empty: only
    ``end``. Without rows an empty folder is written. Other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = own_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ranged.withColumn("file", F.spark_partition_id()).mapInArrow(writer(path, end, size), SCHEMA).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, with ``first``: ids in all files before theirs. One short row per file, of which there are as many as tasks, is summed in order and broadcast."""
    found = spark.read.schema(SCHEMA).parquet(folder)
    files = found.groupBy("file").agg(F.sum(F.element_at("offsets", -1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return found.join(F.broadcast(files), "file")


def reader(with_ids: bool):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                offsets = np.array(row["offsets"].as_py(), np.int64)
                bits, payload = row["bits"].as_py(), row["payload"].as_py()
                ids = unpack(payload, bits, 0, int(offsets[-1]))
                data = ids.astype("<u4").tobytes()
                cuts = (offsets * 4).tolist()
                columns = [row["doc_ids"].values, pa.array(offsets[:-1] + row["base"].as_py() + row["first"].as_py()),
                           pa.array(np.diff(offsets)),
                           pa.array([zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.record_batch(columns, names)
    return run


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files."""
    ship(spark)
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return blocks(spark, folder).select("doc_ids", "offsets", "bits", "payload", "base", "first").mapInArrow(
        reader(with_ids), kind)


def lookup(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of one document, from its block alone."""
    found = spark.read.schema(SCHEMA).parquet(folder).where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    out = []
    for row in found.select("doc_ids", "offsets", "bits", "payload").collect():
        for i, name in enumerate(row.doc_ids):
            if name == doc_id:
                out.append(unpack(row.payload, row.bits, row.offsets[i], row.offsets[i + 1] - row.offsets[i]).tolist())
    return out
