"""Token files: ids in byte or bit planes, each plane compressed, with a chunk index.

File format (one file per shard of ascending document order), written and read by Spark so
that any store of its file systems will do:

    file    := record* index trailer          each of them followed by one line feed byte
    record  := the compressed planes of a block of BLOCK_IDS ids (the last may be shorter)
    index   := zstandard(JSON line with counts, then little-endian arrays): for every record
               its file offset, its number of ids and the compressed size of each plane; for
               every document its id, whether the id is null, and its number of ids
    trailer := index length (8 bytes, big-endian), ids in the file (8 bytes, big-endian)

A block of 32-bit ids is transposed: byte plane b holds byte b of every id, bit plane b holds
bit b of every id.  High planes are nearly constant and cost nothing; a reader can find the
block of any id or document from the index alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import arrow_pass, forget, library_encoder, slices, text_slices, texts_of

BLOCK_IDS = 65_536
END_ID = 2
LEVEL = 3
#: Words whose ids a worker remembers while it writes; none while it reads.
REMEMBERED = 800_000
TRAILER = 16


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """A block's planes, uncompressed."""
    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [columns[:, b].tobytes() for b in range(4)]
    bits = np.unpackbits(columns, axis=1, bitorder="little")
    return [np.packbits(bits[:, b], bitorder="little").tobytes() for b in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        columns = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in parts], axis=1)
        columns = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(columns).view("<u4").reshape(-1)


class ShardWriter:
    """Turns documents into the records of one file; holds one block and the index."""

    def __init__(self, block_ids: int, planes: str):
        self.block_ids, self.planes = block_ids, planes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[bytes] = []
        self.held = 0
        self.at = self.total = 0
        self.offsets, self.counts, self.sizes = [], [], []
        self.doc_ids, self.doc_null, self.doc_n = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[bytes]:
        self.doc_ids.append(doc_id or 0)
        self.doc_null.append(doc_id is None)
        self.doc_n.append(len(ids) // 4)
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.block_ids:
            yield from self._blocks(False)

    def _blocks(self, last: bool) -> Iterator[bytes]:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        stop = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for s in range(0, stop, self.block_ids):
            block = ids[s:s + self.block_ids] if not last else ids[s:min(s + self.block_ids, stop)]
            parts = [self.zstd.compress(p) for p in to_planes(block, self.planes)]
            record = b"".join(parts)
            self.offsets.append(self.at)
            self.counts.append(len(block))
            self.sizes.extend(map(len, parts))
            self.at += len(record) + 1
            self.total += len(block)
            yield record
        self.waiting = [ids[stop:].tobytes()]
        self.held = len(ids) - stop

    def close(self) -> Iterator[bytes]:
        yield from self._blocks(True)
        head = json.dumps({"planes": self.planes, "blocks": len(self.counts), "docs": len(self.doc_n)})
        index = self.zstd.compress(b"".join((
            head.encode(), b"\n", np.asarray(self.offsets, "<i8").tobytes(), np.asarray(self.counts, "<i8").tobytes(),
            np.asarray(self.sizes, "<i8").tobytes(), np.asarray(self.doc_ids, "<i8").tobytes(),
            np.asarray(self.doc_n, "<i8").tobytes(), np.asarray(self.doc_null, "u1").tobytes())))
        yield index
        yield len(index).to_bytes(8, "big") + self.total.to_bytes(8, "big")


class Shard:
    """A file's index, and its documents in order."""

    def __init__(self, content: bytes):
        end = len(content) - 1 - TRAILER
        size = int.from_bytes(content[end:end + 8], "big")
        raw = zstandard.ZstdDecompressor().decompress(content[end - 1 - size:end - 1])
        head, _, body = raw.partition(b"\n")
        head = json.loads(head)
        self.planes, blocks, docs = head["planes"], head["blocks"], head["docs"]
        per = 4 if self.planes == "byte" else 32
        numbers = np.frombuffer(body, "<i8", 2 * blocks + per * blocks + 2 * docs)
        cuts = np.cumsum([blocks, blocks, per * blocks, docs])
        self.offsets, self.counts, sizes, self.doc_ids, self.doc_n = np.split(numbers, cuts)
        self.sizes = sizes.reshape(blocks, per)
        self.doc_null = np.frombuffer(body, "u1", docs, offset=numbers.nbytes)
        self.content = content

    def block(self, k: int) -> np.ndarray:
        zstd, at, parts = zstandard.ZstdDecompressor(), int(self.offsets[k]), []
        for size in self.sizes[k].tolist():
            parts.append(zstd.decompress(self.content[at:at + size]))
            at += size
        return from_planes(parts, int(self.counts[k]), self.planes)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids of the file before it, its ids as bytes), block by block."""
        left, k, start = np.empty(0, "<u4"), 0, 0
        for doc_id, null, n in zip(self.doc_ids.tolist(), self.doc_null.tolist(), self.doc_n.tolist(), strict=True):
            if len(left) < n:
                parts, have = [left], len(left)
                while have < n:
                    parts.append(self.block(k))
                    have += len(parts[-1])
                    k += 1
                left = np.concatenate(parts)
            yield None if null else doc_id, start, left[:n].tobytes()
            left, start = left[n:], start + n


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                      planes: str = "byte", block_ids: int = BLOCK_IDS, shards: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write files in ascending id order.

    The texts are range-partitioned on the id (``shards`` ranges; the session's number of
    shuffle partitions if None), so every task writes one file of consecutive documents.
    Null texts count as empty, null ids come first, rows of one id are ordered by their text,
    other columns are ignored, and an empty table gives files without documents."""
    end = int(end_id).to_bytes(4, "little")

    def encode_shard(batches):
        encode = library_encoder(tokenizer_path, space_free=True, limit=REMEMBERED)
        forget(encode)
        writer = None
        for batch in text_slices(batches, "text"):
            writer = writer or ShardWriter(block_ids, planes)
            records = [r for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts_of(batch, "text")), strict=True)
                       for r in writer.add(doc_id, ids + end)]
            if records:
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array(list(writer.close()), pa.binary())], ["record"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = (source.repartitionByRange(shards, "doc_id") if shards else source.repartitionByRange("doc_id"))
    records = arrow_pass(ranged.sortWithinPartitions("doc_id", "text"), "record binary", encode_shard)
    # The text sink writes the bytes as they are and ends each record with a line feed.
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids
    (little-endian unsigned 32-bit bytes).  Files' totals come from their trailers; one row a
    file is summed up and joined, nothing else is gathered."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .where(F.col("length") > 0)
             .withColumn("shard", F.regexp_extract("path", r"part-(\d+)", 1).cast("int")))
    total = F.conv(F.hex(F.substring("content", -9, 8)), 16, 10).cast("bigint")
    before = (files.select("shard", total.alias("n"))
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")))

    def decode(batches):
        forget()
        names = ["shard", "doc_id", "start", "n_tokens", "ids"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        schema = pa.schema(list(zip(names, types, strict=True)))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=schema)

        for batch in slices(batches, 1):
            rows, shard = [], batch.column(0)[0].as_py()
            for doc_id, start, ids in Shard(batch.column(1)[0].as_py()).documents():
                rows.append((shard, doc_id, start, len(ids) // 4, ids))
                if len(rows) >= 1000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    schema = "shard int, doc_id bigint, start bigint, n_tokens bigint, ids binary"
    decoded = arrow_pass(files.select("shard", "content"), schema, decode)
    # One row for every file, so the size of the broadcast is bounded by the number of files.
    return decoded.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")
