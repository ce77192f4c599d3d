"""Best-fit packing of tokenized documents into sequences of a fixed length.

Bounded-space online best-fit: every task keeps a fixed number of open bins in a bitset
keyed by free space.  A piece goes to the open bin with the least free space that holds it
(one shift and one lowest-bit test); if none does, a new bin is opened, and when all places
are taken the fullest bin closes first.

The scan is tokenized and packed in one narrow pass: ids never cross a shuffle.  The bins
that are still open when a split ends (at most ``open_bins`` a task) would waste space, so
their pieces alone are dealt to a few tasks and packed again, longest first, by the same
packer.  Both parts are in one written table, split by a boolean partition column.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, forget, library_encoder, slices, spread_scan, text_slices, texts_of, write_table

SEQUENCE_TOKENS = 2048
END_ID = 0
OPEN_BINS = 512
#: Pieces left over at split ends that one task of the second pass packs.
PIECES_PER_TASK = 100_000
#: Chunks of text whose ids a worker remembers: a worker also holds the open bins, and in a
#: pipeline its executor's heap is at its full size by now.
REMEMBERED = 500_000
#: Open bins of the second pass (at most 8 KB of ids each).
SECOND_OPEN_BINS = 4096


class BestFit:
    """Online best-fit with at most ``open_bins`` open bins of ``size`` units."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.bits = 0  # bit f is set if some open bin has f units free
        self.by_free: dict[int, list[list]] = {}
        self.count = 0

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.count -= 1
        return taken

    def place(self, length: int, item) -> list[list]:
        """Put an item in; returns the bins that closed."""
        closed = []
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            into = self._take(free)
        else:
            if self.count >= self.open_bins:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, into = self.size, []
        into.append((self.size - free, item))
        free -= length
        if free:
            self.by_free.setdefault(free, []).append(into)
            self.bits |= 1 << free
            self.count += 1
        else:
            closed.append(into)
        return closed

    def rest(self) -> list[list]:
        return [b for free in sorted(self.by_free) for b in self.by_free[free]]


def cut_pieces(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def _emitter(schema: pa.Schema):
    rows: list[tuple] = []

    def put(bins: list[list], sign: int, state: dict, closed: bool) -> None:
        for b in bins:
            seq = state["next"]
            state["next"] += 1
            rows.extend((*item, seq if sign > 0 else -1 - seq, offset, closed) for offset, item in b)

    def out(least: int) -> Iterator[pa.RecordBatch]:
        if len(rows) >= least and rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows.clear()

    return put, out


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", id_type), ("piece", pa.int32()), ("start", pa.int64()),
                      ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()),
                      ("offset", pa.int64()), ("closed", pa.bool_())])


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS,
                   end_id: int = END_ID, open_bins: int = OPEN_BINS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Packed pieces: doc_id, piece, start, length, ids, sequence_id, offset.

    A document's ids are those of its whole text and then ``end_id``; ``ids`` holds a piece's
    ids as little-endian unsigned 32-bit bytes.  Null texts count as empty (one piece holding
    the end id), null ids stay null, repeated rows are packed like any other row, columns
    beside the two named are ignored, and an empty table gives no rows."""
    end = int(end_id).to_bytes(4, "little")
    width = 4

    def tokenize_and_pack(batches):
        encode = library_encoder(tokenizer_path, space_free=False, limit=REMEMBERED)
        forget(encode)
        packer = BestFit(size, open_bins)
        state = {"next": TaskContext.get().partitionId() << 32}
        put = None
        for batch in text_slices(batches, "text"):
            if put is None:
                put, out = _emitter(_schema(batch.schema.field(0).type))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts_of(batch, "text")), strict=True):
                ids += end
                for piece, (start, length) in enumerate(cut_pieces(len(ids) // width, size)):
                    part = ids[start * width:(start + length) * width]
                    put(packer.place(length, (doc_id, piece, start, length, part)), 1, state, True)
            yield from out(2000)
        if put is not None:
            yield from out(1)
            for b in packer.rest():
                put([b], 1, state, False)
                yield from out(2000)
            yield from out(1)

    def pack_again(batches):
        packer = BestFit(size, SECOND_OPEN_BINS)
        state = {"next": TaskContext.get().partitionId() << 32}
        put = None
        for batch in slices(batches):
            if put is None:
                put, out = _emitter(_schema(batch.schema.field(0).type))
            for item in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                put(packer.place(item[3], item), -1, state, True)
            yield from out(2000)
        if put is not None:
            put(packer.rest(), -1, state, True)
            yield from out(1)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary, "
              "sequence_id bigint, offset bigint, closed boolean")
    first = write_table(arrow_pass(spread_scan(source), schema, tokenize_and_pack), "closed")
    left = first.where(~F.col("closed")).select("doc_id", "piece", "start", "length", "ids")
    tasks = -(-left.count() // PIECES_PER_TASK) or 1
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids")]
    again = arrow_pass(left.repartition(tasks).sortWithinPartitions(*order), schema, pack_again)
    columns = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    return first.where("closed").select(columns).unionByName(again.select(columns))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, ids (whole sequence), doc_ids and lengths in place
    order.  A group is one sequence, so it is bounded by the sequence length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id",
        F.aggregate("_p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"), F.col("_p.length").alias("lengths"))
