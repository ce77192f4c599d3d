"""Splitting documents into overlapping chunks.

* ``fixed_chunks``: character windows of ``size`` with ``overlap`` (the splitter's final
  character-level fallback), cut in an Arrow pass: ``substring`` would scan a text from its
  start for every window, which is quadratic in its length.
* ``recursive_chunks``: chunks that end at the coarsest separator at hand (paragraph, line,
  word, character).  Where a chunk ends decides where the next starts, so each document is
  cut by a small Python helper in an Arrow pass; every text is processed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.parallelism import spread
from tessera.session import ship_package

# Splitter parameters and separators, tried in this order.
CHUNK_SIZE = 1024
CHUNK_OVERLAP = 128
SEPARATORS = ["\n\n", "\n", " ", ""]
#: Characters and rows of an output batch: bounds the memory of a task.
CHARS_OUT, ROWS_OUT = 1 << 20, 4096
WORD_START = re.compile(r"[ \n]")


def fixed_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, chunk_pos, char_start, n_chars, chunk)``; windows start every
    ``size - overlap`` characters while they add text beyond the overlap."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    names = [id_col, *carry, "chunk_pos", "char_start", "n_chars", "chunk"]
    src = docs.select(id_col, *carry, text_col)
    schema = T.StructType([*(src.schema[c] for c in (id_col, *carry)), *(T.StructField(c, T.IntegerType()) for c in names[-4:-1]),
                           T.StructField("chunk", T.StringType())])
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return window_batches(batches, names, size, overlap)

    return src.mapInArrow(run, schema)


def window_batches(batches: Iterator[pa.RecordBatch], names: list[str], size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Windows of batches whose last column is the text; the others are repeated.  Slices of a
    Python string cost their own length only, wherever they lie."""
    step = size - overlap
    for batch in batches:
        *others, texts = batch.columns
        row, pos, chunks, held = [], [], [], 0

        def out(others=others) -> pa.RecordBatch:
            at, place = pa.array(row, pa.int32()), np.array(pos, np.int32)
            lengths = pa.array([None if c is None else len(c) for c in chunks], pa.int32())
            return pa.RecordBatch.from_arrays([*(c.take(at) for c in others), pa.array(place), pa.array(place * np.int32(step)),
                                               lengths, pa.array(chunks, pa.string())], names)

        for i, text in enumerate(texts):
            text = text.as_py()
            windows = 1 if text is None else 0 if not text else max(1, -((overlap - len(text)) // step))
            for k in range(windows):
                row.append(i)
                pos.append(k)
                chunks.append(None if text is None else text[k * step:k * step + size])
                held += size
                if held >= CHARS_OUT:
                    yield out()
                    for held_rows in (row, pos, chunks):
                        held_rows.clear()
                    held = 0
        if row:
            yield out()


def chunk_stats(chunks: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Chunk count and mean length floor-divided, per group (partial aggregation)."""
    return chunks.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n_chars").alias("total_chars"),
        (F.sum("n_chars") / F.count(F.lit(1))).cast("bigint").alias("avg_chars"),
    )


# --- separator chunks: per-document helper ----------------------------------------

def cut_places(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: Sequence[str] = SEPARATORS) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of every chunk of one text, in one pass.

    A window of ``size`` characters ends behind the last occurrence of the coarsest separator
    that lies far enough in it (beyond half of the window and beyond the overlap), else at its
    full size.  The next window starts at the first word that begins within the last
    ``overlap`` characters, else at that distance.
    """
    least = max(size // 2, overlap)
    start, n = 0, len(text)
    while start < n:
        end = start + size
        if end >= n:
            yield start, n
            return
        for sep in separators:
            at = text.rfind(sep, start + least, end) if sep else -1
            if at >= 0:
                end = at + len(sep)
                break
        yield start, end
        word = WORD_START.search(text, end - overlap, end)
        start = word.end() if word and word.end() < end else end - overlap


def chunk_batches(batches: Iterator[pa.RecordBatch], names: list[str], size: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Chunks of (id, text) batches.  Texts are taken one at a time and their chunks go out as they
    are cut, about ``CHARS_OUT`` characters at once, so a batch of long texts is never held again
    in pieces."""
    for batch in batches:
        types, rows, held = _chunk_types(batch.column(0).type), [], 0

        def out(types=types) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            doc_id, text = doc_id.as_py(), text.as_py() or ""
            for pos, (a, b) in enumerate(cut_places(text, size, overlap)):
                rows.append((doc_id, pos, a, b - a, text[a:b]))
                held += b - a
                if held >= CHARS_OUT or len(rows) >= ROWS_OUT:
                    yield out()
                    rows.clear()
                    held = 0
        if rows:
            yield out()


def recursive_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """``(doc_id, chunk_pos, char_start, n_chars, chunk)``: chunks of at most ``size`` characters
    that end at the coarsest separator at hand and overlap by at most ``overlap``."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")

    names = [id_col, "chunk_pos", "char_start", "n_chars", "chunk"]
    src = docs.select(F.col(id_col), F.col(text_col))
    id_type = src.schema[id_col].dataType.simpleString()
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return chunk_batches(batches, names, size, overlap)

    return spread(src).mapInArrow(run, f"`{id_col}` {id_type}, chunk_pos int, char_start int, n_chars int, chunk string")


def _chunk_types(id_type: pa.DataType) -> list[pa.DataType]:
    return [id_type, pa.int32(), pa.int32(), pa.int32(), pa.string()]
