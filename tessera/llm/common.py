"""Helpers shared by the operators: Arrow row passes, spreading, chunk-cached tokenizing."""

from __future__ import annotations

import re
import unicodedata
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package

#: Rows of a task that Python handles at once; bounds the memory of a batch of lists.
SLICE_ROWS = 256
#: Bytes of text that are cut into words at once (one longer text goes alone).
SLICE_BYTES = 4 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores is dealt out evenly.

    A table of many splits is returned as it is, so nothing is shuffled at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def arrow_pass(df: DataFrame, schema: str, rows: Callable[..., Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` with the package shipped to the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(rows, schema)


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def text_slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes in ``column``, of one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, before = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as strings, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


_BOUNDED: weakref.WeakValueDictionary = weakref.WeakValueDictionary()


def forget(keep=None) -> None:
    """Empty every memo of this Python worker (``Bounded`` ones and those of encoders) but ``keep``.
    A worker serves one stage after another, and would hold what earlier ones remembered beside
    the next one's own."""
    for memo in list(_BOUNDED.values()):
        if memo is not keep:
            memo.clear()


class Bounded(dict):
    """A memo of at most ``limit`` entries; it starts afresh when full, so results never
    depend on it."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        _BOUNDED[id(self)] = self

    def room(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


class WordMemo(dict):
    """Words as cut -> ids (False where the text must stay whole), and ``before``: the words of the
    memo that this one follows.  Words met again move over, so when a memo is followed by the next
    one and ``before`` goes, the frequent words stay."""

    def __init__(self, before: dict):
        super().__init__()
        self.before = before

    def of(self, words: list[str]) -> list[bytes | bool | None]:
        """What is known of each word; None if nothing is."""
        found = list(map(self.get, words))
        left = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(left, map(self.before.get, [words[k] for k in left])):
            if ids is not None:
                found[k] = self[words[k]] = ids
        return found


def _ends_in_letter(c: str) -> bool:
    """True of a letter that stays one when normalized (a few become a letter and a mark)."""
    return c.isalpha() and (c.isascii() or unicodedata.normalize("NFC", c).lower()[-1].isalpha())


class ChunkEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, with each distinct chunk
    between spaces encoded once per Python worker while it is remembered (about ``limit`` chunks
    at most; results never depend on it).

    ``encode(list of str) -> list of bytes`` encodes strings on their own.  A text is cut only
    where no match of the tokenizer's pattern can reach across:

    * ``space_free=False`` (byte-level pattern ``' ?letters | ... | \\s+(?!\\S) | \\s+'``): in
      front of a space or a line feed, unless the piece before ends in white space (then a
      white-space run would be cut, and the text is encoded whole).
    * ``space_free=True`` (white space separates words and is dropped): at every space and
      line feed.
    * between a letter and a comma or full stop that ends a chunk.

    With ``lowers`` (the tokenizer lowers all letters first) words of plain characters are one
    chunk in every case.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], space_free: bool,
                 limit: int = 1_200_000, lowers: bool = False):
        self.encode, self.space_free, self.limit, self.lowers = encode, space_free, limit, lowers
        self.memo = WordMemo({})
        self.stops = {p: encode([p])[0] for p in ",."}
        self.feed = encode(["\n"])[0]
        _BOUNDED[id(self)] = self

    def clear(self) -> None:
        self.memo = WordMemo({})

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(words as cut, each once; the number there of each word of the texts, one after another;
        where each text's words start, and the end)."""
        between = " " if self.space_free else " \n"
        cut = pc.split_pattern(pa.array([t.replace("\n", between) for t in texts], pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers, starts = coded.indices.to_numpy().copy(), cut.offsets.to_numpy()
        if self.lowers:
            words = [w if w.islower() or not PLAIN(w) else w.lower() for w in words]
        if not self.space_free:
            # Only the first word has no space in front; the last may end in white space.
            marked: dict[str, int] = {}
            firsts, lasts = starts[:-1], starts[1:] - 1
            for at, n in zip(lasts[lasts > firsts].tolist(), numbers[lasts[lasts > firsts]].tolist(), strict=True):
                if words[n] == "" or words[n][-1].isspace():
                    numbers[at] = marked.setdefault("\1" + words[n], len(words) + len(marked))
            for at, n in zip(firsts.tolist(), numbers[firsts].tolist(), strict=True):
                numbers[at] = marked.setdefault("\0" + words[n], len(words) + len(marked))
            words += marked
        return words, numbers, starts

    def _fill(self, needed: list[str]) -> None:
        """Put ids of new words into the memo."""
        memo, stops = self.memo, self.stops
        ended = [w for w in needed if w[-1:] in stops and _ends_in_letter(w[-2:-1])]
        plain = set(needed).difference(ended)
        if ended:
            bases = list({w[:-1] for w in ended} - plain)
            plain.update(b for b, ids in zip(bases, memo.of(bases), strict=True) if ids is None)
        if self.space_free:
            words = list(plain)
            memo.update(zip(words, self.encode(words), strict=True))
        else:
            words, raws, fed = [], [], []
            for w in plain:
                head = w[:1]
                if head == "\1":
                    words.append(w)
                    raws.append(w[1:] if w[1:2] == "\n" else " " + w[1:])
                elif w[-1:].isspace() or w == "":
                    memo[w] = False
                elif head == "\n":
                    words.append(w)
                    if w[1].isspace():
                        raws.append(w)
                    else:
                        fed.append(w)
                        raws.append(w[1:])
                else:
                    words.append(w)
                    raws.append(w[1:] if head == "\0" else " " + w)
            memo.update(zip(words, self.encode(raws), strict=True))
            for w in fed:
                memo[w] = self.feed + memo[w]
        for w in ended:
            base = memo[w[:-1]]
            memo[w] = base if base is False else base + stops[w[-1]]

    def _ids(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word, None where the text must stay whole."""
        found = self.memo.of(words)
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            self._fill([words[k] for k in new])
            memo = self.memo
            for k in new:
                found[k] = memo[words[k]]
        if 2 * len(self.memo) > self.limit:
            self.memo.before = {}
            self.memo = WordMemo(self.memo)
        return [None if ids is False else ids for ids in found]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Words are numbered and their ids put in a row by array passes, so the memo is asked once
        for each distinct word of ``texts``, not for each word."""
        out: list[bytes | None] = [None] * len(texts)
        apart = [k for k, t in enumerate(texts) if "\0" not in t and "\1" not in t]
        if apart:
            words, numbers, starts = self._cut([texts[k] for k in apart])
            ids = pa.array(self._ids(words), pa.large_binary()).take(pa.array(numbers))
            broken = np.logical_or.reduceat(ids.is_null().to_numpy(zero_copy_only=False), starts[:-1])
            _, places, raw = ids.buffers()
            raw = memoryview(raw or b"")
            stops = np.frombuffer(places, np.int64, len(ids) + 1)[starts].tolist()
            for k, a, b, no in zip(apart, stops[:-1], stops[1:], broken.tolist(), strict=True):
                if not no:
                    out[k] = raw[a:b].tobytes()
        return [self.encode([t])[0] if ids is None else ids for t, ids in zip(texts, out, strict=True)]


_ENCODERS: dict[tuple, ChunkEncoder] = {}
#: Chunks that one call of the library encodes as a single string.
JOINED = 64
#: Characters that normalizing only lowers, each on its own and as ``str.lower`` does.
PLAIN = re.compile("[\0-\x7fÀ-ÖØ-öø-į]+").fullmatch
#: Words that are one piece each where white space parts words: normalizing leaves them letters.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-į]+").fullmatch


def library_encoder(path: str, space_free: bool, limit: int = 1_200_000) -> ChunkEncoder:
    """Chunk-cached encoder of a ``tokenizers`` file, one per Python worker.

    Many chunks go into one call, parted by a string that is one id of its own wherever it
    stands: a line feed for the byte-level pattern (before a chunk that starts with a letter or
    sign, or one space and such), a zero between spaces where white space is dropped.

    Most chunks need no such string, as the ids themselves tell where one ends: byte-level chunks
    with a space in front and none further on start with the ids whose tokens start with it, and
    words of plain letters, one piece each, end with the ids whose tokens end a word."""
    key = (path, space_free, limit)
    if key not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        between = " \0 " if space_free else "\n"
        mark = tok.encode(between, add_special_tokens=False).ids
        parted = len(mark) == 1

        end_of_word = getattr(tok.model, "end_of_word_suffix", None) if space_free else None
        vocabulary = tok.get_vocab(with_added_tokens=False)
        told = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)  # by id: a chunk starts (or ends) here
        if space_free and end_of_word and all(c + end_of_word in vocabulary for c in ByteLevel.alphabet()):
            told[[i for t, i in vocabulary.items() if t.endswith(end_of_word)]] = True
        elif not space_free and "Ġ" in vocabulary:
            told[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        tells = bool(told.any())

        def telling(c: str) -> bool:
            return LETTERS(c) is not None if space_free else c.rfind(" ") == 0 and joinable(c)

        def joinable(c: str) -> bool:
            if space_free:
                return "\0" not in c
            return "\n" not in c and not c[-1:].isspace() and not (c[1:2] if c[0] == " " else c[0]).isspace()

        def alone(chunks: list[str]) -> list[bytes]:
            return [np.asarray(e.ids, "<u4").tobytes()
                    for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]

        def told_apart(chunks: list[str]) -> list[bytes]:
            groups = [chunks[i:i + JOINED] for i in range(0, len(chunks), JOINED)]
            texts = [(" " if space_free else "").join(g) for g in groups]
            ids = np.concatenate([np.asarray(e.ids, "<u4") for e in tok.encode_batch_fast(texts, add_special_tokens=False)])
            at = np.flatnonzero(told[ids]) * 4
            if len(at) != len(chunks):
                return alone(chunks)
            stops = (at + 4).tolist() if space_free else [*at[1:].tolist(), ids.nbytes]
            raw = ids.tobytes()
            return [raw[a:b] for a, b in zip([0, *stops], stops)]

        def encode(chunks: list[str]) -> list[bytes]:
            if len(chunks) < 2:
                return alone(chunks)
            out: list[bytes | None] = [None] * len(chunks)
            if tells:
                easy = [k for k, c in enumerate(chunks) if telling(c)]
                if easy:
                    for k, ids in zip(easy, told_apart([chunks[k] for k in easy]), strict=True):
                        out[k] = ids
            if not parted:
                rest = [k for k, ids in enumerate(out) if ids is None]
                for k, ids in zip(rest, alone([chunks[k] for k in rest]), strict=True):
                    out[k] = ids
                return out
            single = [k for k, c in enumerate(chunks) if out[k] is None and (not c or not joinable(c))]
            for k, ids in zip(single, alone([chunks[k] for k in single]), strict=True):
                out[k] = ids
            rest = [k for k, ids in enumerate(out) if ids is None]
            groups = [rest[i:i + JOINED] for i in range(0, len(rest), JOINED)]
            texts = [between.join([chunks[k] for k in g]) for g in groups]
            for g, e in zip(groups, tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.asarray(e.ids, "<u4")
                raw = ids.tobytes()
                stops = (np.flatnonzero(ids == mark[0]) * 4).tolist()
                start = 0
                for k, stop in zip(g, [*stops, len(raw)], strict=True):
                    out[k] = raw[start:stop]
                    start = stop + 4
            return out

        lowers = space_free and tok.normalizer is not None and tok.normalizer.normalize_str("AÉĮ") == "aéį"
        _ENCODERS[key] = ChunkEncoder(encode, space_free, limit, lowers)
    return _ENCODERS[key]


def write_table(df: DataFrame, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``, read back.

    ``partition_by`` names a boolean column that becomes two folders, so a reader of one
    side never opens the other; ``compression`` is the session's if None."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"
