"""Byte-level BPE by segment trees, and its inverse.

A word is a row of byte positions.  A segment tree over the positions holds, at each leaf,
the rank of the pair that starts there, and at each inner node the smaller child; its root
is the leftmost pair of minimum rank.  A merge changes three leaves (the merged pair, its
left live neighbour's pair, and the swallowed position), each a logarithmic point update.

Many words go through the same tree arrays at once (one row a word, numpy); words too long
for a row go one by one through the same tree in plain lists.  Every distinct piece of a
text between spaces is encoded once per Python worker.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ChunkEncoder, arrow_pass, slices, spread_scan, texts_of

#: Words of up to this many bytes share tree arrays.
ROW_BYTES = 128
#: Cells (words x positions) of one set of tree arrays.
CELLS = 1 << 20
NONE = np.int64(1) << 62
POSITION = (1 << 32) - 1
#: White space as Unicode's property has it, spelled out because engines differ.
WHITE = r"\t\n\v\f\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class RankBPE:
    """Encoder and decoder of a rank file (``base64 rank`` lines); ``pattern`` cuts the text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        # In a class \s is part of it; outside it becomes one.
        spelled = pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.cut = regex.compile(spelled).findall
        get = self.ranks.get
        self.byte_id = np.array([get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = {(x << 32 | y): r for token, r in self.ranks.items() for i in range(1, len(token))
                 if (x := get(token[:i])) is not None and (y := get(token[i:])) is not None}
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.key_rank = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], -1)

    def merge_rows(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of at most ``ROW_BYTES`` bytes (at least one), all trees together."""
        m, lengths = len(words), np.array([len(w) for w in words])
        width = 1 << max(1, int(lengths.max() - 1).bit_length())
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(m, width)
        ids = self.byte_id[flat]
        column = np.arange(width)
        live = column < lengths[:, None]
        nxt = np.tile(column + 1, (m, 1))
        prev = np.tile(column - 1, (m, 1))
        tree = np.full((m, 2 * width), NONE)
        rank = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(m, width - 1)
        open_pair = (rank >= 0) & live[:, 1:]
        tree[:, width:2 * width - 1] = np.where(open_pair, rank << 32 | column[:-1], NONE)
        half = width
        while half > 1:
            tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
            half //= 2

        def update(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + width
            tree[rows, node] = value
            while node[0] > 1:  # all leaves are equally deep
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def pair_at(rows: np.ndarray, left: np.ndarray) -> np.ndarray:
            right = nxt[rows, left]
            ok = right < lengths[rows]
            r = self._rank(ids[rows, left], ids[rows, np.minimum(right, width - 1)])
            return np.where(ok & (r >= 0), r << 32 | left, NONE)

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            left = best & POSITION
            gone = nxt[rows, left]
            after = nxt[rows, gone]
            ids[rows, left] = best >> 32  # a token's id is its rank
            live[rows, gone] = False
            nxt[rows, left] = after
            inside = after < lengths[rows]
            prev[rows[inside], after[inside]] = left[inside]
            update(rows, gone, np.full(len(rows), NONE))
            update(rows, left, pair_at(rows, left))
            before = prev[rows, left]
            some = before >= 0
            if some.any():
                update(rows[some], before[some], pair_at(rows[some], before[some]))
            rows = rows[tree[rows, 1] < NONE]
        return np.split(ids[live], np.cumsum(live.sum(axis=1))[:-1])

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same tree for one word of any length."""
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        none, pairs = int(NONE), self.pairs
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = pairs.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[width + i] = r << 32 | i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(leaf: int) -> None:
            right = nxt[leaf]
            r = pairs.get(ids[leaf] << 32 | ids[right]) if ids[leaf] >= 0 and right < n else None
            node = width + leaf
            tree[node] = none if r is None else r << 32 | leaf
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        while tree[1] < none:
            left, rank = tree[1] & POSITION, tree[1] >> 32
            gone = nxt[left]
            ids[left], ids[gone] = rank, -1
            nxt[left] = nxt[gone]
            if nxt[left] < n:
                prev[nxt[left]] = left
            update(gone)
            update(left)
            if prev[left] >= 0:
                update(prev[left])
        return np.array([i for i in ids if i >= 0], np.int64)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > ROW_BYTES:
                out[k] = self.merge_long(w).astype("<u4").tobytes()
            elif w in self.ranks:
                out[k] = self.ranks[w].to_bytes(4, "little")
            elif w:
                by_size.setdefault((len(w) - 1).bit_length(), []).append(k)
        for size, ks in by_size.items():
            step = max(1, CELLS >> (size + 1))
            for at in range(0, len(ks), step):
                part = ks[at:at + step]
                for k, ids in zip(part, self.merge_rows([words[i] for i in part]), strict=True):
                    out[k] = ids.astype("<u4").tobytes()
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of strings on their own: cut by the pattern, each match encoded separately."""
        cut = [[w.encode() for w in self.cut(c)] for c in chunks]
        distinct = list(dict.fromkeys(w for ws in cut for w in ws))
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True))
        return [b"".join([ids[w] for w in ws]) for ws in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_BPE: dict[tuple, tuple[RankBPE, ChunkEncoder]] = {}


def encoder(path: str, pattern: str) -> tuple[RankBPE, ChunkEncoder]:
    """One per Python worker."""
    if (path, pattern) not in _BPE:
        bpe = RankBPE(path, pattern)
        _BPE[path, pattern] = bpe, ChunkEncoder(bpe.encode_chunks, space_free=False)
    return _BPE[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit bytes) of every whole text.

    A narrow pass, nothing is shuffled.  Null texts count as empty (no ids), null ids stay
    null, repeated rows give repeated rows, other columns are ignored."""

    def rows(batches):
        _, encode = encoder(path, pattern)
        for batch in slices(batches):
            ids = encode(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return arrow_pass(spread_scan(source), f"doc_id {id_type}, ids binary", rows)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with a column ``decoded``: the bytes of the ids; null stays null."""

    def rows(batches):
        bpe, _ = encoder(path, pattern)
        for batch in slices(batches):
            out = [None if i is None else bpe.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_pass(encoded.select("doc_id", "ids"), f"doc_id {id_type}, ids binary, decoded binary", rows)
