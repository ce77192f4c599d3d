"""MinHash near-dedup by improved consistent weighted sampling over TF-IDF shingles.

A text is its multiset of five-word shingles (a text of fewer words is one shingle); the k-th
occurrence of a shingle is an element of its own, so term frequency counts.  An element weighs
the mean inverse document frequency of its words, rounded to a quarter octave.  Document
frequencies are counted for each word (by 64 bits of hash) over all documents: chunks of about
``CHUNK_BYTES`` of text send their distinct words, each once with the number of the chunk's texts
that hold it, to the partition that owns the word; owners answer each chunk with the corpus-wide
counts, and the answers meet the chunk's texts when these are signed.  No table of all words goes
to a task, whatever the size of the corpus.

1. Improved consistent weighted sampling draws ``SAMPLES`` elements a text: each element's draw
   (Gamma, Gamma, uniform) comes from a table by a hash of element and sample number, and the
   element of least ``ln c - r (t - beta + 1)``, ``t = floor(ln w / r + beta)``, is the sample.  An
   element has one weight in the whole corpus, so the element alone identifies (element, t).
2. Texts of equal words are one class.  Classes that agree in a band of ``ROWS`` samples share a
   bucket.  Buckets of equal members are looked at once.
3. In a bucket, classes whose samples agree in at least ``LEAST_AGREEMENT`` are joined; of these
   pairs only a spanning forest leaves the task.  The components are *families*.
4. Families are verified by exact weighted Jaccard similarity of whole texts, all against all.

Buckets and families beyond a block's size are cut into blocks by hash, and each pair of blocks is
one group of bounded size: nothing is capped, no group holds an unbounded number of texts, and
a group gives at most as many links as it has members.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Bounded, forget, spread_scan, texts_of, write_table
from tessera.llm.lm_scoring import bucket_bounds, by_bucket, chunked, coded_words, from_planes, planes, to_owners
from tessera.operators.components import connected_components
from tessera.session import cut_lineage, scratch_scope, ship_package

WORDS = 5
SIMILARITY = 0.8
SAMPLES, ROWS = 64, 4
#: Share of samples below which a pair of at least SIMILARITY practically never falls: four
#: standard deviations (0.05 each with 64 samples) and more.
LEAST_AGREEMENT = 0.58
#: Text of one chunk.
CHUNK_BYTES = 3 << 20
#: Weights are 2 ** (level / 4).
LEVELS = 32
SLOT_BITS = 16
BUCKET_BLOCK, FAMILY_BLOCK = 256, 128
STEP = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 16
#: The white space of ``str.split`` that takes three bytes.
WIDE_SPACE = np.array([int.from_bytes(chr(c).encode(), "big") for c in range(0x800, 0x10000) if chr(c).isspace()])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(Bounded):
    """Hash of each word met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


WORD_HASH = _Words(600_000)


def forget_other_words() -> None:
    """What other stages left in a worker goes, the hashes stay."""
    forget(WORD_HASH)


def word_hashes(text: str) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(WORD_HASH.__getitem__, words), np.uint64, len(words))


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct words of some texts in ascending order, the number there of each word of
    the texts, one after another, words of each text): the words and hashes of ``word_hashes``, each
    distinct word hashed once."""
    parts = [t.encode() for t in texts]
    raw = b"\n".join([*parts, b""])
    whole = np.frombuffer(raw, np.uint8)
    letter = (whole - np.uint8(9) > 4) & (whole - np.uint8(28) > 4)
    # Beside 9 to 13 and 28 to 32 there is white space of two bytes, C2 85 and C2 A0, and of three.
    two = np.flatnonzero(whole[:-1] == 0xC2)
    two = two[(whole[two + 1] == 0x85) | (whole[two + 1] == 0xA0)]
    three = np.flatnonzero((whole[:-1] >= 0xE1) & (whole[:-1] <= 0xE3))  # a last byte is a line feed
    code = (whole[three].astype(np.int64) << 16) + (whole[three + 1].astype(np.int64) << 8) + whole[three + 2]
    three = three[np.isin(code, WIDE_SPACE)]
    for at in (two, two + 1, three, three + 1, three + 2):
        letter[at] = False
    words, numbers, held = coded_words(raw, letter, list(map(len, parts)))
    words = words.to_numpy(zero_copy_only=False).tolist()
    hashes, own = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), return_inverse=True)
    return hashes, own[numbers], held


class Weights:
    """Smoothed inverse document frequency by word hash; words not given are in one text only."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, texts: int):
        """``words`` in ascending order, each once."""
        self.words, self.texts = words, texts
        self.values = self._idf(counts)

    def _idf(self, counts: np.ndarray) -> np.ndarray:
        return np.log((1 + self.texts) / (1 + counts)) + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), self._idf(np.int64(1)))
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.values[at], self._idf(np.int64(1)))


def elements(hashes: np.ndarray, idf: Weights | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(element hashes in ascending order, weight level of each); a plain array has the weight of
    each word of the text."""
    own = idf.of(hashes) if isinstance(idf, Weights) else idf
    return elements_of(hashes, own, np.array([len(hashes)]))[:2]


def elements_of(hashes: np.ndarray, own: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``elements`` of texts of ``held`` words each, one after another, and how many each text has;
    ``own`` has the weight of each word."""
    width = np.minimum(held, WORDS)
    sizes = np.where(held > 0, held - width + 1, 0)
    text = np.repeat(np.arange(len(held)), sizes)
    # The word at which each shingle starts.
    at = np.arange(len(text)) + np.repeat(np.cumsum(held) - held - (np.cumsum(sizes) - sizes), sizes)
    shingles, weight = np.empty(len(text), np.uint64), np.empty(len(text))
    for k in np.unique(width[held > 0]).tolist():  # less than WORDS: the one shingle of a shorter text
        last = len(hashes) - k + 1
        shingle, mean = np.zeros(last, np.uint64), np.zeros(last)
        for j in range(k):
            shingle = shingle * STEP + hashes[j:last + j]
            mean += own[j:last + j]
        on = np.flatnonzero(width[text] == k)
        shingles[on], weight[on] = _mix(shingle + np.uint64(k))[at[on]], (mean / k)[at[on]]
    level = np.clip(np.rint(4 * np.log2(weight)), 0, LEVELS - 1).astype(np.int64)
    order = _within(text, shingles, len(held))
    shingles, level = shingles[order], level[order]
    again = (shingles[1:] == shingles[:-1]) & (text[1:] == text[:-1])
    if again.any():
        first = np.flatnonzero(np.concatenate([[True], ~again]))
        turn = np.arange(len(shingles)) - np.repeat(first, np.diff(np.append(first, len(shingles))))
        shingles = np.where(turn > 0, _mix(shingles + turn.astype(np.uint64) * STEP), shingles)
        touched = np.zeros(len(held), bool)
        touched[text[turn > 0]] = True
        mine = np.flatnonzero(touched[text])
        order = mine[_within(text[mine], shingles[mine], len(held))]
        shingles[mine], level[mine] = shingles[order], level[order]
    return shingles, level, sizes


def _within(text: np.ndarray, shingles: np.ndarray, texts: int) -> np.ndarray:
    """Order by text, then by shingle."""
    order = np.argsort(shingles)
    # Numbers of 16 bits are sorted in linear time.
    return order[np.argsort(text[order].astype(np.uint16 if texts <= 1 << 16 else np.int64), kind="stable")] if texts > 1 else order


class Sampler:
    """Draws of improved consistent weighted sampling, tabulated for every weight level."""

    def __init__(self, samples: int = SAMPLES, seed: int = 5):
        rng = np.random.default_rng(seed)
        slots = 1 << SLOT_BITS
        r, c, beta = rng.gamma(2, 1, slots), rng.gamma(2, 1, slots), rng.random(slots)
        log_w = np.arange(LEVELS)[:, None] * (np.log(2) / 4)
        t = np.floor(log_w / r + beta)
        self.table = (np.log(c) - r * (t - beta + 1)).astype(np.float32).ravel()
        self.odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        cells = max(CELLS, samples)
        self.slots, self.values = np.empty(cells, np.uint64), np.empty(cells, np.float32)

    def signature(self, shingles: np.ndarray, level: np.ndarray) -> bytes:
        """The upper half of each sampled element's hash, 32 bits little-endian."""
        best = np.full(len(self.odd), np.inf, np.float32)
        chosen = np.zeros(len(self.odd), np.uint64)
        step = max(1, CELLS // len(self.odd))
        rows, odd = np.arange(len(self.odd)), self.odd[:, None]
        base = level << SLOT_BITS
        for at in range(0, len(shingles), step):
            part = shingles[at:at + step]
            slot = self.slots[:part.size * len(odd)].reshape(len(odd), -1)
            value = self.values[:slot.size].reshape(slot.shape)
            np.multiply(part, odd, out=slot)
            np.right_shift(slot, np.uint64(64 - SLOT_BITS), out=slot)
            slot = slot.view(np.int64)
            slot += base[at:at + step]
            self.table.take(slot, out=value, mode="clip")
            least = value.argmin(axis=1)
            value = value[rows, least]
            better = value < best
            best[better] = value[better]
            chosen[better] = part[least[better]]
        return (chosen >> np.uint64(32)).astype("<u4").tobytes()


@lru_cache(1)
def sampler() -> Sampler:
    """One table a worker, whatever the number of its chunks."""
    return Sampler()


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix."""
    left = np.ones(len(adjacent), bool)
    out = []
    for root in range(len(adjacent)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(adjacent[i] & left)
            left[new] = False
            out.extend((i, j) for j in new.tolist())
            todo.extend(new.tolist())
    return out


def _links(ids: list, own: np.ndarray, i: int, j: int, close: np.ndarray) -> tuple[list, list]:
    """Spanning links of a group; with two blocks only pairs across count."""
    if i != j:
        close = close & (own[:, None] != own[None, :])
    pairs = [(ids[x], ids[y]) for x, y in forest(close) if ids[x] != ids[y]]
    return [min(p) for p in pairs], [max(p) for p in pairs]


def similarities(texts: list[str], idf: Weights | list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs; a list has the weights of each text's words."""
    n = len(texts)
    hashes = [word_hashes(t) for t in texts]
    own = [idf.of(h) for h in hashes] if isinstance(idf, Weights) else idf
    shingles, level, sizes = elements_of(np.concatenate(hashes), np.concatenate(own), np.array(list(map(len, hashes))))
    each, row = 2.0 ** (level / 4), np.repeat(np.arange(n), sizes)
    total = np.array([w.sum() for w in np.split(each, np.cumsum(sizes)[:-1])])
    _, first, column, count = np.unique(shingles, return_index=True, return_inverse=True, return_counts=True)
    weight = each[first]
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column, weight = row[keep], number[column[keep]], weight[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n))
    width = max(256, (1 << 20) // max(n, 1))
    for at in range(0, len(weight), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        has = np.zeros((n, min(width, len(weight) - at)))
        has[row[lo:hi], column[lo:hi] - at] = 1
        common += (has * weight[at:at + width]) @ has.T
    union = total[:, None] + total[None, :] - common
    return np.divide(common, union, out=np.zeros_like(common), where=union > 0)


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, behind that width."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


REQUEST = "bucket int, chunk bigint, n int, keys binary, counts binary"
ANSWER = "chunk bigint, bucket int, n int, counts binary"


def _batches(rows: list[tuple], schema: str):
    """Rows as Arrow batches of a few records each, as these are long."""
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows[i:i + 64], strict=True), kinds, strict=True)], names)


def word_counts(source: DataFrame) -> DataFrame:
    """Answers to every chunk of ``source`` (doc_id, text, ...): chunk, bucket, n, counts, the number of
    texts in all documents that hold each of the chunk's distinct words, in ascending order of hash.
    ``source`` must be a scan or a narrow step after one, as ``place`` forms the same chunks again."""
    parts, chunk_bytes = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), CHUNK_BYTES
    buckets = 2 * parts

    def ask(batches):
        forget_other_words()

        def requests(chunk, texts):
            keys, numbers, held = hashed_words(texts)
            pairs = np.sort(np.repeat(np.arange(len(texts)), held) * len(keys) + numbers)
            new = np.ones(len(pairs), bool)  # a text counts once for each of its words
            new[1:] = pairs[1:] != pairs[:-1]
            counts = np.bincount(pairs[new] % max(len(keys), 1), minlength=len(keys))
            cuts = bucket_bounds(keys, buckets)
            out = []
            for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if i < j:
                    mine = keys[i:j].copy()
                    mine[1:] -= keys[i:j - 1]
                    out.append((b, chunk, int(j - i), planes(mine), planes(counts[i:j])))
            yield from _batches(out, REQUEST)

        at, texts = None, []
        for chunk, piece in chunked(batches, 1, chunk_bytes):
            if chunk != at:
                yield from requests(at, texts)
                at, texts = chunk, []
            texts += texts_of(piece, "text")
        yield from requests(at, texts)

    def answer(batches):
        got = by_bucket(batches)
        while got:
            mine = got.popitem()[1]
            keys = np.concatenate([np.cumsum(from_planes(r["keys"]), dtype=np.uint64) for r in mine])
            counts = np.concatenate([from_planes(r["counts"]) for r in mine]).astype(np.int64)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            total = np.empty(len(keys), np.int64)
            total[order] = np.repeat(np.add.reduceat(counts[order], firsts), np.diff(np.append(firsts, len(keys))))
            ends = np.cumsum([r["n"] for r in mine])
            yield from _batches([(r["chunk"], r["bucket"], r["n"], planes(t)) for r, t in zip(mine, np.split(total, ends[:-1]), strict=True)], ANSWER)

    ship_package(source.sparkSession)
    return cut_lineage(to_owners(source.mapInArrow(ask, REQUEST), parts).mapInArrow(answer, ANSWER), "zstd")


def place(source: DataFrame) -> DataFrame:
    """``source`` and the chunk of each row."""
    chunk_bytes = CHUNK_BYTES

    def rows(batches):
        for chunk, piece in chunked(batches, 1, chunk_bytes):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(np.full(piece.num_rows, chunk), pa.int64())],
                                             [*piece.schema.names, "chunk"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), "chunk bigint"])
    return source.mapInArrow(rows, schema)


def corpus_counts(words: np.ndarray, answers: pa.Table) -> np.ndarray:
    """Corpus-wide counts of a chunk's distinct words."""
    mine = sorted(zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "counts")), strict=True), key=lambda x: x[0])
    if sum(n for _, n, _ in mine) != len(words):
        raise RuntimeError("the texts of a chunk differ between two readings; write the input as a table first")
    return np.concatenate([from_planes(c) for _, _, c in mine]).astype(np.int64) if mine else np.empty(0, np.int64)


def _blocked(rows: DataFrame, group: str, by: str, block: int) -> DataFrame:
    """Rows of groups with a column ``n`` (members), dealt to pairs of blocks: own, i, j."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(F.lit(3), by), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *rows.columns, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least doc_id reachable by pairs of at least
    ``similarity``, texts of equal words included), kept (doc_id = class_id).

    Texts without a word, null ones among them, are alone in their class, as are rows with a
    null id (class_id null, kept true).  Rows of one id are one node; other columns are ignored;
    an empty table gives no rows."""
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    spread = spread_scan(source)
    texts = spread.count()

    def sign(rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, numbers, held = hashed_words(texts_of(rows, "text"))
        counts = corpus_counts(words, answers)
        hashes, ends = words[numbers], np.cumsum(held)
        shingles, level, sizes = elements_of(hashes, Weights(words, counts, texts).values[numbers], held)
        counts, stops = counts[numbers], np.cumsum(sizes)
        k1, k2, signatures, own = [], [], [], []
        for m, to, size, stop in zip(held.tolist(), ends.tolist(), sizes.tolist(), stops.tolist(), strict=True):
            key = xxhash.xxh3_128_intdigest(hashes[to - m:to].tobytes())
            k1.append((key >> 64) - (1 << 63))
            k2.append((key & (1 << 64) - 1) - (1 << 63))
            signatures.append(sampler().signature(shingles[stop - size:stop], level[stop - size:stop]) if m else None)
            own.append(packed(counts[to - m:to]) if m else None)
        return pa.table({"doc_id": rows.column("doc_id"), "th": rows.column("th"), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()),
                         "signature": pa.array(signatures, pa.binary()), "counts": pa.array(own, pa.binary())})

    # Tables of whole texts or of all their words go as soon as the next one is written.
    with scratch_scope(spark):
        replies = word_counts(spread)
        signed = write_table(place(spread).groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
            sign, f"doc_id {id_type}, th bigint, k1 bigint, k2 bigint, signature binary, counts binary"), compression="zstd")
    classes = write_table(
        signed.where(F.col("signature").isNotNull() & F.col("doc_id").isNotNull()).groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "th")).alias("r"), F.first("signature").alias("signature"))
        .select("k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.th").alias("th"), "signature"))

    def links(group: pa.Table, close: np.ndarray) -> pa.Table:
        np.fill_diagonal(close, False)
        reps = group.column("rep")
        a, b = _links(reps.to_pylist(), group.column("own").to_numpy(), group.column("i")[0].as_py(), group.column("j")[0].as_py(), close)
        return pa.table({"a": pa.array(a, reps.type), "b": pa.array(b, reps.type)})

    def agree(group: pa.Table) -> pa.Table:
        signatures = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u4").reshape(group.num_rows, -1)
        same = np.zeros((len(signatures), len(signatures)), np.int16)
        if len(signatures) <= 32:
            same += (signatures[:, None] == signatures[None]).sum(2, dtype=np.int16)
        else:
            for column in signatures.T:
                same += column[:, None] == column[None, :]
        return links(group, same >= LEAST_AGREEMENT * signatures.shape[1])

    def verify(group: pa.Table) -> pa.Table:
        weights = [np.log((1 + texts) / (1 + unpacked(c))) + 1 for c in group.column("counts").to_pylist()]
        return links(group, similarities(group.column("text").to_pylist(), weights) >= similarity)

    pair = f"a {id_type}, b {id_type}"
    with scratch_scope(spark):
        # Buckets with several members; of buckets with the same members one.
        width = 4 * ROWS
        bands = F.array(*(F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(SAMPLES // ROWS)))
        member = classes.select("rep", F.explode(bands).alias("bucket"))
        buckets = (member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lo"),
                                                F.bit_xor(F.xxhash64("rep")).alias("x")).where("n > 1")
                   .groupBy("n", "lo", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "n"))
        buckets = cut_lineage(buckets)
        inside = cut_lineage(member.join(buckets, "bucket"))
        inside = _blocked(inside.join(classes.select("rep", "signature"), "rep"), "bucket", "rep", BUCKET_BLOCK)
        candidates = cut_lineage(inside.groupBy("bucket", "i", "j").applyInArrow(agree, pair).distinct())
        families = connected_components(candidates, "a", "b")
        sizes = cut_lineage(families.groupBy("component").agg(F.count(F.lit(1)).alias("n")))
        placed = _blocked(cut_lineage(families.join(sizes, "component")), "component", "node", FAMILY_BLOCK)
        named = cut_lineage(classes.join(families, F.col("rep") == F.col("node"), "left_semi").select("rep", "th"))
        # No bound holds for the size of either side, so these joins are merge joins at every size.
        wanted = named.select("rep", F.col("th").alias("of"))
        whole = source.join(wanted.hint("merge"), (F.col("rep") == F.col("doc_id")) & (F.col("of") == F.col("th"))).select("rep", "of", "text")
        counts = signed.select("doc_id", "th", "counts").join(
            wanted.hint("merge"), (F.col("rep") == F.col("doc_id")) & (F.col("of") == F.col("th"))).select("rep", "of", "counts")
        # An id with several texts stands for each of them.
        key = ["rep", "of"]
        whole = cut_lineage(whole.dropDuplicates(key).join(counts.dropDuplicates(key).hint("merge"), key), "zstd")
        verified = write_table(placed.join(whole, placed["node"] == whole["rep"])
                               .groupBy("component", "i", "j").applyInArrow(verify, pair).distinct())
    parts = connected_components(verified, "a", "b")
    # Written, so that the join with all rows is of two plain shuffles and a hot class can be split.
    result = write_table(classes.join(parts, F.col("rep") == F.col("node"), "left")
                         .select("k1", "k2", F.coalesce("component", "rep").alias("class_id")))
    # Nothing but what the join needs is shuffled.
    alone = F.col("signature").isNull() | F.col("doc_id").isNull()
    joined = signed.select("doc_id", "k1", "k2", alone.alias("alone")).join(result.hint("merge"), ["k1", "k2"], "left")
    class_id = F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select("doc_id", class_id.alias("class_id"),
                         F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"))
