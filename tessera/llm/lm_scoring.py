"""Scoring texts with a weighted backoff automaton of smoothed n-grams.

The model gives a word after its context h a chance of

    p(w | h) = (c(h w) + mu * p(w | h')) / (c(h) + mu),    p(w) = (c(w) + 1) / (N + V + 1),

where h' is h without its first word (Dirichlet smoothing: the chances after every context sum to
one, with one share for all unknown words).  As an automaton: every context that was met is a
state; every n-gram that was met is an arc, weighted by its whole chance, to the state of its
longest suffix; a state without an arc for the next word takes its failure arc, weighted
mu / (c(h) + mu), to h', and the empty state has an arc for every word.  A text is read once from
left to right, carrying the state and adding up log10 weights.

The counts of the whole corpus form one large automaton that no single machine needs:

1. Scan tasks cut their rows into chunks of about ``CHUNK_BYTES`` of text.  A chunk sends every
   distinct n-gram of its texts once, with its count in the chunk's training texts, to the
   partition that owns the n-gram (a range of its hash).  Counts are thus added up before the
   shuffle, and the commonest n-gram arrives once a chunk.
2. Owners add up, one range at a time, and answer each chunk with the corpus-wide counts of what
   it sent.  Every owner has two ranges of the same width.
3. Answers meet the chunk's texts, which form the part of the automaton that these texts can reach
   (exactly: other arcs never match) and traverse it, all moves at once by array passes.

A task holds one chunk (or one longer text) or its share of the n-grams, whatever the size of the
corpus; the share is set by ``spark.sql.shuffle.partitions``.  ``docs`` is read twice and must be a
scan or a narrow step after one, so that both readings form the same chunks; if they differ the job
fails instead of answering wrongly.

Words are keyed by 128 bits of hash and longer n-grams by 64.

Defined results: a null text counts as empty, an empty text is one end token; a null id is not held
out; repeated rows count and are scored each; without training texts every chance is one; no rows
give no rows; only the id, the text and the given condition are read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import spread_scan, write_table
from tessera.session import ship_package

ORDER, MU = 2, 100.0
#: Text of one chunk.
CHUNK_BYTES = 3 << 20
#: Neither can be a word, as both hold a space.
START, END = b" start", b" end"

REQUEST = "bucket int, chunk bigint, ord int, n int, keys binary, rest binary, counts binary"
ANSWER = "chunk bigint, bucket int, ord int, n int, counts binary, vocabulary bigint, tokens bigint"


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers: the first one whole, the others as the byte planes that their largest needs."""
    if not len(x):
        return b""
    x = x.astype("<u8")
    width = max(1, (int(x[1:].max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + x[:1].tobytes() + x[1:].view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.uint64)
    raw, width = np.frombuffer(b, np.uint8), b[0]
    x = np.zeros((1 + (len(raw) - 9) // width, 8), np.uint8)
    x[0] = raw[1:9]
    x[1:, :width] = raw[9:].reshape(width, -1).T
    return x.view("<u8").ravel().astype(np.uint64, copy=False)


def word_keys(words: list[bytes]) -> np.ndarray:
    """128 bits a word, as rows of two numbers."""
    import xxhash

    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), ">u8").reshape(-1, 2).astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cut_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words in order of their first place, the number there of each word of the texts, one
    after another, words of each text): A-Z lower-cased, parted by the six ASCII spaces only."""
    lower = b"\n".join([*texts, b""]).lower()
    whole = np.frombuffer(lower, np.uint8)
    words, numbers, held = coded_words(lower, (whole != 32) & (whole - np.uint8(9) > 4), [len(t) for t in texts])  # 9 to 13 and 32 part words
    return words.to_numpy(zero_copy_only=False).tolist(), numbers, held


def coded_words(raw: bytes, letter: np.ndarray, sizes: list[int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``cut_words`` of texts of these sizes, each with one more byte behind it that is no letter;
    ``letter`` tells which bytes belong to words."""
    before = np.concatenate([[False], letter])
    starts = np.flatnonzero(letter & ~before[:-1])
    lengths = np.flatnonzero(~letter & before[:-1]) - starts
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=places[1:])
    cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.frombuffer(raw, np.uint8)[letter])])
    coded = cut.dictionary_encode()
    ends = np.cumsum(sizes, dtype=np.int64) + np.arange(1, len(sizes) + 1)
    held = np.diff(np.searchsorted(starts, ends), prepend=0)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), held


def sorted_by(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Order of 128-bit numbers; the lower half decides only where upper ones are equal."""
    order = np.argsort(high)
    return np.lexsort((low, high)) if (high[order][1:] == high[order][:-1]).any() else order


class Grams:
    """The distinct n-grams of some texts, up to an order, with what links them.

    Tokens stand one after another, every text as start, words, end.  By order (list index, 1-based):
    ``at`` the number of the n-gram that ends at a token (-1 if there is none), ``context`` and
    ``suffix`` the numbers of the n-gram without its last and first word, ``word`` its last word,
    ``keys`` its hash, ``order_of`` the numbers sorted by key, ``trained`` the counts in the texts
    marked as training."""

    def __init__(self, texts: list[bytes], training: np.ndarray, order: int):
        words, numbers, held = cut_words(texts)
        sizes = held + 2
        self.sizes, self.ends = sizes, np.cumsum(sizes)
        self.starts = self.ends - sizes
        ids = np.full(int(sizes.sum()), -1)
        ids[self.starts], ids[self.ends - 1] = 0, 1
        ids[ids < 0] = numbers + 2
        first = np.zeros(len(ids), bool)
        first[self.starts] = True
        learned = np.repeat(training, sizes)
        wide = len(words) + 2
        keys = word_keys([START, END, *words])
        self.words, self.at = wide, [None, ids]
        self.context, self.suffix, self.word = [None, None], [None, None], [None, np.arange(wide)]
        self.keys, self.rest = [None, keys[:, 0]], keys[:, 1]
        self.order_of = [None, sorted_by(keys[:, 0], keys[:, 1])]
        self.trained = [None, np.bincount(ids[learned], minlength=wide)]
        for m in range(2, order + 1):
            below = self.at[m - 1]
            before = np.concatenate([[-1], below[:-1]])
            there = np.flatnonzero((before >= 0) & ~first) if m == 2 else np.flatnonzero((before >= 0) & (below >= 0) & ~first)
            pair = before[there] * wide + ids[there]
            sort = np.argsort(pair)
            new = np.concatenate([[True], np.diff(pair[sort]) != 0])[:len(pair)]
            which = np.empty(len(pair), np.int64)
            which[sort] = np.cumsum(new) - 1
            at = np.full(len(ids), -1)
            at[there] = which
            place = there[sort[new]]  # a token at which each n-gram ends
            self.at.append(at)
            self.context.append(before[place])
            self.suffix.append(below[place])
            self.word.append(ids[place])
            self.keys.append(_mixed(self.keys[m - 1][before[place]] * np.uint64(0x9E3779B97F4A7C15) + keys[ids[place], 0] + np.uint64(m)))
            self.order_of.append(np.argsort(self.keys[m]))
            self.trained.append(np.bincount(which[learned[there]], minlength=len(place)))


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted keys pass from one bucket (an even range of hashes) to the next."""
    cuts = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])


def requests(grams: Grams, chunk: int, buckets: int) -> Iterator[tuple]:
    for m in range(1, len(grams.keys)):
        order = grams.order_of[m]
        keys, counts = grams.keys[m][order], grams.trained[m][order]
        rest = grams.rest[order] if m == 1 else None
        bounds = bucket_bounds(keys, buckets)
        for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if i < j:
                mine = keys[i:j].copy()
                mine[1:] -= keys[i:j - 1]
                yield (b, chunk, m, int(j - i), planes(mine), None if rest is None else rest[i:j].tobytes(), planes(counts[i:j]))


def to_owners(asked: DataFrame, parts: int) -> DataFrame:
    """Requests by bucket, every partition with as many buckets as any other (hashed bucket numbers
    would bring some partitions three times the mean)."""
    return asked.repartitionById(parts, "bucket")


def by_bucket(batches, *names: str) -> dict[tuple, list[dict]]:
    """Request rows of a task by bucket and these columns.  What belongs to a bucket is added up on its
    own, and the batches, which may hold all that the task gets, go here."""
    got: dict[tuple, list[dict]] = defaultdict(list)
    for batch in batches:
        for row in batch.to_pylist():
            got[row["bucket"], *(row[n] for n in names)].append(row)
    return got


def add_up(rows: list[dict]) -> tuple[list[np.ndarray], int, int]:
    """For request rows of one order that hold all requests for their n-grams: the corpus-wide
    counts in the order of the requests, the number of distinct trained n-grams and their total,
    without the start of texts."""
    keys = np.concatenate([np.cumsum(from_planes(r["keys"]), dtype=np.uint64) for r in rows])
    counts = np.concatenate([from_planes(r["counts"]) for r in rows]).astype(np.int64)
    if rows[0]["rest"] is None:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = keys[1:] != keys[:-1]
        start = np.zeros(len(keys), bool)
    else:
        rest = np.concatenate([np.frombuffer(r["rest"], np.uint64) for r in rows])
        order = np.lexsort((rest, keys))
        keys, rest = keys[order], rest[order]
        new = (keys[1:] != keys[:-1]) | (rest[1:] != rest[:-1])
        own = word_keys([START])[0]
        start = (keys == own[0]) & (rest == own[1])
    firsts = np.concatenate([[0], np.flatnonzero(new) + 1])
    sums = np.add.reduceat(counts[order], firsts)
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(sums, np.diff(np.concatenate([firsts, [len(keys)]])))
    counted = (sums > 0) & ~start[firsts]
    ends = np.cumsum([r["n"] for r in rows])
    return np.split(total, ends[:-1]), int(counted.sum()), int(sums[counted].sum())


class Automaton:
    """The part of the backoff automaton that some texts can reach."""

    def __init__(self, grams: Grams, counts: list, total: int, vocabulary: int, mu: float):
        order, wide = len(grams.keys) - 1, grams.words
        self.wide = wide
        chance = (counts[1] + 1.0) / (total + vocabulary + 1.0)
        self.base = np.log10(chance)
        # The state of every n-gram below the order: its own if it was met, else that of its suffix.
        state, first_free, fails, fail_weights = [None], 1, [np.zeros(1, np.int64)], [np.zeros(1)]
        for m in range(1, max(order, 2)):
            met = (counts[m] > 0) & (grams.word[m] != 1)  # nothing follows the end of a text
            below = np.zeros(len(met), np.int64) if m == 1 else state[m - 1][grams.suffix[m]]
            own = below.copy()
            own[met] = first_free + np.arange(int(met.sum()))
            first_free += int(met.sum())
            fails.append(below[met])
            fail_weights.append(np.log10(mu / (counts[m][met] + mu)))
            state.append(own)
        self.order, self.state = order, state
        self.next_empty = state[1] if order > 1 else np.zeros(wide, np.int64)
        self.fail, self.fail_weight = np.concatenate(fails), np.concatenate(fail_weights)
        self.depth = np.repeat(np.arange(len(fails)), list(map(len, fails)))  # words of each state's context
        sources, weights, following, self.arc, arcs = [], [], [], [None, None], 0
        for m in range(2, order + 1):
            context, suffix = grams.context[m], grams.suffix[m]
            weighed = counts[m - 1][context]
            chance = np.where(weighed > 0, (counts[m] + mu * chance[suffix]) / (weighed + mu), chance[suffix])
            met = counts[m] > 0
            sources.append(state[m - 1][context[met]] * wide + grams.word[m][met])
            weights.append(np.log10(chance[met]))
            following.append(state[m][met] if m < order else state[m - 1][suffix[met]])
            # The arc of every n-gram, from its context's state by its last word; -1: that state has none.
            self.arc.append(np.where(met, arcs + np.cumsum(met) - 1, -1))
            arcs += len(weights[-1])
        self.sources = np.concatenate(sources) if sources else np.empty(0, np.int64)
        self.weight = np.concatenate(weights) if sources else np.empty(0)
        self.next = np.concatenate(following) if sources else np.empty(0, np.int64)

    @cached_property
    def arcs(self) -> dict[int, int]:
        """Arc by state * wide + word."""
        return dict(zip(self.sources.tolist(), range(len(self.sources)), strict=True))

    def traverse(self, grams: Grams) -> np.ndarray:
        """log10 chance of each text, by one traversal from the state of its start.

        All moves are made at once, by array passes: the state after a token is that of the longest
        n-gram ending there, so every move's first state is known beforehand, and the state that the
        move itself leads to, by failure arcs and one arc, must be the next move's."""
        states = np.zeros(len(grams.at[1]), np.int64)
        for m in range(1, self.order):
            there = np.flatnonzero(grams.at[m] >= 0)
            states[there] = self.state[m][grams.at[m][there]]
        token = np.ones(len(states), bool)
        token[grams.starts] = False
        token = np.flatnonzero(token)
        at, reached = states[token - 1], np.empty(len(token), np.int64)
        lost = np.zeros((len(token), self.order))  # weights of a move in the order of its arcs
        left = np.arange(len(token))
        for m in range(self.order, 1, -1):
            deep = self.depth[at[left]] == m - 1
            here = left[deep]
            arc = self.arc[m][grams.at[m][token[here]]]
            found, failed = here[arc >= 0], here[arc < 0]
            arc = arc[arc >= 0]
            lost[found, self.order - m], reached[found] = self.weight[arc], self.next[arc]
            lost[failed, self.order - m] = self.fail_weight[at[failed]]
            at[failed] = self.fail[at[failed]]
            left = np.concatenate([left[~deep], failed])
        word = grams.at[1][token[left]]
        lost[left, -1], reached[left] = self.base[word], self.next_empty[word]
        if not np.array_equal(reached, states[token]):
            raise RuntimeError("a move of the automaton led to another state than the n-grams tell")
        # bincount adds up one by one, in the order of the moves.
        text = np.repeat(np.arange(len(grams.sizes)), (grams.sizes - 1) * self.order)
        return np.bincount(text, weights=lost.ravel(), minlength=len(grams.sizes))


def chunked(batches, text_at: int, limit: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(chunk, rows) of one task, in order; a chunk may come in several pieces."""
    from pyspark import TaskContext

    chunk, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_at).cast(pa.binary())), 0), np.int64)
        at = 0
        while at < batch.num_rows:
            until = at + int(np.searchsorted(np.cumsum(size[at:]) + held, limit)) + 1  # the row that reaches the limit is the last
            until = min(until, batch.num_rows)
            held += int(size[at:until].sum())
            yield chunk, batch.slice(at, until - at)
            if held >= limit:
                chunk, held = chunk + 1, 0
            at = until


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    mu: float = MU, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row: id, held_out, n_tokens, n_known, train_tokens, base_score (log10 chance by
    single words) and score (log10 chance by the model).  Texts where ``held_out`` holds are scored
    but not learned from."""
    if order < 1 or mu <= 0:
        raise ValueError("order must be at least 1 and mu positive")
    spark = docs.sparkSession
    ship_package(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = spread_scan(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                   F.coalesce(held_out, F.lit(False)).alias("held")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * parts

    def ask(batches):
        names = [c.split()[0] for c in REQUEST.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def of(chunk, texts, held):
            found = list(requests(Grams(texts, ~np.array(held, bool), order), chunk, buckets))
            for i in range(0, len(found), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found[i:i + 64], strict=True), types, strict=True)], names)

        at, texts, held = None, [], []
        for chunk, piece in chunked(batches, 1, chunk_bytes):
            if chunk != at and texts:
                yield from of(at, texts, held)
                texts, held = [], []
            at = chunk
            texts += _texts(piece.column(1))
            held += piece.column(2).to_pylist()
        if texts:
            yield from of(at, texts, held)

    def answer(batches):
        got = by_bucket(batches, "ord")
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in ANSWER.split(", ")]
        while got:
            (_, m), mine = got.popitem()
            totals, distinct, sums = add_up(mine)
            out = [(r["chunk"], r["bucket"], m, r["n"], planes(t), None, None) for r, t in zip(mine, totals, strict=True)]
            if m == 1:
                out.append((-1, -1, 1, 0, None, distinct, sums))
            del mine, totals
            for i in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 64], strict=True), types, strict=True)], names)

    answers = write_table(to_owners(rows.mapInArrow(ask, REQUEST), parts).mapInArrow(answer, ANSWER))
    whole = answers.where("chunk = -1").agg(F.sum("vocabulary").alias("v"), F.sum("tokens").alias("n")).first()
    vocabulary, total = int(whole["v"] or 0), int(whole["n"] or 0)

    def place(batches):
        for chunk, piece in chunked(batches, 1, chunk_bytes):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(np.full(piece.num_rows, chunk), pa.int64())],
                                             [*piece.schema.names, "chunk"])

    def traverse(texts: pa.Table, replies: pa.Table) -> pa.Table:
        grams = Grams(_texts(texts.column("text")), ~np.array(texts.column("held").to_pylist(), bool), order)
        counts: list = [None]
        for m in range(1, order + 1):
            mine = sorted(((b, n, c) for o, b, n, c in zip(*(replies.column(x).to_pylist() for x in ("ord", "bucket", "n", "counts")), strict=True)
                           if o == m), key=lambda x: x[0])
            if sum(n for _, n, _ in mine) != len(grams.keys[m]):
                raise RuntimeError("the texts of a chunk differ between two readings; write the input as a table first")
            own = np.zeros(len(grams.keys[m]), np.int64)
            if mine:
                own[grams.order_of[m]] = np.concatenate([from_planes(c) for _, _, c in mine]).astype(np.int64)
            counts.append(own)
        machine = Automaton(grams, counts, total, vocabulary, mu)
        ids, known = grams.at[1], counts[1] > 0
        base, met = [], []
        for a, b in zip((grams.starts + 1).tolist(), grams.ends.tolist(), strict=True):
            base.append(math.fsum(machine.base[ids[a:b]].tolist()))
            met.append(int(known[ids[a:b]].sum()))
        scores = machine.traverse(grams)
        return pa.table({"id": texts.column("id"), "held_out": texts.column("held"), "n_tokens": pa.array(grams.sizes - 1, pa.int64()),
                         "n_known": pa.array(met, pa.int64()), "train_tokens": pa.array([total] * len(met), pa.int64()),
                         "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    placed = rows.mapInArrow(place, f"id {id_type}, text string, held boolean, chunk bigint")
    replies = answers.where("chunk >= 0").select("chunk", "bucket", "ord", "n", "counts")
    scored: Callable = placed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow
    return scored(traverse, f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                            "base_score double, score double").withColumnRenamed("id", id_col)
