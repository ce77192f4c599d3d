"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``min_length`` words and ``min_exponent`` periods long, that no neighbouring word extends.

* Words are appended to a suffix automaton.  Every node of its link tree has a colour, the position
  at which the node's strings ended last.  A new word recolours the path from the new state to the
  root; link-cut access (splay trees over paths of one colour) does so in a logarithmic number of
  steps a word, however deep the tree is.
* Each path segment met on the way gives the distance p between its strings' previous and new end.
  Where p is at most the length of the segment's longest string, the last 2p words are a square,
  and p is the smallest period there.  The square is extended both ways to its run, unless that
  run is known; a run of period q shows at its 2q-th word at the latest.
* Only stretches that can hold a run are appended.  In a run every window of
  ``window(min_length, min_exponent)`` words comes twice, so a stretch whose windows don't come
  twice within it holds none.  This test drops no run.

A narrow pass: one text is handled whole, its automaton has at most two states a word.

Defined results: a null text has no words, no runs and a null collapsed text; an empty one an empty
collapsed text; repeated rows give repeated rows; no rows give no rows; columns of the input stay
and the new ones go under the given names.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, slices, spread_scan

MIN_LENGTH, MIN_EXPONENT = 24, 3
OUT = ("runs", "strongest", "collapsed")
#: Words of texts that are searched for repeated windows together.
TOGETHER = 1 << 20


class LinkTree:
    """A suffix automaton whose link tree is held in a link-cut structure.

    Arrays by state: the length of the longest string, the suffix link, the first transition (most
    states have no other; ``more`` has the others), and the splay tree: ``left`` is nearer to the
    root, ``right`` deeper, ``up`` the parent in the tree or, at its root, the node above the path.
    ``colour`` counts at the root of a splay tree for all its nodes."""

    def __init__(self) -> None:
        self.length, self.link, self.word, self.to, self.more = [0], [-1], [-1], [-1], {}
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]
        self.last = 0

    def _state(self, length: int, link: int) -> int:
        for column, value in ((self.length, length), (self.link, link), (self.word, -1), (self.to, -1), (self.left, -1),
                              (self.right, -1), (self.up, link), (self.colour, -1)):
            column.append(value)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make x the root of its path's tree."""
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if p < 0:
                return
            if left[p] == x:
                near = True
            elif right[p] == x:
                near = False
            else:
                return
            g = up[p]
            if g < 0 or (left[g] != p and right[g] != p):
                self.colour[x] = self.colour[p]
                self._rotate(x, p, near)
                return
            if (left[g] == p) == near:
                self._rotate(p, g, near)
                self._rotate(x, p, near)
            else:
                self._rotate(x, p, near)
                self._rotate(x, g, not near)
            top = up[x]
            if top < 0 or (left[top] != x and right[top] != x):
                self.colour[x] = self.colour[g]
                return

    def _rotate(self, x: int, p: int, near: bool) -> None:
        left, right, up = self.left, self.right, self.up
        g = up[p]
        if near:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved >= 0:
            up[moved] = p
        up[p] = x
        up[x] = g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _target(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        others = self.more.get(state)
        return -1 if others is None else others.get(word, -1)

    def _aim(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def append(self, word: int) -> None:
        length, link = self.length, self.link
        p = self.last
        new = self._state(length[p] + 1, 0)
        while p >= 0:
            q = self._target(p, word)
            if q >= 0:
                break
            self._aim(p, word, new)
            p = link[p]
        if p >= 0:
            if length[q] != length[p] + 1:
                # A clone stands right above q, on q's path and with its colour.
                clone = self._state(length[p] + 1, link[q])
                self.word[clone], self.to[clone] = self.word[q], self.to[q]
                if q in self.more:
                    self.more[clone] = dict(self.more[q])
                self._splay(q)
                above = self.left[q]
                self.left[clone], self.left[q], self.up[clone] = above, clone, q
                if above >= 0:
                    self.up[above] = clone
                link[q] = clone
                while p >= 0 and self._target(p, word) == q:
                    self._aim(p, word, clone)
                    p = link[p]
                q = clone
            link[new] = self.up[new] = q
        self.last = new

    def access(self, position: int) -> list[int]:
        """Recolour the path from the last state to the root; the periods of squares that end here."""
        left_over, x, found = -1, self.last, []
        right, up, colour, length = self.right, self.up, self.colour, self.length
        while x >= 0:
            self._splay(x)
            before = colour[x]
            if 0 <= before and position - before <= length[x]:
                found.append(position - before)
            deeper = right[x]
            if deeper >= 0:
                colour[deeper] = before  # a path of its own from now on
            right[x] = left_over
            left_over = x
            x = up[x]
        colour[left_over] = position
        return found


def runs_of(ids: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence, by start and then period."""
    tree, n, out = LinkTree(), len(ids), []
    reached: dict[int, int] = {}  # period -> end of its last known run
    longest = n // min_exponent
    for i, word in enumerate(ids):
        tree.append(word)
        for p in tree.access(i):
            if p > longest or reached.get(p, -1) >= i:
                continue
            end, start = i + 1, i - 2 * p + 1
            while end < n and ids[end] == ids[end - p]:
                end += 1
            while start and ids[start - 1] == ids[start - 1 + p]:
                start -= 1
            reached[p] = end - 1
            if end - start >= max(min_length, min_exponent * p):
                out.append((start, end - start, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def window(min_length: int, min_exponent: int) -> int:
    """The longest window that comes at least twice, wherever it starts, in every run: a run of
    period q has at least max(min_length, min_exponent * q) - window + 1 >= 2 q places for it."""
    if min_exponent < 2 or min_length < min_exponent:
        raise ValueError("runs of at least two periods")
    return (min_exponent - 2) * (min_length // min_exponent) + 1


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key is there more than once."""
    small = (keys >> np.uint64(64 - max(16, int(len(keys)).bit_length() + 4))).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(small)[small] > 1)
    order = maybe[np.argsort(keys[maybe], kind="stable")]
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(ids: np.ndarray, owner: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches that can hold runs.  ``owner`` numbers the texts, which stand
    one after another.  Equal windows have equal keys, so keys that collide only keep more."""
    k = window(min_length, min_exponent)
    least = min_length - k + 1
    place = np.arange(len(ids))
    group = owner
    while True:
        if len(ids) < min_length:
            return []
        size = len(ids) - k + 1
        word = _mixed(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        key = np.zeros(size, np.uint64)
        for t in range(k):
            key = key * np.uint64(0x2545F4914F6CDD1D) + word[t:t + size]
        key = _mixed(key ^ _mixed(group[:size].astype(np.uint64)))
        alive = np.zeros(len(ids) + 1, bool)
        alive[:size] = _repeated(key) & (group[:size] == group[k - 1:])
        # A window that reaches into the next group doesn't count, nor does it join two stretches.
        joins = np.concatenate([[False], alive[:-1] & alive[1:] & (np.concatenate([group, [-1]])[:-1] == np.concatenate([group, [-1]])[1:])])
        starts = np.flatnonzero(alive & ~joins)
        ends = np.flatnonzero(alive & ~np.concatenate([joins[1:], [False]])) + 1
        long = ends - starts >= least
        starts, ends = starts[long], ends[long] + k - 1
        # Stretches of one group may share words: each keeps its own copy of them.
        take = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)]) if len(starts) else np.zeros(0, np.int64)
        if len(take) == len(ids):
            return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(starts, ends, strict=True)]
        ids, place = ids[take], place[take]
        group = np.repeat(np.arange(len(starts)), ends - starts)


def _search(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """Runs of every text, given as its words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long = [k for k, words in enumerate(texts) if len(words) >= min_length]
    at = 0
    while at < len(long):
        chosen, total = [], 0
        while at < len(long) and (not chosen or total + len(texts[long[at]]) <= TOGETHER):
            chosen.append(long[at])
            total += len(texts[long[at]])
            at += 1
        number = defaultdict(count().__next__)
        sizes = np.array([len(texts[k]) for k in chosen])
        ids = np.fromiter((number[w] for k in chosen for w in texts[k]), np.int64, total)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in stretches(ids, np.repeat(np.arange(len(chosen)), sizes), min_length, min_exponent):
            mine = int(np.searchsorted(begins, a, side="right")) - 1
            base = a - int(begins[mine])
            out[chosen[mine]] += [(base + s, n, q) for s, n, q in runs_of(ids[a:b].tolist(), min_length, min_exponent)]
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; of equal ones the first, then the least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what each run holds after its first period, joined by one space."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[k] for k in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
NAMES = ("start", "length", "period")


def find_runs(docs: DataFrame, text_col: str = "text", names: tuple = OUT, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Every column of ``docs`` and then (under ``names``): runs (array of start, length, period; word
    numbers from 0; by start, then period), strongest (the run of most periods, null if there is
    none) and collapsed (the text without what runs repeat).

    Words are runs of bytes other than space, tab, line feeds, form feed and carriage return."""
    at = docs.columns.index(text_col)
    window(min_length, min_exponent)

    def rows(batches):
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            words = [(t or b"").split() for t in texts]  # bytes are split at exactly these six signs
            found = _search(words, min_length, min_exponent)
            best = [strongest(r) for r in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([[dict(zip(NAMES, r, strict=True)) for r in runs] for runs in found], pa.list_(RUN)),
                 pa.array([r and dict(zip(NAMES, r, strict=True)) for r in best], RUN),
                 pa.array([None if t is None else collapsed(w, r) for t, w, r in zip(texts, words, found, strict=True)], pa.string())],
                [*batch.schema.names, *names])

    run = "struct<start:bigint,length:bigint,period:bigint>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        f"`{names[0]}` array<{run}>, `{names[1]}` {run}, `{names[2]}` string"])
    return arrow_pass(spread_scan(docs), schema, rows)


def digest(found: DataFrame, id_col: str = "doc_id", names: tuple = OUT) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text."""
    runs, best, text = map(F.col, names)
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        F.col(id_col).alias("doc_id"), F.size(runs).cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr(f"1000 * `{names[1]}`.length div `{names[1]}`.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("collapsed_sha256"))


def repeat_tail(text: Column, h: Column) -> Column:
    """The text with its words from a = g mod n on replaced by repeats of the first p of them, for
    g = h div 10 and p = 1 + (n - a) div (3 + g mod 8); a text without words stays."""
    def changed(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        g = F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        index = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(index, lambda i: F.get(w, i.cast("int"))), " "))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.coalesce(F.element_at(F.transform(F.array(words), changed), 1), text)  # a lambda splits the text once
