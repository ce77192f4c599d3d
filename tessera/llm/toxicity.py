"""Toxicity: Levenshtein automata over a lexicon trie, and context windows.

* The lexicon (whole words, and stems of words) is learned from a bounded sample of labelled
  documents by a likelihood-ratio test on document counts.
* The trie of the lexicon is intersected with the Levenshtein automaton of the allowed edits:
  a state is the set of (trie node, edits so far) reachable by the letters read.  States are
  made deterministic as they are met and kept, so a word costs one lookup a letter, and words
  far from every entry die after a few letters.
* A hit's context window tells quotation (quotation marks on both sides, words of saying or
  naming) from abuse (words of address, exclamation); the document's hits by kind and context
  go into a logistic score fitted on the same sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Bounded, arrow_pass, slices, spread_scan, texts_of

#: Labelled documents of each label that are fitted on, about (all if there are fewer).
TRAIN_DOCS = 1500
MAX_ENTRIES = 500
#: Likelihood ratio (chi-square, one degree of freedom) and precision an entry must reach.
MIN_G2 = 22.0
MIN_PRECISION = 0.8
#: Precision that an entry must reach if earlier entries reach nearly all of its documents.
REPEAT_PRECISION = 0.97
STEM_LENGTHS = range(4, 9)
WINDOW = 6

OPENING, CLOSING = "\"“„«‘'`", "\"”“»’'`"
#: Words that report or name speech, and words that address someone (a fixed list).
REPORTING = frozenset("said says say saying called calls word words term terms quote quoted quotes "
                      "slur insult means meaning wrote dit mot terme appelle sagt sagte wort nennt dice dijo palabra".split())
ADDRESS = frozenset("you your you're youre u ur du dich dein ihr tu te toi vous ton eres tú usted".split())
LETTERS = re.compile(r"[^\W\d_]+")
LEET = str.maketrans("013457@$", "oieastas")
FEATURES = ("words", "word_share", "stem", "stem_share", "quoted", "addressed", "distinct", "lone_stem")
#: What a hit counts for by its kind.
COUNTS = {"exact": 1.0, "near": 0.8, "far": 0.6}
#: An entry is matched without edits if its misspellings are in more clean documents than this
#: share (and in more than one).
NOISY = 0.0005


def edits_allowed(entry: str) -> int:
    """Edits that a word may be away from an entry; none for stems (``*``) and for words marked
    ``=``, whose misspellings are words of clean text."""
    return 0 if len(entry) < 5 or entry[-1] in "*=" else 1 if len(entry) < 9 else 2


class Lexicon:
    """Deterministic Levenshtein-trie automaton, built lazily.

    Entries ending in ``*`` are stems: any word that starts with the stem is a hit.  Entries
    ending in ``=`` are matched without edits."""

    def __init__(self, entries: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.allowed: list[int] = [0]  # most edits of any entry below a node
        for entry in entries:
            stem, letters = entry.endswith("*"), entry.rstrip("*=")
            node, allowed = 0, edits_allowed(entry)
            self.allowed[0] = max(self.allowed[0], allowed)
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], allowed)
            (self.stem if stem else self.word)[node] = entry
        self.states: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []  # by state; -1 is the dead state
        self.found: list[tuple | None] = []
        self.start = self._number(self._close({(0, 0)}))

    def _number(self, state: frozenset) -> int:
        if not state:
            return -1
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.found.append(self._ends(state))
        return self.numbers[state]

    def _close(self, state: set) -> frozenset:
        """With the entry letters that a word may leave out; of a node the fewest edits stay."""
        best: dict[int, int] = {}
        todo = list(state)
        while todo:
            node, e = todo.pop()
            if e > self.allowed[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo.extend((child, e + 1) for child in self.children[node].values())
        return frozenset(best.items())

    def _move(self, state: frozenset, c: str) -> frozenset:
        after: set = set()
        for node, e in state:
            for letter, child in self.children[node].items():
                after.add((child, e if letter == c else e + 1))
            after.add((node, e + 1))
        return self._close(after)

    def _ends(self, state: frozenset) -> tuple | None:
        """(edits, entry) of the nearest whole word of a state."""
        return min(((e, self.word[node]) for node, e in state
                    if self.word[node] and e <= edits_allowed(self.word[node])), default=None)

    def match(self, word: str) -> tuple[str, str] | None:
        """(kind, entry): exact, near (one edit), far (more), stem, or None."""
        node, stem = 0, None
        for c in word:  # stems are read without edits
            node = self.children[node].get(c, -1)
            if node < 0:
                break
            stem = self.stem[node] or stem
        state, moves = self.start, self.moves
        for c in word:
            row = moves[state]
            after = row.get(c)
            if after is None:
                after = row[c] = self._number(self._move(self.states[state], c))
            if after < 0:
                break
            state = after
        else:
            end = self.found[state]
            if end:
                return ("exact", "near", "far")[min(end[0], 2)], end[1]
        return ("stem", stem) if stem else None


def forms(token: str) -> list[str]:
    """The words of a token between spaces: its letter runs, and with look-alike signs as letters
    where signs stand among letters."""
    low = token.lower()
    runs = LETTERS.findall(low)
    if len(runs) == 1 and len(runs[0]) + 2 >= len(low) and low[:1].isalpha():
        return runs
    swapped = low.translate(LEET)
    if swapped != low and runs:
        runs += [r for r in LETTERS.findall(swapped.strip("0123456789@$")) if r not in runs and len(r) > 3]
    return runs


class Scorer:
    """Features and score of texts; holds the automaton and a memo of tokens."""

    def __init__(self, entries: list[str], weights: list[float], bias: float):
        self.lexicon, self.weights, self.bias = Lexicon(entries), np.array(weights), bias
        self.hits = Bounded(500_000)

    def _hit(self, token: str) -> tuple[str, str] | None:
        order = ("exact", "near", "far", "stem")
        found = [m for f in forms(token) if (m := self.lexicon.match(f))]
        return min(found, key=lambda m: order.index(m[0]), default=None)

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        new = set(filterfalse(self.hits.__contains__, tokens))
        if len(new) + len(self.hits) > self.hits.limit:
            self.hits.clear()
            new = set(tokens)
        self.hits.update((t, self._hit(t)) for t in new)
        at = [i for i, m in enumerate(map(self.hits.__getitem__, tokens)) if m]
        if not at:
            return [0.0] * len(FEATURES)
        kinds, quoted, addressed, distinct = Counter(), 0, 0, set()
        for i in at:
            kind, entry = self.hits[tokens[i]]
            kinds[kind] += 1
            distinct.add(entry)
            before, after = tokens[max(0, i - WINDOW):i + 1], tokens[i:i + WINDOW + 1]
            marks = any(t[0] in OPENING for t in before) and any(t.rstrip(".,;:!?")[-1:] in CLOSING and t.rstrip(".,;:!?") for t in after)
            words = {w for t in before[:-1] + after[1:] for w in LETTERS.findall(t.lower())}
            quoted += marks or bool(words & REPORTING)
            addressed += bool(words & ADDRESS) or tokens[i].endswith("!")
        n, total = len(tokens), len(at)
        plain = sum(kinds[k] * c for k, c in COUNTS.items())
        return [math.log1p(plain), math.sqrt(plain / n), math.log1p(kinds["stem"]), math.sqrt(kinds["stem"] / n),
                quoted / total, addressed / total, math.log1p(len(distinct)), float(total == kinds["stem"] == 1)]

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _g2(a: int, b: int, p: int, n: int) -> float:
    """Likelihood ratio of a of p against b of n documents."""
    def part(k, m, q):
        return (k * math.log(k / (m * q)) if k else 0.0) + ((m - k) * math.log((m - k) / (m * (1 - q))) if k < m else 0.0)

    q = (a + b) / (p + n)
    return 2 * (part(a, p, q) + part(b, n, q)) if 0 < q < 1 else 0.0


def learn_lexicon(texts: list[str], labels: list[int]) -> list[str]:
    """Words and stems found in toxic documents far more often than chance allows.

    A document counts for a word only if the word stands between neighbours not met in a document
    before, so a group of copies of one toxic document doesn't make its other words entries.

    Of entries with the same evidence the longest stays; an entry stays only if it adds
    documents to those that the entries before it reach, or is a word of its own."""
    toxic, clean, where = Counter(), Counter(), {}
    p, n = sum(labels), len(labels) - sum(labels)
    if not p or not n:
        return []
    met: set[int] = set()
    for k, (text, label) in enumerate(zip(texts, labels, strict=True)):
        words = LETTERS.findall(text.lower())
        fresh = set()  # words between neighbours that no earlier document has around them
        for w, around in zip(words, zip(["", *words], words, [*words[1:], ""]), strict=False):
            if (h := hash(around)) not in met:
                met.add(h)
                fresh.add(w)
        found = {w for w in fresh if len(w) > 3} | {w[:s] + "*" for w in fresh for s in STEM_LENGTHS if len(w) > s}
        (toxic if label else clean).update(found)
        if label:
            for f in found:
                where.setdefault(f, []).append(k)
    scored = []
    for f, a in toxic.items():
        b = clean[f]
        precise = (a / p) / (a / p + b / n)
        if a >= 3 and precise >= MIN_PRECISION and (g := _g2(a, b, p, n)) >= MIN_G2:
            scored.append((round(g, 6), not f.endswith("*"), len(f), f, precise))
    chosen: list[str] = []
    reached: Counter = Counter()
    for _, word, _, f, precise in sorted(scored, reverse=True):
        letters = f.rstrip("*")
        if precise < REPEAT_PRECISION and sum(reached[k] == 0 for k in where[f]) < 3:
            continue
        if any(c.endswith("*") and letters.startswith(c[:-1]) or letters == c[:-1] for c in chosen if c.endswith("*")):
            continue
        if not word and any(c.startswith(letters) for c in chosen):
            continue
        chosen.append(f)
        reached.update(where[f])
        if len(chosen) >= MAX_ENTRIES:
            break
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method on weighted rows."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (p - y)) / weight.sum() + penalty / len(x) * w
        h = (a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a / weight.sum() + np.diag(penalty / len(x) + 1e-9)
        step = np.linalg.solve(h, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _without_noise(entries: list[str], clean: list[str]) -> list[str]:
    """Entries whose misspellings clean texts hold are marked to be matched without edits."""
    scorer, found = Scorer(entries, [0.0] * len(FEATURES), 0.0), Counter()
    for text in clean:
        scorer.features(text)
        found.update({m[1] for t in set(text.split()) if (m := scorer.hits.get(t)) and m[0] in ("near", "far")})
    limit = max(1, NOISY * len(clean))
    return [e + "=" if found[e] > limit else e for e in entries]


def fit(texts: list[str], labels: list[int], totals: dict[int, int] | None = None) -> dict:
    """The model from labelled texts; ``totals`` are the label counts of the whole training set,
    to which the sample's classes are weighted back."""
    entries = learn_lexicon(texts, labels)
    y = np.array(labels, float)
    have = Counter(labels)
    totals = totals or have
    if len(have) < 2:
        rate = float(y.mean()) if len(y) else 0.0
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return {"entries": [], "weights": [0.0] * len(FEATURES), "bias": math.log(rate / (1 - rate))}
    entries = _without_noise(entries, [t for t, k in zip(texts, labels, strict=True) if not k])
    scorer = Scorer(entries, [0.0] * len(FEATURES), 0.0)
    x = np.array([scorer.features(t) for t in texts])
    weight = np.array([totals[k] / have[k] for k in labels])
    weights, bias = fit_logistic(x, y, weight, ridge=1.0)
    return {"entries": entries, "weights": weights.tolist(), "bias": bias}


def train(docs: DataFrame, labels: DataFrame, held_out, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> dict:
    """Fit on about ``train_docs`` documents of each label, chosen by a hash of the id among rows
    for which ``held_out(id column)`` is false.  Only these ids are broadcast and only their texts
    reach the driver, so both are bounded by the parameter.  Null ids, labels and texts are left out."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    unit = F.xxhash64(F.lit(17), "doc_id").bitwiseAND(F.lit((1 << 31) - 1)) / F.lit(float(1 << 31))
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, train_docs / n))).otherwise(share)
    chosen = known.where(unit < share).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
             .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").toPandas().sort_values(["doc_id", "text"]))
    return fit(texts["text"].tolist(), texts["label"].astype(int).tolist(), totals)


_SCORERS: dict[tuple, Scorer] = {}


def scorer_of(model: dict) -> Scorer:
    """One per model and Python worker."""
    key = (tuple(model["entries"]), tuple(model["weights"]), model["bias"])
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model["entries"], model["weights"], model["bias"])
    return _SCORERS[key]


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``: the toxicity of every whole text, 0 to 1.

    A narrow pass; only the text is read by the score.  A null text scores like an empty one,
    repeated rows get equal scores, and every column of ``docs`` is kept as it is."""
    at = docs.columns.index(text_col)

    def rows(batches):
        scorer = scorer_of(model)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scorer.scores(texts), pa.float64())],
                                             [*batch.schema.names, score_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{score_col}` double"])
    return arrow_pass(spread_scan(docs), schema, rows)
