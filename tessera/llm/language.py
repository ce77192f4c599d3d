"""Language identification by error-correcting output codes.

Every language has a binary codeword.  For each bit a binary n-gram classifier separates the
languages whose codeword has a one there from the others: the log-odds of hashed character
n-grams (one to four characters, within words and their borders).  A text's margin for a bit
is the mean log-odds of all its n-grams, scaled on the training sample.  Loss-weighted decoding
sums a loss of bit times margin, each bit weighted by its accuracy in training, and chooses the
codeword of least loss; a second codeword nearly as close flags the text as ambiguous.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import chain, combinations, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, slices, spread_scan

#: Documents of each language that are fitted on, about (all if there are fewer).
TRAIN_DOCS = 500
HASH_BITS = 15
MAX_N = 4
#: Share of the probability that the runner-up must not reach.
AMBIGUOUS = 0.25
UNDECIDED = "und"
MEMO_WORDS = 500_000


def codewords(k: int) -> np.ndarray:
    """k codewords (rows) of -1 and 1: all ways to split up to six languages in two; beyond that a
    fixed random code whose closest rows are far apart."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        columns = [[1 if i == 0 or i in c else -1 for i in range(k)]
                   for n in range(k - 1) for c in combinations(range(1, k), n)]
        return np.array(columns).T.astype(float)
    bits, best, far = int(10 * np.ceil(np.log2(k))), None, -1
    rng = np.random.default_rng(7)
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (k, bits))
        gap = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(k), 2))
        if gap > far and (np.abs(code.sum(axis=0)) < k).all():
            best, far = code, gap
    return best


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words with one space on either side."""
    joined = " " + "".join(w + " " for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    blank = code == 32
    word = np.cumsum(blank) - 1  # of a letter its word; of a space the word after it
    owners, buckets = [], []
    mixed = np.zeros(len(code), np.uint64)
    for n in range(1, MAX_N + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        mixed = (mixed[:m] if n > 1 else np.zeros(m, np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:] + np.uint64(n)
        inner = np.zeros(m, bool)
        for k in range(1, n - 1):
            inner |= blank[k:k + m]
        ends = blank[n - 1:]
        ok = ~inner & ~(blank[:m] & ends)
        hashed = mixed * np.uint64(0xD6E8FEB86659FD93)
        owners.append(word[:m][ok])
        buckets.append((hashed >> np.uint64(64 - HASH_BITS))[ok].astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Decoder:
    """Scores texts; remembers the summed log-odds of every word met."""

    def __init__(self, model: dict):
        self.languages = model["languages"]
        self.table = np.asarray(model["table"])  # bucket x bit, float32
        self.scale, self.weight = np.asarray(model["scale"]), np.asarray(model["weight"])
        self.code = codewords(len(self.languages))
        self._fresh()

    def _fresh(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((4096, self.table.shape[1] + 1))

    def _learn(self, words: list[str]) -> None:
        start = len(self.index)
        while start + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.index.update(zip(words, range(start, start + len(words)), strict=True))
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            owner, bucket = gram_buckets(part)
            order = np.argsort(owner, kind="stable")
            owner, bucket = owner[order], bucket[order]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            to = self.rows[start + at:start + at + len(part)]
            to[owner[first], :-1] = np.add.reduceat(self.table[bucket], first, axis=0, dtype=np.float64)
            to[owner[first], -1] = np.diff(np.r_[first, len(owner)])

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean log-odds of each text's n-grams, a column for each bit."""
        split = [words_of(t) for t in texts]
        new = list(dict.fromkeys(filterfalse(self.index.__contains__, chain.from_iterable(split))))
        if len(new) + len(self.index) > MEMO_WORDS and self.index:
            self._fresh()
            new = list(dict.fromkeys(chain.from_iterable(split)))
        if new:
            self._learn(new)
        out = np.zeros((len(texts), self.table.shape[1]))
        for k, words in enumerate(split):
            if words:
                total = self.rows[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))].sum(axis=0)
                out[k] = total[:-1] / max(total[-1], 1)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) of each text."""
        known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        out = [(UNDECIDED, 0.0, False)] * len(texts)
        if not known or not self.languages:
            return out
        chance = self.probabilities(self.margins([texts[k] for k in known]))
        order = np.argsort(-chance, axis=1, kind="stable")
        for row, k in enumerate(known):
            best = order[row, 0]
            second = chance[row, order[row, 1]] if len(self.languages) > 1 else 0.0
            out[k] = (self.languages[best], float(chance[row, best]), bool(second >= AMBIGUOUS))
        return out

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        z = margins * self.scale
        loss = np.stack([(self.weight * np.logaddexp(0, -z * word)).sum(axis=1) for word in self.code], axis=1)
        chance = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        return chance / chance.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str]) -> dict:
    """Bit classifiers of labelled texts."""
    languages = sorted(set(langs))
    code = codewords(len(languages))
    counts = np.zeros((len(languages), 1 << HASH_BITS))
    for text, lang in zip(texts, langs, strict=True):
        words = words_of(text)
        if words:
            _, bucket = gram_buckets(words)
            # Every text has the same say, however long it is.
            counts[languages.index(lang)] += np.bincount(bucket, minlength=1 << HASH_BITS) / len(bucket)
    rates = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-12)
    smooth = 1e-6

    def side(rows: np.ndarray) -> np.ndarray:
        return np.log((rates[rows].mean(axis=0) if rows.any() else np.zeros(rates.shape[1])) + smooth)

    bits = code.shape[1] if len(languages) > 1 else 1
    table = np.zeros((1 << HASH_BITS, bits), np.float32)
    if len(languages) > 1:
        for b in range(bits):
            table[:, b] = side(code[:, b] > 0) - side(code[:, b] < 0)
    model = {"languages": languages, "table": table, "scale": np.ones(bits), "weight": np.ones(bits)}
    if len(languages) > 1:
        margins = Decoder(model).margins(texts)
        truth = code[[languages.index(x) for x in langs]]
        model["scale"] = 4.0 / np.maximum(np.abs(margins).mean(axis=0), 1e-6)
        right = np.clip((margins * truth > 0).mean(axis=0), 0.51, 0.999)
        model["weight"] = np.log(right / (1 - right)) / np.log(0.999 / 0.001) * 2 / np.sqrt(bits)
    return model


def train(docs: DataFrame, held_out: Callable, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict:
    """Fit on about ``train_docs`` documents of each language, chosen by a hash of the id among
    rows with a language for which ``held_out(id column)`` is false (null counts as false).  One
    count over the label column, then only the chosen texts reach the driver."""
    known = (docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, train_docs / n))).otherwise(share)
    unit = F.xxhash64(F.lit(23), "doc_id").bitwiseAND(F.lit((1 << 31) - 1)) / F.lit(float(1 << 31))
    rows = known.where(unit < share).toPandas().sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), rows["lang"].tolist())


_DECODERS: dict[str, Decoder] = {}


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every whole text.

    A narrow pass; the model (2^15 buckets x bits) is one broadcast variable of fixed size.  A
    null text, or one without a letter, is ``und`` with score 0; without training rows all are;
    null ids stay null, repeated rows give repeated rows, other columns are ignored."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def rows(batches):
        if key not in _DECODERS:
            _DECODERS.clear()
            _DECODERS[key] = Decoder(shared.value)
        decoder = _DECODERS[key]
        for batch in slices(batches):
            lang, score, ambiguous = zip(*decoder.predict(batch.column(1).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return arrow_pass(spread_scan(source), f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean", rows)
