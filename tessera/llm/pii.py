"""Personal data: candidate spans, boosted trees, calibrated thresholds.

1. Fixed formats (email, ip, card, phone) are found as they are defined and always stay.
2. High-recall generators propose overlapping spans around them: digit groups in any grouping
   that could be an address, a card or a phone number, and spelled-out or spaced email forms.
3. Boosted regression trees score every proposal from its format (digits, groups, separators,
   checksum, marks) and its context (neighbouring signs, cue words before it).
4. A threshold for each kind, chosen on held-out proposals for precision, selects spans; of
   overlapping ones the best stays, and none may overlap a fixed one.

No labels exist, so the trees learn from the texts: fixed finds are positive, and so are the
same finds rewritten in place in common disguises; proposals that touch no fixed find, and
decoys made from fixed finds by breaking what makes them valid, are negative.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, slices, spread_scan

KINDS = ("email", "ip", "card", "phone")
#: Documents with a fixed find that the trees are fitted on, about (all if there are fewer).
TRAIN_DOCS = 1500
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3
#: Precision that a kind's threshold must reach on held-out proposals.
PRECISION = 0.995
LONGEST_GROUPS = 6

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Text between two digit groups of one proposal.
GAP = re.compile(r"[\x20.\-/()\[\]_,]{1,3}")
AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\}|@| at )\s?", re.I)
SPELLED = re.compile(r"\(at\)|\[at\]|\{at\}|\(dot\)|\[dot\]|\{dot\}| dot |\s@|@\s", re.I)
SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\}| dot )\s?)[A-Za-z0-9-]{1,63}){1,5}", re.I)
SPELLED_LOCAL = re.compile(r"[A-Za-z0-9_%+-]{1,64}(?:(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\})\s?)[A-Za-z0-9_%+-]{1,64}){0,4}$", re.I)
CUES = {
    "contact": frozenset("email mail e-mail contact write reach address kontakt correo courriel".split()),
    "phone": frozenset("phone tel telephone call fax mobile cell whatsapp telefon teléfono téléphone".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte tarjeta carte".split()),
    "network": frozenset("ip host server ping address ipv4 gateway dns client".split()),
    "number": frozenset("version release isbn order invoice ticket id token key no number section chapter page".split()),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    """A number of at most 255, however it is written."""
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) < 256)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed formats: by kind, leftmost and without overlap, in order;
    matches that fail their test are dropped and nothing is tried again inside them."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((0, start, end))
        at = text.find("@", max(end, at + 1))
    if DIGITS.search(text) is None:
        return out
    for m in DOTTED.finditer(text):  # a chain of numbers holds one match for every four
        parts = list(DIGITS.finditer(m[0]))
        for k in range(0, len(parts) - 3, 4):
            if all(_small(p[0]) for p in parts[k:k + 4]):
                out.append((1, m.start() + parts[k].start(), m.start() + parts[k + 3].end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() > 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping candidate spans of every kind."""
    out: set[tuple[int, int, int]] = set()
    if SPELLED.search(text):
        for m in AT.finditer(text):
            domain = SPELLED_DOMAIN.match(text, m.end())
            local = SPELLED_LOCAL.search(text[max(0, m.start() - 130):m.start()])
            if domain and local and local[0]:
                start = m.start() - len(local[0])
                out.add((0, start, domain.end()))
                out.add((0, max(start, text.rfind(" ", 0, m.start()) + 1), domain.end()))
    groups = [(m.start(), m.end()) for m in DIGITS.finditer(text)]
    for i, (start, _) in enumerate(groups):
        total, gaps = 0, []
        for j in range(i, min(len(groups), i + LONGEST_GROUPS)):
            if j > i:
                gap = text[groups[j - 1][1]:groups[j][0]]
                if not GAP.fullmatch(gap):
                    break
                gaps.append(gap)
            total += groups[j][1] - groups[j][0]
            if total > 19:
                break
            stop = groups[j][1]
            n = j - i + 1
            if n == 4 and total <= 12 and "." in "".join(gaps) + ".," and all(
                    _small(text[a:b]) for a, b in groups[i:j + 1]) and all("." in g or "," in g for g in gaps):
                out.add((1, start, stop))
            if 13 <= total <= 19:
                out.add((2, start, stop))
            if 7 <= total <= 15 and 2 <= n:
                left = start
                while left and start - left < 2 and text[left - 1] in "+(":
                    left -= 1
                out.add((3, left, stop))
    return sorted(out)


FEATURES = (
    "email", "ip", "card", "phone", "length", "digits", "groups", "separators", "separator_kinds", "first_group",
    "last_group", "largest_group", "checksum", "plus", "parens", "at", "spelled_at", "spelled_dot", "dots", "spaces",
    "ending_letters", "known_ending", "letter_before", "letter_after", "digit_before", "digit_after", "sign_before",
    "sign_after", "cue_contact", "cue_phone", "cue_card", "cue_network", "cue_number", "distinct_digits", "bracketed_dot")
ENDINGS = frozenset("com org net edu gov info io de fr es uk eu co us ch it nl".split())


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    kind, start, end = span
    s = text[start:end]
    low = s.lower()
    sizes = [m.end() - m.start() for m in DIGITS.finditer(s)] or [0]
    digits = "".join(c for c in s if "0" <= c <= "9")
    separators = [c for c in s if not c.isalnum()]
    before, after = text[start - 1:start], text[end:end + 1]
    words = [w.strip(".,:;()=\"'").lower() for w in text[max(0, start - 40):start].split()[-4:]]
    ending = re.split(r"[.\s\])}]+", low)[-1]
    return [*(float(kind == k) for k in range(4)), len(s), len(digits), len(sizes), len(separators), len(set(separators)),
            sizes[0], sizes[-1], max(sizes), float(13 <= len(digits) <= 19 and luhn(digits)), float("+" in s),
            float("(" in s and kind), float("@" in s), float(bool(re.search(r"\Wat\W", low))), float(bool(re.search(r"\Wdot\W", low))),
            s.count("."), s.count(" "), float(len(ending)) if ending.isalpha() else 0.0, float(ending in ENDINGS),
            float(before.isalpha()), float(after.isalpha()), float(before.isdigit()), float(after.isdigit()),
            float(before in "+.-/_@\"=" and before != ""), float(after in "+-/_@\"%" and after != ""),
            *(float(any(w in CUES[c] for w in words)) for c in CUES), len(set(digits)), float("[.]" in s or "(.)" in s)]


class Trees:
    """Gradient-boosted regression trees for the logistic loss, on quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        rate = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
        self.base = float(np.log(rate / (1 - rate)))
        self.trees: list[list[tuple]] = []
        binned = self._bin(x)
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree: list[tuple] = []
            self._grow(tree, binned, y - p, np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), 0)
            self.trees.append(tree)
            score += RATE * self._walk(tree, binned)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    def _grow(self, tree, binned, g, h, rows, depth) -> int:
        """Add the node of these rows: (feature, bin, left, right, value), feature -1 for a leaf."""
        at = len(tree)
        tree.append((-1, 0, 0, 0, float(g[rows].sum() / (h[rows].sum() + 1.0))))
        if depth == DEPTH or len(rows) < 8:
            return at
        best, total_g, total_h = (1e-3, -1, 0), g[rows].sum(), h[rows].sum()
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = binned[rows, f]
            left_g = np.cumsum(np.bincount(b, g[rows], len(edges) + 1))[:-1]
            left_h = np.cumsum(np.bincount(b, h[rows], len(edges) + 1))[:-1]
            gain = (left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g ** 2 / (total_h + 1))
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] >= 0:
            goes = binned[rows, best[1]] <= best[2]
            if goes.any() and not goes.all():
                left = self._grow(tree, binned, g, h, rows[goes], depth + 1)
                right = self._grow(tree, binned, g, h, rows[~goes], depth + 1)
                tree[at] = (best[1], best[2], left, right, 0.0)
        return at

    @staticmethod
    def _walk(tree: list[tuple], binned: np.ndarray) -> np.ndarray:
        f, b, left, right, value = (np.array(c) for c in zip(*tree, strict=True))
        node = np.zeros(len(binned), np.int64)
        for _ in range(DEPTH):
            inner = f[node] >= 0
            down = binned[np.arange(len(binned)), np.maximum(f[node], 0)] <= b[node]
            node = np.where(inner, np.where(down, left[node], right[node]), node)
        return value[node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        score = self.base + RATE * sum(self._walk(t, binned) for t in self.trees)
        return 1 / (1 + np.exp(-score))


DISGUISES = {
    0: [("@", " (at) "), ("@", "[at]"), ("@", " at ", ".", " dot "), ("@", " [at] ", ".", " [dot] "), ("@", " @ ")],
    1: [(".", "[.]"), (".", " . "), (".", "(.)")],
    2: [("group", "."), ("group", "/"), ("group", "  "), ("group", " - ")],
    3: [("+", ""), (" ", ".", "+", ""), ("-", " ", "+", ""), ("(", "", ")", "")],
}


def _rewrite(kind: int, found: str, how: tuple) -> str:
    if how[0] == "group":
        digits = "".join(c for c in found if c.isdigit())
        return how[1].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == 0:
        local, _, domain = found.partition("@")
        return local + how[1] + (domain.replace(how[2], how[3]) if len(how) > 2 else domain)
    for old, new in zip(how[::2], how[1::2], strict=True):
        found = found.replace(old, new)
    return found


def _break(kind: int, found: str) -> str | None:
    """A decoy: the same look without what makes the find valid."""
    if kind == 2:
        last = next(i for i in range(len(found) - 1, -1, -1) if found[i].isdigit())
        return found[:last] + str((int(found[last]) + 1) % 10) + found[last + 1:]
    if kind == 1:
        return found + ".7"
    return None


class Taken:
    """Whether a span touches one of some spans, by binary search."""

    def __init__(self, spans: list[tuple]):
        ordered = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in ordered]
        self.reach = list(accumulate((e for _, e in ordered), max))

    def touches(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.reach[at - 1] > start

    def add(self, start: int, end: int) -> None:
        """A further span that touches none so far."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.reach.insert(at, end)


def training_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of the proposals in texts, and in texts with finds rewritten."""
    x, y, kinds = [], [], []

    def add(text: str, span: tuple, label: int) -> None:
        x.append(features(text, span))
        y.append(label)
        kinds.append(span[0])

    def near(text: str, start: int, end: int, kind: int, label: int) -> None:
        """Proposals in a rewritten text that touch the rewritten place."""
        for p in proposals(text):
            if p[1] < end and p[2] > start:
                whole = p[0] == kind and p[1] <= start + 1 and p[2] >= end and p[1] >= start - 1 and p[2] <= end + 1
                add(text, p, int(label and whole))

    for text in texts:
        found = fixed_spans(text)
        for span in found:
            add(text, span, 1)
            kind, start, end = span
            left, right = text[max(0, start - 60):start], text[end:end + 60]
            for how in DISGUISES[kind]:
                new = _rewrite(kind, text[start:end], how)
                near(left + new + right, len(left), len(left) + len(new), kind, 1)
            broken = _break(kind, text[start:end])
            for how in [None, *DISGUISES[kind]] if broken else []:
                new = _rewrite(kind, broken, how) if how else broken
                near(left + new + right, len(left), len(left) + len(new), kind, 0)
        taken = Taken(found)
        for p in proposals(text):
            if not taken.touches(p[1], p[2]):
                add(text, p, 0)
    return np.array(x, float).reshape(-1, len(FEATURES)), np.array(y), np.array(kinds)


def fit(texts: list[str]) -> dict | None:
    """Trees and thresholds; None if the texts hold no find or nothing else."""
    x, y, kinds = training_rows(texts)
    if len(y) < 20 or y.min(initial=1) == y.max(initial=0):
        return None
    held = np.arange(len(y)) % 4 == 3
    trees = Trees(x[~held], y[~held])
    p = trees.predict(x[held])
    thresholds = []
    for k in range(len(KINDS)):
        mine = kinds[held] == k
        order = np.argsort(-p[mine], kind="stable")
        right = np.cumsum(y[held][mine][order])
        good = np.flatnonzero(right >= PRECISION * np.arange(1, len(right) + 1))
        # The lowest score down to which the kind's finds are precise, and never under a half.
        thresholds.append(max(0.5, float(p[mine][order][good[-1]])) if len(good) else 2.0)
    return {"trees": trees, "thresholds": thresholds}


def spans_of(text: str, model: dict | None) -> tuple[list[tuple], list[tuple]]:
    """(fixed, added) spans of a text."""
    fixed = fixed_spans(text)
    if model is None:
        return fixed, []
    taken = Taken(fixed)
    free = [p for p in proposals(text) if not taken.touches(p[1], p[2])]
    if not free:
        return fixed, []
    chance = model["trees"].predict(np.array([features(text, p) for p in free]))
    added: list[tuple] = []
    taken = Taken([])
    for c, (kind, start, end) in sorted(zip(chance.tolist(), free, strict=True), key=lambda z: (-z[0], z[1])):
        if c >= model["thresholds"][kind] and not taken.touches(start, end):
            taken.add(start, end)
            added.append((kind, start, end))
    return fixed, added


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def redact(text: str, spans: list[tuple]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans merge
    under the kind of the first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, text_col: str = "text") -> dict | None:
    """Fit on about ``train_docs`` whole texts with an ``@`` or a digit, chosen by a hash of the
    text; one count, and only the chosen texts reach the driver."""
    known = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9]@|@[A-Za-z]|[0-9]{3}"))
    n = known.count()
    unit = F.xxhash64(F.lit(29), "text").bitwiseAND(F.lit((1 << 31) - 1)) / F.lit(float(1 << 31))
    rows = known.where(unit < min(1.0, train_docs / max(n, 1))).distinct().collect()
    return fit(sorted(r["text"] for r in rows))


SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


OUT = ("pii_fixed", "pii_added", "pii_redacted")


def find(docs: DataFrame, model: dict | None, text_col: str = "text", names: tuple = OUT) -> DataFrame:
    """Every column of ``docs`` and then (under ``names``): pii_fixed, pii_added (arrays of kind
    number, start, end in code points, end exclusive) and pii_redacted (the text with every span
    replaced).

    A narrow pass over whole texts.  A null text has no spans and stays null; repeated rows give
    repeated rows."""
    at = docs.columns.index(text_col)

    def rows(batches):
        for batch in slices(batches):
            fixed, added, redacted = [], [], []
            for text in batch.column(at).to_pylist():
                a, b = spans_of(text or "", model)
                fixed.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(a)])
                added.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(b)])
                redacted.append(None if text is None else redact(text, a + b))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(fixed, SPAN), pa.array(added, SPAN), pa.array(redacted, pa.string())],
                [*batch.schema.names, *names])

    span = "array<struct<kind:int,start:int,end:int>>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        f"`{names[0]}` {span}", f"`{names[1]}` {span}", f"`{names[2]}` string"])
    return arrow_pass(spread_scan(docs), schema, rows)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, counts of fixed finds by kind, their digest, and all spans as a string."""
    def text_of(x):
        return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])

    def joined(spans):
        return F.array_join(F.transform(spans, text_of), ",")

    def of_kind(k):  # one argument only: Spark hands a second one the element's index
        return lambda x: x["kind"] == k

    counts = [F.size(F.filter("pii_fixed", of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(joined(F.col("pii_fixed")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("pii_fixed", "pii_added"))).alias("spans"),
                        F.size("pii_added").cast("bigint").alias("n_added"))
