"""Quality rules, personal data, language and toxicity."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import language, pii, quality, toxicity

from .conftest import MESSY, prose


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts_equal_brute_force():
    rng = random.Random(4)
    pieces = ["a", "b", "cd", " ", " ", "\n", "\t", "\v", "#", "|", " ", "é", "\U0001f642"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 120))) for _ in range(400)] + [t or "" for _, t in MESSY[:9]]
    for t in texts:
        assert quality.judge(t)[:6] == brute_quality(t), t


def test_line_rules_remove_lines_first():
    good = prose(7, 60)
    bad = ["home | about us | contact", "All rights reserved.", "a### b*** c$$$ d&&&", "BUY!! NOW!! HERE!! TODAY!!",
           " | ".join(["x"] * 8), "For " * 60]
    other = prose(9, 60)
    kept = quality.judge("\n".join([good, *bad[:2], other]))
    assert kept[6] and kept[7] == 2 and kept[9] == good + "\n" + other
    assert all(quality.line_fails(b, b.encode().split()) for b in bad)
    assert not quality.line_fails(good, good.encode().split())
    lost = quality.judge("\n".join([prose(8, 20), *[" | ".join(prose(k, 12).split()) for k in range(9)]]))
    assert not lost[5] and not lost[6]


def test_line_rules_hold_at_any_length():
    fails = lambda line: quality.line_fails(line, line.encode().split())
    notice = "All rights reserved, see our privacy policy and cookie settings. "
    assert fails(notice) and fails(notice * 40)  # 2,600 characters of notices
    assert fails("home | about us | contact | " * 60 + "search")
    story = ". ".join(prose(k, 30) for k in range(20))
    assert not fails(story) and not fails(story + " All rights reserved. " + story)  # one phrase in a long line of prose
    assert fails(" ".join(f"w{k % 60}" for k in range(4000)) + ".") and not fails(" ".join(f"w{k}" for k in range(4000)) + ".")
    few = " ".join(f"w{k % 61}" for k in range(4000)) + "."  # 61 different words are few for 4,000
    assert fails(few)


def test_quality_messy(messy, empty):
    out = quality.clean_lines(messy)
    assert out.count() == len(MESSY) and quality.clean_lines(empty).count() == 0
    null = out.where("doc_id = 3").first()
    assert (null.n_words, null.base_failed, null.kept) == (0, True, False)


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 1 and any(int(x) > 255 for x in m[0].split(".")) or kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits))
                    or kind == 3 and not 9 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_fixed_spans_equal_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice("a.@-+1 2()9|é") for _ in range(rng.randint(0, 50))) for _ in range(20_000)]
    texts += ["".join(rng.choice("0123456789. -") for _ in range(60)) for _ in range(5000)]
    for t in texts:
        assert pii.fixed_spans(t) == brute_spans(t), t


def private_texts(n):
    rng = random.Random(6)
    out = []
    for k in range(n):
        base = prose(100 + k, 30)
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        found = [f"ann.{k}@mail{k % 7}.example.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)), card,
                 f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"][k % 4]
        out.append(f"{base[:60]} {found} {base[60:]}")
        if k % 3 == 0:
            out.append(base + f" version {k}.{k % 9} item {rng.randint(10 ** 12, 10 ** 15)} of")
    return out


def test_trees_add_disguised_finds_and_leave_numbers_alone():
    model = pii.fit(private_texts(400))
    added = lambda s: [(pii.KINDS[k], s[a:b]) for k, a, b in pii.spans_of(s, model)[1]]
    assert ("email", "bo.li [at] mail3.example [dot] com") in added("Write to bo.li [at] mail3.example [dot] com now")
    assert added("the cat sat at home and the dot i") == [] and added("chapter 12 section 3.4 page 567") == []
    merged = "call +1 (269) 555-3296 4524132264652876 an"
    spans = pii.spans_of(merged, model)
    assert not any(a[1] < b[2] and b[1] < a[2] for a in spans[1] for b in spans[0])
    assert pii.redact("x a@b.co y", [(0, 2, 8)]) == "x <email> y"
    assert pii.fit([]) is None and pii.spans_of("a@b.co", None) == ([(0, 0, 6)], [])


def test_pii_messy(messy, empty):
    out = pii.find(messy, pii.train(messy))
    assert out.columns[:len(messy.columns)] == messy.columns
    assert pii.digest(out).where("doc_id = 8").first()[1:5] == (1, 0, 1, 1)
    assert out.where("doc_id = 3").first().pii_redacted is None and out.count() == len(MESSY)
    assert pii.find(empty, pii.train(empty)).count() == 0


def test_pii_counts_equal_brute_force(spark):
    """Every kind's count and the digest of the fixed spans, on a table with finds of every kind."""
    texts = dict(enumerate(private_texts(60) + ["a@b.co 1.2.3.4 5.6.7.8 +1 222 333 4444", "", None]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in pii.digest(pii.find(frame, None)).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        want = brute_spans(text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(want))
        counts = tuple(sum(k == kind for kind, _, _ in want) for k in range(4))
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == counts, text
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert max(r.n_ip for r in got.values()) == 2


def test_taken_spans_equal_a_scan_of_all():
    rng = random.Random(8)
    for _ in range(300):
        spans = [(0, s, s + rng.randint(1, 9)) for s in (rng.randrange(100) for _ in range(rng.randint(0, 12)))]
        taken = pii.Taken(spans)
        apart = pii.Taken([])
        kept = []
        for _ in range(30):
            a = rng.randrange(105)
            b = a + rng.randint(1, 6)
            assert taken.touches(a, b) == any(a < e and b > s for _, s, e in spans)
            assert apart.touches(a, b) == any(a < e and b > s for s, e in kept)
            if not apart.touches(a, b):
                apart.add(a, b)
                kept.append((a, b))


def test_codewords_keep_their_distance():
    for k in (2, 3, 4, 6, 9):
        code = language.codewords(k)
        gaps = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(gaps) >= (1 if k == 2 else 2) and set(np.unique(code)) == {-1.0, 1.0}


def speech(seed, words, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


TONGUES = {"aa": "the and house water going there with".split(), "bb": "der und haus wasser nicht auch mit".split(),
           "cc": "le et maison eau pas aussi avec".split()}


def test_languages_are_told_apart(spark, messy, empty):
    rows = [(k, speech(k, TONGUES[lang]), lang) for k, lang in enumerate(list(TONGUES) * 40)]
    docs = spark.createDataFrame(rows + [(900, None, "aa"), (901, "12 34 !", None), (902, "", "bb"),
                                         (903, "\u00bd \u00b2 \u00b3 12 \u2460 _", None)], "doc_id BIGINT, text STRING, lang STRING")
    model = language.train(docs, lambda i: i % 5 == 1)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    held = [(k, lang) for k, _, lang in rows if k % 5 == 1]
    assert all(got[k].lang_pred == lang and 0.5 < got[k].score <= 1 and not got[k].ambiguous for k, lang in held)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (900, 901, 902, 903))
    mixed = language.Decoder(model).predict([speech(1, TONGUES["aa"] + TONGUES["bb"], 400)])[0]
    assert mixed[0] in ("aa", "bb")
    assert language.identify(messy, model).count() == len(MESSY)
    none = language.train(empty, lambda i: i < 0)
    assert {r.lang_pred for r in language.identify(messy, none).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + [0] * len(b), row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    entries = ["scum", "idiot", "pathetic", "disgusting", "rotte*", "loser="]
    lexicon, rng = toxicity.Lexicon(entries), random.Random(8)
    words = [e.rstrip("*=") for e in entries] + ["rotten", "rottweiler"]
    for _ in range(3000):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "i", "t"])
        w = "".join(w)
        near = min(((d, e) for e in (*entries[:4], entries[5]) if (d := brute_distance(w, e.rstrip("="))) <= toxicity.edits_allowed(e)), default=None)
        want = (("exact", "near", "far")[near[0]], near[1]) if near else ("stem", "rotte*") if w.startswith("rotte") else None
        assert lexicon.match(w) == want, w


def test_abuse_is_told_from_clean_text(spark, messy, empty):
    rng = random.Random(3)
    bad = ["idiot", "pathetic", "disgusting", "loser"]
    rows, labels = [], []
    for k in range(400):
        words = prose(1000 + k, 60).split()
        if k % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    label = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id BIGINT, toxic INT")
    model = toxicity.train(docs, label, lambda i: i % 5 == 0)
    assert set(bad) <= {e.rstrip("=") for e in model["entries"]}
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.5) == (t == 1) for k, t in labels)
    scorer = toxicity.scorer_of(model)
    assert scorer.scores([prose(5, 30) + " you patethic idiiot and loser!"])[0] >= 0.5
    misspelled = prose(6, 30) + " patethic, disgustting! Idiiot, disgusing pathetc."
    assert scorer.scores([misspelled])[0] >= 0.5 > scorer.scores([prose(6, 30)])[0]
    features = dict(zip(toxicity.FEATURES, scorer.features('he said the word "idiot" once'), strict=True))
    assert features["quoted"] == 1
    out = toxicity.score(messy, model, score_col="toxicity")
    assert out.columns == [*messy.columns, "toxicity"] and out.count() == len(MESSY)
    assert out.where("doc_id = 3").first().toxicity == out.where("doc_id = 4").first().toxicity
    nothing = toxicity.train(empty, label.limit(0), lambda i: i < 0)
    assert all(0 <= r.toxicity < 0.5 for r in toxicity.score(messy, nothing, score_col="toxicity").collect())
    assert toxicity.score(empty, model, score_col="toxicity").where(F.col("toxicity") > 0).count() == 0
