"""Line-first cleaning: every line is judged on its own, failing lines are removed, and a
document that loses too much of its text is rejected.

Line rules (a line without a word is neither judged nor counted):

* punctuation: symbols or repeated marks crowd the words, or a long line has no sentence
  punctuation at all;
* navigation: separators between most words, or a line of menu entries;
* boilerplate: notices, consent and account phrases, licence lines: a phrase for every
  ``BOILERPLATE_WORDS`` words, so one notice doesn't condemn a long line of prose;
* shouting and repetition: mostly capitals with exclamation marks, or few distinct words for its
  length.

The rules hold for lines of any length.  The phrases are English.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_pass, slices, spread_scan, texts_of

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document is rejected if less than this share of its words is in lines that pass.
MIN_SHARE_KEPT = 0.5

#: Symbols a word from which a line counts as crowded.
CROWDED = 0.25
#: Separators a word from which a line counts as navigation.
SEPARATED = 0.3
#: Words from which a line must have sentence punctuation, or enough distinct words.
LONG_LINE = 40
DISTINCT_SHARE = 0.2
#: Distinct words of a text grow more slowly than its length, about as its square root.
DISTINCT_ROOT = 3.5
#: A line is boilerplate with a phrase for every so many of its words.
BOILERPLATE_WORDS = 60
CAPITALS_SHARE = 0.6

MARKS = re.compile(r"[#*$%&<>^~=_\\{}\[\]]")
SEPARATORS = re.compile(r"(?:^|\s)(?:[|>»›·•/\\-]|::|->)(?=\s|$)")
MENU = re.compile(r"^(?:home|menu|login|log in|sign in|sign up|contact|about us|search|next|previous|back to top)"
                  r"(?:\s*[|>»·•/-]?\s*(?:home|menu|login|log in|sign in|sign up|contact|about us|search|next|previous))*\s*$", re.I)
BOILERPLATE = re.compile(
    r"all rights reserved|copyright (?:\(c\)|©)|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)"
    r"|we use cookies|enable javascript|click here to|subscribe to our|sign up for our newsletter|follow us on"
    r"|share (?:this|on) (?:facebook|twitter)|lorem ipsum|^licensed under |general public license", re.I)
SENTENCE = re.compile(r"[.!?…。！？;:]")


def line_fails(line: str, words: list[bytes]) -> bool:
    """Whether a line with these words is removed."""
    n = len(words)
    if len(MARKS.findall(line)) > CROWDED * n and n > 1:
        return True
    if n > 2 and len(SEPARATORS.findall(line)) > SEPARATED * n:
        return True
    if MENU.search(line) or len(BOILERPLATE.findall(line)) * BOILERPLATE_WORDS >= n:
        return True
    if n >= LONG_LINE:
        if len(set(words)) < min(DISTINCT_SHARE * n, DISTINCT_ROOT * math.sqrt(n)):
            return True
        if not SENTENCE.search(line):
            return True
    if n > 2 and line.count("!") >= 0.5 * n:
        letters = sum(map(str.isalpha, line))
        return letters > 0 and sum(map(str.isupper, line)) > CAPITALS_SHARE * letters
    return False


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(ids)
    if n == len(words):
        return 0
    pairs = code[:-1] * n + code[1:]
    if n > 1_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, back, count = np.unique(pairs[:-1] * n + code[2:], return_inverse=True, return_counts=True)
    again = count[back] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def judge(text: str, min_share: float = MIN_SHARE_KEPT) -> tuple:
    """One document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_lines_removed, n_words_left, cleaned text."""
    lines = text.split("\n")
    by_line = [line.encode().split() for line in lines]
    words = [w for ws in by_line for w in ws]
    n = len(words)
    seen: set[str] = set()
    dup = removed = left = 0
    kept_lines = []
    for line, ws in zip(lines, by_line, strict=True):
        if not ws:
            kept_lines.append(line)
            continue
        dup += line in seen
        seen.add(line)
        if line_fails(line, ws):
            removed += 1
        else:
            left += len(ws)
            kept_lines.append(line)
    repeated = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    chars = len(text) - sum(map(text.count, SPACES))
    kept = not failed and left >= min_share * n
    return (n, chars, sum(map(text.count, SYMBOLS)), dup, repeated, failed, kept, removed, left, "\n".join(kept_lines))


COLUMNS = [("n_words", "bigint", pa.int64()), ("word_chars", "bigint", pa.int64()), ("n_symbols", "bigint", pa.int64()),
           ("n_dup_lines", "bigint", pa.int64()), ("n_repeat_words", "bigint", pa.int64()),
           ("base_failed", "boolean", pa.bool_()), ("kept", "boolean", pa.bool_()),
           ("n_lines_removed", "bigint", pa.int64()), ("n_words_left", "bigint", pa.int64()),
           ("cleaned", "string", pa.string())]


def clean_lines(docs: DataFrame, min_share: float = MIN_SHARE_KEPT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id and the columns of ``judge`` for every whole text.

    A narrow pass without a shuffle.  A null text has no words (and fails the base rules), null
    ids stay null, repeated rows give repeated rows, other columns are ignored."""

    def rows(batches):
        for batch in slices(batches):
            judged = zip(*(judge(t, min_share) for t in texts_of(batch, "text")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, kind) for c, (_, _, kind) in zip(judged, COLUMNS, strict=True))],
                ["doc_id", *(name for name, _, _ in COLUMNS)])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{name} {kind}" for name, kind, _ in COLUMNS)
    return arrow_pass(spread_scan(source), schema, rows)


def oracle_sql(min_share: float = MIN_SHARE_KEPT) -> str:
    """DuckDB statement for the columns of ``clean_lines`` but the cleaned text, over ``documents``
    with distinct ids."""
    def sql(pattern: re.Pattern) -> str:
        flags = "(?i)" if pattern.flags & re.I else ""
        return "'" + flags + pattern.pattern.replace("'", "''") + "'"

    word = "'[^\\x20\\x09-\\x0D]+'"
    count = lambda x, kind: f"length(regexp_replace({x}, '[^{kind}]', '', 'g'))"
    return f"""
with doc as (select doc_id, coalesce(text, '') as text from documents),
line as (select doc_id, unnest(string_split(text, chr(10))) as line,
                unnest(generate_series(1, len(string_split(text, chr(10))))) as pos from doc),
told as (select *, regexp_extract_all(line, {word}) as ws from line),
judged as (
  select *, len(ws) as n, row_number() over (partition by doc_id, line order by pos) > 1 as again,
    (len(regexp_extract_all(line, {sql(MARKS)})) > {CROWDED} * len(ws) and len(ws) > 1)
    or (len(ws) > 2 and len(list_filter(ws, lambda w: w in ('|', '>', '»', '›', '·', '•', '/', chr(92), '-', '::', '->'))) > {SEPARATED} * len(ws))
    or regexp_matches(line, {sql(MENU)}) or len(regexp_extract_all(line, {sql(BOILERPLATE)})) * {BOILERPLATE_WORDS} >= len(ws)
    or (len(ws) >= {LONG_LINE} and len(list_distinct(ws)) < least({DISTINCT_SHARE} * len(ws), {DISTINCT_ROOT} * sqrt(len(ws))))
    or (len(ws) >= {LONG_LINE} and not regexp_matches(line, {sql(SENTENCE)}))
    or (len(ws) > 2 and {count("line", "!")} >= 0.5 * len(ws) and {count("line", "\\p{L}")} > 0
        and {count("line", "\\p{Lu}")} > {CAPITALS_SHARE} * {count("line", "\\p{L}")}) as fails
  from told),
lines as (
  select doc_id, count(*) filter (where again and n > 0) as n_dup_lines, count(*) filter (where fails and n > 0) as n_lines_removed,
         coalesce(sum(n) filter (where not fails and n > 0), 0) as n_words_left from judged group by doc_id),
words as (select doc_id, unnest(regexp_extract_all(text, {word})) as w,
                 unnest(generate_series(1, len(regexp_extract_all(text, {word})))) as i from doc),
grams as (select doc_id, i, w, lead(w) over d as w2, lead(w, 2) over d as w3 from words window d as (partition by doc_id order by i)),
twice as (select doc_id, i from grams where w3 is not null qualify count(*) over (partition by doc_id, w, w2, w3) > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, (values (0), (1), (2)) s(k) group by doc_id),
total as (
  select doc_id, len(regexp_extract_all(text, {word})) as n_words,
         length(text) - length(regexp_replace(text, '[^\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
         {count("text", "#*$%&|<>")} as n_symbols from doc),
one as (
  select t.*, l.n_dup_lines, coalesce(c.n, 0) as n_repeat_words, l.n_lines_removed, l.n_words_left,
         n_words < {MIN_WORDS} or 100 * coalesce(c.n, 0) > {MAX_REPEAT_PERCENT} * n_words as base_failed
  from total t join lines l using (doc_id) left join covered c using (doc_id))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and n_words_left >= {min_share} * n_words as kept,
       n_lines_removed::bigint as n_lines_removed, n_words_left::bigint as n_words_left
from one"""
