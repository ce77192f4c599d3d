"""Line dedup by winnowing, with DataFrame operations only.

A document is its sequence of line hashes.  A *window* starts at every line and runs on until
it holds ``min_words`` words or ``max_lines`` lines.  So every run of consecutive lines with at
least ``min_words`` words, or at least ``max_lines`` lines, holds a whole window; shorter
repeats (a short heading on its own) are not runs.

1. Winnowing: the least line hash of each window is selected as a fingerprint.  Equal windows
   select equal fingerprints, so a repeated run is guaranteed to share one.
2. Fingerprints are counted over all documents (partial sums before the shuffle); only those
   found at two or more positions go on.  This removes most of the corpus.
3. Join positions: the windows around a repeated fingerprint, reaching from it to the left and
   to the right, are joined on their exact line hashes; the first occurrence in (id, line) order
   is a minimum, so a hot run is summed up before the shuffle and no pairs are listed.
4. Every window with an earlier occurrence is covered; overlapping covered windows of a
   document merge, which extends a match both ways to the whole repeated run.
5. Covered runs are cut out; first occurrences stay.

Defined results: a null text counts as empty; a blank line is a line with no words; rows of one
id and text are one document, and of one id a line number is one position (neither is later);
null ids come first; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import write_table

MIN_WORDS = 50
MAX_LINES = 4


def _words(line: Column) -> Column:
    trimmed = F.trim(line)
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with a key of 128 hash bits of id and text (never null)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"), "doc_id", "text")


def _windows(keyed: DataFrame, min_words: int, max_lines: int) -> DataFrame:
    """k1, k2, doc_id, windows: array of (at, n, hashes, fingerprint, its line)."""
    # Texts are split and hashed once; a written table keeps the arrays from being worked out
    # again for every element that refers to them.
    split = F.split("text", "\n", -1)
    lines = write_table(keyed.select("k1", "k2", "doc_id", F.transform(split, lambda x: F.xxhash64(x)).alias("h"),
                                     F.transform(split, _words).alias("w")))
    size = F.size("h")

    def length(s: Column) -> Column:
        # Lines until min_words words or max_lines lines; 0 if the document ends before both.
        out, total = F.lit(0), F.lit(0)
        steps = []
        for k in range(max_lines):
            total = total + F.coalesce(F.get("w", s + k), F.lit(0))
            enough = (total >= min_words) if k < max_lines - 1 else F.lit(True)
            steps.append(((s + k < size) & enough, k + 1))
        for test, n in reversed(steps):
            out = F.when(test, n).otherwise(out)
        return out

    starts = F.transform(F.sequence(F.lit(0), size - 1), lambda s: F.struct(s.alias("at"), length(s).alias("n")))
    spans = F.filter(starts, lambda x: x["n"] > 0)
    cut = F.transform(spans, lambda x: F.struct(x["at"].alias("at"), x["n"].alias("n"),
                                                F.slice("h", x["at"] + 1, x["n"]).alias("hashes")))
    return lines.select("k1", "k2", "doc_id", cut.alias("c")).select(
        "k1", "k2", "doc_id", F.transform("c", lambda x: F.struct(
            x["at"].alias("at"), x["n"].alias("n"), x["hashes"].alias("hashes"),
            F.array_min(x["hashes"]).alias("fingerprint"),
            (x["at"] + F.array_position(x["hashes"], F.array_min(x["hashes"]))).alias("line"))).alias("windows"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, max_lines: int = MAX_LINES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2, runs: the covered runs of each document that has any, as (first line, line after
    the last), in order and apart from each other."""
    windows = _windows(_keyed(docs, id_col, text_col), min_words, max_lines)
    # The same line is the minimum of several windows of a document; it is one position.
    positions = windows.select("k1", "k2", F.explode(F.array_distinct(F.transform(
        "windows", lambda x: F.struct(x["fingerprint"].alias("fingerprint"), x["line"].alias("line"))))).alias("p"))
    repeated = write_table(positions.groupBy(F.col("p.fingerprint").alias("fingerprint"))
                           .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint"))
    around = windows.select("k1", "k2", "doc_id", F.explode("windows").alias("x")).select(
        "k1", "k2", "doc_id", "x.at", "x.n", "x.hashes", "x.fingerprint")
    around = write_table(around.join(repeated, "fingerprint", "left_semi"))
    # The key is the run of line hashes itself, at least two different hashes of it.
    key = [F.xxhash64("hashes").alias("h1"), F.xxhash64(F.lit(1), "hashes", "n").alias("h2"), F.col("n")]
    place = F.struct(F.col("doc_id"), F.col("at")).alias("place")
    found = around.select("k1", "k2", *key, place)
    first = write_table(found.groupBy("h1", "h2", "n").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c"))
                        .where("c > 1").select("h1", "h2", "n", "first"))
    later = (found.join(first, ["h1", "h2", "n"])
             .where(~(F.col("place.doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place.at") == F.col("first.at")))))
    spans = (later.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct(
        F.col("place.at").alias("start"), (F.col("place.at") + F.col("n")).alias("stop")))).alias("spans")))
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def extend(runs: Column, x: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return F.when(F.coalesce(last["stop"] >= x["start"], F.lit(False)),
                      F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined))
                      ).otherwise(F.concat(runs, F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop")))))

    return spans.select("k1", "k2", F.aggregate("spans", empty, extend).alias("runs"))


def cut_runs(docs: DataFrame, min_words: int = MIN_WORDS, max_lines: int = MAX_LINES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row (its columns, as a struct), deduped (the text without later
    repeated runs; null stays null), n_lines, n_removed, runs (null if none)."""
    runs = write_table(repeated_runs(docs, min_words, max_lines, id_col, text_col))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col(f"row.{id_col}").alias("_id"), F.coalesce(F.col(f"row.{text_col}"), F.lit("")).alias("_text"))
    rows = rows.select("row", F.xxhash64("_id", "_text").alias("k1"), F.xxhash64(F.lit(1), "_text", "_id").alias("k2"))
    # No bound holds for the runs of a corpus, so this is a merge join at every size; the table of
    # runs is written, so both sides are plain shuffles and a hot key can be split.
    joined = rows.join(runs.hint("merge"), ["k1", "k2"], "left")
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    lines = F.split(text, "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.col("runs.stop"))
    stops = F.concat(F.col("runs.start"), F.array(F.size("lines")))
    gaps = F.zip_with(starts, stops, lambda a, b: F.slice("lines", a + 1, b - a))
    return (joined.withColumn("lines", F.when(F.col("runs").isNotNull(), lines)).select(
        "row",
        F.when(F.col("runs").isNull(), F.col(f"row.{text_col}")).otherwise(F.array_join(F.flatten(gaps), "\n")).alias("deduped"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        F.coalesce(F.aggregate("runs", F.lit(0), lambda n, x: n + x["stop"] - x["start"]), F.lit(0)).alias("n_removed"),
        "runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, max_lines: int = MAX_LINES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, deduped, n_lines, n_removed, runs (see ``cut_runs``)."""
    return cut_runs(docs.select(id_col, text_col), min_words, max_lines, id_col, text_col).select(
        F.col(f"row.{id_col}").alias("doc_id"), "deduped", "n_lines", "n_removed", "runs")


def oracle_sql(min_words: int = MIN_WORDS, max_lines: int = MAX_LINES) -> str:
    """DuckDB statement for doc_id, n_lines, n_removed, text_md5 over ``documents``: windows as
    joined line texts, first occurrence by (doc_id, line), no fingerprints."""
    ahead = range(1, max_lines)
    leads = ", ".join([f"lead(line, {k}) over d as l{k}, coalesce(lead(w, {k}) over d, 0) as w{k}, "
                       f"lead(pos, {k}) over d is not null as e{k}" for k in ahead])
    cases, total, text = [], "w", "line"
    for k in range(max_lines):
        if k:
            total, text = f"{total} + w{k}", f"{text} || chr(10) || l{k}"
        exists = f"e{k}" if k else "true"
        enough = f"{total} >= {min_words}" if k < max_lines - 1 else "true"
        cases.append((f"when {exists} and {enough} then", k + 1, text))
    n = " ".join(f"{c} {k}" for c, k, _ in cases)
    key = " ".join(f"{c} {t}" for c, _, t in cases)
    return f"""
with doc as (select doc_id, coalesce(text, '') as text from documents),
line as (select doc_id, unnest(string_split(text, chr(10))) as line,
                unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as pos from doc),
counted as (select *, case when trim(line) = '' then 0
                           else length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 end as w from line),
ahead as (select *, {leads} from counted window d as (partition by doc_id order by pos)),
win as (select doc_id, pos, case {n} else 0 end as n, case {key} end as run from ahead),
ranked as (select *, row_number() over (partition by n, run order by doc_id, pos) as r from win where n > 0),
gone as (select distinct doc_id, unnest(generate_series(pos, pos + n - 1)) as pos from ranked where r > 1),
kept as (select l.doc_id, l.pos, l.line, g.pos is not null as gone
         from line l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_removed,
       md5(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as text_md5
from kept group by doc_id"""
