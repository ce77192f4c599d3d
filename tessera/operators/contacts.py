"""Contact-number tables: masked-number expansion, record normalisation, upsert.

* ``expand_masks``: every completion of a mask whose ``*`` are unknown digits.  The
  default mode keeps only non-decreasing digit fillings (combinations with repetition,
  the original generator's behaviour: 24,310 candidates for 8 stars); ``mode='all'``
  gives every digit string.  Blocks of fillings are worked out from their numbers: no join, no cap.
* ``unknown_fillings``: the fillings that are not known numbers, without a join of candidates.
* ``known_fillings``: which known numbers a mask stands for, by a join on the mask.
* ``classify_numbers``: loosely extracted numbers to ``phone_info`` rows and error rows.
* ``normalise_records``: provider JSON (hyphenated keys) to ``phone_info`` columns, with
  errors and unreadable messages routed to their own frame.
* ``upsert_latest``: one row per primary key, newest record first, with the error-code
  foreign key resolved by a left join (dangling codes become null).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.parallelism import spread
from tessera.session import ship_package

PHONE_PATTERN = r"\+\d+ \(\d{3}\) \d{3}-\d{4}"
#: Anything that starts like an international number; what it is gets decided afterwards.
LOOSE_PATTERN = r"\+[0-9][0-9 ().-]{5,}[0-9]"

# Error codes of this library.
ERROR_CODES = [(1, "missing phone number"), (2, "invalid phone number")]

# Provider response keys and the phone_info columns they fill.
RECORD_FIELDS = [
    ("international-number", "international_number", "string"),
    ("international-calling-code", "international_calling_code", "string"),
    ("prefix-network", "prefix_network", "string"),
    ("valid", "is_valid", "boolean"),
    ("is-mobile", "is_mobile", "boolean"),
    ("type", "phone_type", "string"),
    ("country", "country", "string"),
    ("country-code", "country_code", "string"),
    ("location", "location", "string"),
]
ERROR_FIELDS = [("api-error", "error_code", "int"), ("api-error-msg", "error_message", "string")]

_TYPES = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType()}
RECORD_SCHEMA = T.StructType(
    [T.StructField(k, _TYPES[t]) for k, _, t in RECORD_FIELDS + ERROR_FIELDS])


def star_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("*"), F.lit("")))


def mask_number(number: Column, keep_head: int, keep_tail: int) -> Column:
    """Hide the middle of a number: keep ``keep_head`` leading and ``keep_tail``
    trailing characters, every digit in between becomes ``*``."""
    n = F.length(number)
    mid = F.substring(number, keep_head + 1, F.greatest(n - keep_head - keep_tail, F.lit(0)))
    return F.concat(F.substring(number, 1, keep_head), F.regexp_replace(mid, r"\d", "*"),
                    F.substring(number, F.greatest(n - keep_tail + 1, F.lit(keep_head + 1)), keep_tail))


#: Fillings that are worked out at once, and of one output batch: bounds memory, not the result.
FILLING_BLOCK = 65_536
FILLING_SLICE = 16_384


def filling_count(stars: Column, mode: str = "nondecreasing") -> Column:
    """Fillings of that many stars: C(k + 9, 9) without a fall, 10^k in all."""
    if mode == "all":
        return F.pow(F.lit(10), stars).cast("bigint")
    return F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(1).cast("bigint"),
                       lambda a, j: (a * (stars + j) / j).cast("bigint"))


def _steps(stars: int) -> np.ndarray:
    """Row r, column x: fillings without a fall of r stars that start with a digit below x."""
    starting = [[comb(r - 1 + 9 - x, 9 - x) if r else 0 for x in range(10)] for r in range(stars + 1)]
    return np.array([[sum(row[:x]) for x in range(11)] for row in starting], dtype=np.int64)


def fillings(first: int, last: int, stars: int, mode: str) -> np.ndarray:
    """Digits of the fillings numbered ``first`` to ``last`` (exclusive), in ascending order: a row each."""
    i = np.arange(first, last, dtype=np.int64)
    out = np.empty((len(i), stars), np.uint8)
    if mode == "all":
        for p in range(stars - 1, -1, -1):
            out[:, p] = i % 10
            i = i // 10
        return out
    steps, digit = _steps(stars), np.zeros(len(i), np.int64)
    for p in range(stars):
        # The number counts from the least digit allowed here; the digit is the last that starts at or before it.
        below = steps[stars - p]
        i = i + below[digit]
        digit = np.searchsorted(below[1:], i, side="right")
        i = i - below[digit]
        out[:, p] = digit
    return out


def filling_number(digits: np.ndarray) -> np.ndarray:
    """The numbers of fillings without a fall, the inverse of ``fillings``."""
    n, stars = digits.shape
    steps, least, out = _steps(stars), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for p in range(stars):
        digit = digits[:, p].astype(np.int64)
        out += steps[stars - p][digit] - steps[stars - p][least]
        least = digit
    return out


def _strings(rows: np.ndarray) -> pa.Array:
    """Rows of equally many bytes as a string column."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows)))


def _blocks(masks: DataFrame, mask_col: str, mode: str) -> DataFrame:
    """(mask, stars, block, first, last): the fillings of a mask in blocks of ``FILLING_BLOCK`` numbers."""
    if mode not in ("nondecreasing", "all"):
        raise ValueError("mode must be 'nondecreasing' or 'all'")
    m = masks.select(F.col(mask_col).alias("mask")).where(F.col("mask").isNotNull()).withColumn("stars", star_count(F.col("mask")))
    numbered = m.withColumn("n", filling_count(F.col("stars"), mode))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(FILLING_BLOCK).cast("bigint")))
    return numbered.withColumn("first", first).select(
        "mask", "stars", F.floor(F.col("first") / FILLING_BLOCK).alias("block"), "first",
        F.least(F.col("first") + FILLING_BLOCK, F.col("n")).alias("last"))


def _write_out(blocks: DataFrame, mode: str) -> DataFrame:
    """(mask, candidate) for every number of every block but those in its column ``skip`` (if any)."""
    skips = "skip" in blocks.columns
    names = ["mask", "stars", "first", "last", *(["skip"] if skips else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digits = fillings(row["first"], row["last"], row["stars"], mode)
                if skips and row["skip"]:
                    digits = np.delete(digits, np.asarray(row["skip"], np.int64) - row["first"], axis=0)
                mask = np.frombuffer(row["mask"].encode(), np.uint8)
                for a in range(0, len(digits), FILLING_SLICE):  # bounds the bytes of one batch
                    part = digits[a:a + FILLING_SLICE]
                    text = np.repeat(mask[None, :], len(part), axis=0)
                    same = _strings(text)
                    text = text.copy()
                    text[:, mask == ord("*")] = part + ord("0")
                    yield pa.RecordBatch.from_arrays([same, _strings(text)], ["mask", "candidate"])

    ship_package(blocks.sparkSession)
    # Blocks are small rows; dealt out evenly, so a mask of many fillings spans many tasks.
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.select(names).repartition(parts).mapInArrow(run, "mask string, candidate string")


def expand_masks(masks: DataFrame, mask_col: str = "mask", mode: str = "nondecreasing") -> DataFrame:
    """``(mask, candidate)`` for every filling of the stars, left to right.

    A block of fillings is worked out from its numbers at once, so a mask may have any count of
    stars for which the number of fillings fits in 64 bits; a null mask has none."""
    return _write_out(_blocks(masks, mask_col, mode), mode)


def unknown_fillings(masks: DataFrame, numbers: DataFrame, keep_head: int, keep_tail: int,
                     mask_col: str = "mask", number_col: str = "number") -> DataFrame:
    """``(mask, candidate)``: the non-decreasing fillings that are not among the known numbers.

    The known fillings (a join on the mask) are turned into their numbers and left out of their
    blocks; a block knows ``FILLING_BLOCK`` of them at most, and no candidate is shuffled."""
    known = known_fillings(masks, numbers, keep_head, keep_tail, mask_col, number_col)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for mask, candidate in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hidden = [int(c) for m, c in zip(mask, candidate, strict=True) if m == "*"]
                out.append(int(filling_number(np.array([hidden], np.int64).reshape(1, -1))[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["mask", "number"])

    ship_package(masks.sparkSession)
    skip = known.mapInArrow(number, "mask string, number bigint").groupBy(
        "mask", F.floor(F.col("number") / FILLING_BLOCK).alias("block")).agg(F.collect_list("number").alias("skip"))
    return _write_out(_blocks(masks, mask_col, "nondecreasing").join(skip, ["mask", "block"], "left"), "nondecreasing")


def known_fillings(masks: DataFrame, numbers: DataFrame, keep_head: int, keep_tail: int,
                   mask_col: str = "mask", number_col: str = "number") -> DataFrame:
    """``(mask, candidate)``: the known numbers that a mask's non-decreasing fillings would list,
    without listing them: numbers are masked by the same rule and joined on the mask, and their
    hidden digits must not fall."""
    number = F.col("candidate")
    hidden = F.regexp_replace(F.substring(number, F.lit(keep_head + 1), F.greatest(
        F.length(number) - keep_head - keep_tail, F.lit(0))), r"\D", "")
    rising = F.array_join(F.array_sort(F.split(hidden, "")), "") == hidden
    known = numbers.select(F.col(number_col).alias("candidate")).distinct().where(rising).withColumn(
        "mask", mask_number(number, keep_head, keep_tail))
    return known.join(masks.select(F.col(mask_col).alias("mask")).distinct(), "mask").select("mask", "candidate")


def extract_numbers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    pattern: str = PHONE_PATTERN) -> DataFrame:
    """Phone numbers written in documents, with their compact form ``+<digits>``."""
    return (
        spread(docs.select(id_col, text_col))
        .select(id_col, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(f"({pattern})"), 1))
                    .alias("pos", "raw"))
        .select(id_col, "pos", "raw",
                F.concat(F.lit("+"), F.regexp_replace("raw", r"\D", "")).alias("number"))
    )


def classify_numbers(numbers: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(phone_info rows, error rows) of loosely extracted numbers, read off the written form.

    A number is valid if it is written ``+<code> (<area>) <rest>`` with ten national digits and
    an area code that starts with 2 to 9.  Every other one is an error row with the raw text as
    its message, a code and a cause; errors of form have a known code, others have none."""
    code = F.regexp_extract("raw", r"^\+(\d+)", 1)
    area = F.regexp_extract("raw", r"^\+\d+ \((\d{3})\)", 1)
    rest = F.regexp_replace(F.regexp_extract("raw", r"^\+\d+ (.*)$", 1), r"\D", "")
    cause = (F.when(area == "", "no area code").when(F.length(rest) != 10, "not ten national digits")
             .when(~area.rlike("^[2-9]"), "area code out of range"))
    # A form that can't be read is code 2 of the lookup; a readable number out of range has code
    # 9, which the lookup doesn't hold.
    code_of = F.when(cause == "area code out of range", 9).otherwise(2)
    read = numbers.withColumn("cause", cause)
    info = read.where(F.col("cause").isNull()).select(
        id_col, "pos", F.col("number").alias("international_number"), code.alias("international_calling_code"),
        area.alias("prefix_network"), F.lit(True).alias("is_valid"), F.lit(None).cast("int").alias("error_code"))
    errors = read.where(F.col("cause").isNotNull()).select(
        id_col, "pos", F.col("number").alias("international_number"), F.col("raw").alias("message"),
        code_of.alias("error_code"), "cause")
    return info, errors


def normalise_records(records: DataFrame, msg_col: str = "message") -> tuple[DataFrame, DataFrame]:
    """Parse provider JSON once; return (phone_info rows, error rows).

    Absent keys become nulls; ``type`` maps to ``phone_type``; ``location`` is kept as
    an extra nullable column.  A message that can't be parsed, a null one, or one without a
    number and without an error code is an error row too, with the raw message and the cause.
    """
    keys = [c for c in records.columns if c != msg_col]
    strict = T.StructType([*RECORD_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    parsed = records.select(*keys, F.col(msg_col).alias("_raw"), F.from_json(
        F.col(msg_col), strict, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    cause = (F.when(F.col("_raw").isNull(), "no message").when(F.col("r").isNull() | F.col("r._bad").isNotNull(), "malformed")
             .when(F.col("r.`api-error`").isNotNull(), "api error")
             .when(F.col("r.`international-number`").isNull(), "no number"))
    parsed = parsed.withColumn("cause", cause)
    info = parsed.where(F.col("cause").isNull()).select(
        *keys, *[F.col(f"r.`{k}`").alias(c) for k, c, _ in RECORD_FIELDS],
        F.lit(None).cast("int").alias("error_code"))
    errors = parsed.where(F.col("cause").isNotNull()).select(
        *keys, *[F.col(f"r.`{k}`").alias(c) for k, c, _ in ERROR_FIELDS], F.col("_raw").alias("message"), "cause")
    return info, errors


def upsert_latest(rows: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Primary-key upsert: the row with the largest ``order_cols`` wins per key.

    ``max_by`` over a struct is a partial (map-side) aggregate, so a hot key is reduced
    before the shuffle instead of being sorted whole in one task.
    """
    others = [c for c in rows.columns if c not in key_cols]
    order = F.struct(*[F.col(c) for c in order_cols])
    return rows.groupBy(*key_cols).agg(F.max_by(F.struct(*others), order).alias("_r")) \
        .select(*key_cols, *[F.col(f"_r.{c}").alias(c) for c in others])


def resolve_error_codes(info: DataFrame, codes: DataFrame, code_col: str = "error_code") -> DataFrame:
    """FK lookup with ``ON DELETE SET NULL`` semantics: unknown codes become null."""
    known = codes.select(F.col("id").alias("_id"), F.col("description").alias("error_description"))
    j = info.join(known, info[code_col] == known["_id"], "left")
    return j.withColumn(code_col, F.when(F.col("_id").isNotNull(), F.col(code_col))).drop("_id")
