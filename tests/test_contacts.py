from pyspark.sql import functions as F

from tessera.operators import contacts as T


def test_sample_mask_expansion(spark):
    masks = spark.createDataFrame([("+628********3",)], "mask STRING")
    cands = T.expand_masks(masks)
    rows = sorted(r["candidate"] for r in cands.collect())
    assert len(rows) == 24310 == len(set(rows))
    assert rows[0] == "+628000000003" and rows[-1] == "+628999999993"
    small = spark.createDataFrame([("1*2*",), ("77",)], "mask STRING")
    allm = sorted(r["candidate"] for r in T.expand_masks(small, mode="all").collect())
    assert len(allm) == 101 and "77" in allm and "1920" in allm
    nd = sorted(r["candidate"] for r in T.expand_masks(small).collect())
    assert len(nd) == 56 and "1920" not in nd and "1029" in nd


def test_mask_number_and_extraction(spark):
    docs = spark.createDataFrame([(1, "call +1 (743) 555-3824 or +1 (523) 555-1055."), (2, "none")],
                                 "doc_id BIGINT, text STRING")
    nums = T.extract_numbers(docs)
    got = [(r["number"], r["m"]) for r in nums.select("number", T.mask_number(F.col("number"), 5, 2).alias("m"))
           .orderBy("pos").collect()]
    assert got == [("+17435553824", "+1743*****24"), ("+15235551055", "+1523*****55")]


def test_records_upsert_and_fk(spark):
    msgs = spark.createDataFrame([
        (1, 0, '{"international-number": "+1", "valid": true, "is-mobile": false, "type": "mobile", "country": "X"}'),
        (2, 0, '{"international-number": "+1", "valid": false, "type": "voip"}'),
        (3, 0, '{"api-error": 2, "api-error-msg": "bad"}'),
    ], "doc_id BIGINT, pos INT, message STRING")
    info, errors = T.normalise_records(msgs)
    assert info.count() == 2 and errors.first()["error_code"] == 2
    row = [r for r in info.collect() if r["doc_id"] == 2][0]
    assert row["phone_type"] == "voip" and row["country"] is None and row["location"] is None
    latest = T.upsert_latest(info.withColumn("error_code", F.lit(9)), ["international_number"], ["doc_id", "pos"])
    codes = spark.createDataFrame(T.ERROR_CODES, "id INT, description STRING")
    out = T.resolve_error_codes(latest, codes).collect()
    assert len(out) == 1 and out[0]["doc_id"] == 2 and out[0]["error_code"] is None


def test_malformed_records_are_errors(spark):
    msgs = spark.createDataFrame([(1, "{not json"), (2, None), (3, '{"valid": true}'), (4, '{"international-number": "+5"}')],
                                 "doc_id BIGINT, message STRING")
    info, errors = T.normalise_records(msgs)
    assert [r["doc_id"] for r in info.collect()] == [4]
    got = {r["doc_id"]: (r["cause"], r["message"]) for r in errors.collect()}
    assert got == {1: ("malformed", "{not json"), 2: ("no message", None), 3: ("no number", '{"valid": true}')}


def test_numbers_are_classified(spark):
    docs = spark.createDataFrame([(1, "+1 (743) 555-3824 x +1 (043) 555-3824 y +49 30 1234567")], "doc_id BIGINT, text STRING")
    info, errors = T.classify_numbers(T.extract_numbers(docs, pattern=T.LOOSE_PATTERN))
    assert [r["international_number"] for r in info.collect()] == ["+17435553824"]
    assert sorted((r["cause"], r["error_code"]) for r in errors.collect()) == [("area code out of range", 9), ("no area code", 2)]


def test_long_masks_and_known_fillings(spark):
    import math
    long = spark.createDataFrame([("*" * 13,)], "mask STRING")
    out = T.expand_masks(long)
    assert out.count() == math.comb(22, 9) and out.agg(F.max("candidate")).first()[0] == "9" * 13
    masks = spark.createDataFrame([("+1743*****24",), ("77",)], "mask STRING")
    numbers = spark.createDataFrame([("+17431122324",), ("+17435553824",), ("77",), ("+17441122324",)], "number STRING")
    exp = T.expand_masks(masks).join(numbers.withColumnRenamed("number", "candidate"), "candidate", "left_semi")
    got = T.known_fillings(masks, numbers, 5, 2)
    assert sorted(map(tuple, got.select("mask", "candidate").collect())) == sorted(map(tuple, exp.select("mask", "candidate").collect()))
    assert masks.select(T.filling_count(T.star_count(F.col("mask")))).collect()[0][0] == math.comb(14, 9)


def test_fillings_and_their_numbers():
    import itertools

    import numpy as np

    for stars in range(5):
        want = list(itertools.combinations_with_replacement(range(10), stars))
        got = T.fillings(0, len(want), stars, "nondecreasing")
        assert [tuple(r) for r in got.tolist()] == want
        assert T.filling_number(got).tolist() == list(range(len(want)))
        assert [tuple(r) for r in T.fillings(3, 9, stars, "nondecreasing").tolist()] == want[3:9][:max(len(want) - 3, 0)] or stars == 0
    assert ["".join(map(str, r)) for r in T.fillings(95, 103, 3, "all").tolist()] == [f"{i:03d}" for i in range(95, 103)]
    many = T.fillings(5 * 10 ** 10, 5 * 10 ** 10 + 5, 60, "nondecreasing")
    assert (np.diff(many.astype(int), axis=1) >= 0).all() and T.filling_number(many).tolist() == list(range(5 * 10 ** 10, 5 * 10 ** 10 + 5))


def test_unknown_fillings_are_the_rest(spark, monkeypatch):
    monkeypatch.setattr(T, "FILLING_BLOCK", 10)
    monkeypatch.setattr(T, "FILLING_SLICE", 4)
    numbers = ["+12 12399", "+12 00099", "+12 32199", "+12 99999", "+77 12377", "+1x 11199"]
    masks = ["+12 ***99", "+77 ***77", "+9", "é***", None]
    m = spark.createDataFrame([(x,) for x in masks], "mask STRING")
    k = spark.createDataFrame([(x,) for x in numbers], "number STRING")
    every = {(r.mask, r.candidate) for r in T.expand_masks(m).collect()}
    assert len(every) == 3 * 220 + 1 and ("+9", "+9") in every and ("é***", "é012") in every
    rest = [(r.mask, r.candidate) for r in T.unknown_fillings(m, k, 4, 2).collect()]
    assert len(rest) == len(set(rest)) and set(rest) == {x for x in every if x[1] not in numbers}
    assert len(every) - len(rest) == 4
