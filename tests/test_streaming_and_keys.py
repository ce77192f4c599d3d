from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.functions import compose_key, parse_key, two_decimals
from tessera.operators import chunking as C
from tessera.operators import web as W
from tessera.sources import read_table
from tessera.streaming import run_incremental


def test_incremental_page_links(spark, tmp_path):
    pages = read_table(spark, SF_SMALL, "pages").select("page_id", "html")
    src = str(tmp_path / "src")
    sink = str(tmp_path / "sink")
    schema = pages.schema
    pages.where("page_id < 25").write.parquet(src + "/a")
    ck = str(tmp_path / "ck")
    run_incremental(spark, src + "/a", schema, W.page_links, sink, ck)
    exp = W.page_links(pages.where("page_id < 25"))
    got = spark.read.parquet(sink)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
    # new files arrive: a rerun with the same checkpoint processes only those
    pages.where("page_id >= 25").write.mode("append").parquet(src + "/a")
    run_incremental(spark, src + "/a", schema, W.page_links, sink, ck)
    exp_all = W.page_links(pages)
    got_all = spark.read.parquet(sink)
    assert got_all.count() == exp_all.count() and got_all.exceptAll(exp_all).count() == 0


RESTART = """
import sys
sys.path.insert(0, sys.argv[1])
from tessera.session import build_session
from tessera.operators import chunking as C
from tessera.streaming import run_incremental
spark = build_session(cpus=2, shuffle_partitions=2)
src, sink, ck = sys.argv[2:5]
schema = spark.read.parquet(src).schema
run_incremental(spark, src, schema, C.recursive_chunks, sink, ck)
spark.stop()
"""


def test_restarted_application_adds_new_files_only(spark, tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    src, sink, ck = (str(tmp_path / n) for n in ("src", "sink", "ck"))
    for part in (F.col("doc_id") < 40, F.col("doc_id") >= 40):
        docs.where(part).write.mode("append").parquet(src)
        subprocess.run([sys.executable, "-c", RESTART, root, src, sink, ck], check=True, timeout=300)
    got, exp = spark.read.parquet(sink), C.recursive_chunks(docs)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0


def test_keys_round_trip(spark):
    df = spark.createDataFrame([(12, 3, 1)], "p INT, h INT, s INT")
    k = df.select(compose_key(F.col("p"), F.col("h"), F.col("s")).alias("k"))
    assert k.first()["k"] == "12_3_1"
    parsed = k.select(*[c.alias(n) for c, n in zip(parse_key(F.col("k"), 3), "phs")]).first()
    assert (parsed["p"], parsed["h"], parsed["s"]) == (12, 3, 1)
    assert df.select(two_decimals(F.lit(1.5))).first()[0] == "1.50"
