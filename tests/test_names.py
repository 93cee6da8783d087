"""File-name rules and the small Python helpers."""

from pyspark.sql import functions as F

from nestwork.functions import names as nm
from nestwork.functions.udfs import distance_km, with_name_status


def test_json_file_names(spark):
    df = spark.createDataFrame([("x/A.JSON.GZ?x=1",), ("a.json",), ("a.gz",), ("a.csv",), ("b.json.gzip",)], "p string")
    got = [r.n for r in df.select(nm.json_file_name("p").alias("n")).collect()]
    assert got == ["a.json", "a.json", "a.json", None, "b.json"]


def test_other_name_rules(spark):
    df = spark.createDataFrame([("https://h/dir/f.json.gz?sig=1",)], "p string")
    r = df.select(nm.base_name("p").alias("b"), nm.url_stem("p").alias("s"), nm.is_compressed("p").alias("c"),
                  nm.strip_gz(F.lit("x.json.gz")).alias("g"),
                  nm.join_path(F.lit("/vol/a/"), F.lit("b")).alias("j")).first()
    assert (r.b, r.s, r.c, r.g, r.j) == ("f.json.gz?sig=1", "f", True, "x.json", "/vol/a/b")


def test_distance_null_in_null_out(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "m double")
    got = [r.km for r in df.select(distance_km("m").alias("km")).collect()]
    assert abs(got[0] - 1.60934) < 1e-6 and got[1] is None


def test_pandas_status_udf(spark):
    df = spark.createDataFrame([("a.json.gz?x",), ("a.csv",), (None,)], "p string")
    got = [(r.s.success, r.s.message) for r in df.transform(lambda d: with_name_status(d, "p", "s")).collect()]
    assert got[0] == (True, "ok") and got[1][0] is False and got[2][0] is False
