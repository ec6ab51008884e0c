from __future__ import annotations

from pyspark.sql import functions as F

from lotline.functions import numbers as N
from lotline.functions import text as T
from lotline.functions.keys import message_key
from lotline.functions.sql import register_functions, register_views


def test_sql_says_the_same(spark, sf):
    assert "message_key" in register_functions(spark)
    assert "nyc_311" in register_views(spark, sf)
    got = spark.sql("select unique_key, message_key(unique_key) k, borough_name(borough) b, address_light(incident_address) l, address_full(incident_address) f from nyc_311")
    want = spark.table("nyc_311").select("unique_key", message_key(F.col("unique_key")).alias("k"), T.borough(F.col("borough")).alias("b"), T.address_light(F.col("incident_address")).alias("l"), T.address_full(F.col("incident_address")).alias("f"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    a = spark.sql("select haversine_m(40.7, -74.0, 40.71, -74.01) d, log_score(5, 10) s, log_score(null, 10) n").first()
    b = spark.range(1).select(N.haversine(*map(F.lit, (40.7, -74.0, 40.71, -74.01))).alias("d"), N.log_score(F.lit(5), 10).alias("s")).first()
    assert abs(a.d - b.d) < 1e-6
    assert abs(a.s - b.s) < 1e-9
    assert a.n is None
