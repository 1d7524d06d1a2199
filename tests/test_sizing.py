from pyspark.sql import functions as F

from reviewloom.operators import sizing


def test_many_short_ids_are_not_small(spark):
    ids = spark.range(100_000).select(F.lpad("id", 8, "0").alias("id"))
    assert sizing.frame_bytes(ids).first()["bytes"] == 800_000
    assert not sizing.is_small(ids, 2_000_000)
    assert sizing.is_small(ids, 5_000_000)
