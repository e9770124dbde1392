"""The shared folder comes from the session."""

import os

from pyspark.sql import functions as F

from listing_lake.session import shared_dir, stored


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    before = set(os.listdir(named))
    df = stored(spark.range(10).withColumn("x", F.col("id") * 2))
    assert len(set(os.listdir(named)) - before) >= 1
    assert df.agg(F.sum("x")).first()[0] == 90
    assert df.inputFiles() and all(named in path for path in df.inputFiles())
