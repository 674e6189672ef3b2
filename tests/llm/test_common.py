"""Staged writes."""

import glob
import os

from concordat.llm import common


def shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(os.path.join(d, "*", "shuffle_*.data"))}


def test_a_staged_write_leaves_no_shuffle_files(spark):
    held, was = shuffle_files(spark), spark.conf.get(common.CLEANUP)
    counted = common.written(spark.range(100_000).repartition(7).groupBy((common.F.col("id") % 1000).alias("k")).count(), "counted")
    left = {f for f in shuffle_files(spark) - held if os.path.exists(f)}
    assert counted.count() == 1000 and counted.where("count != 100").count() == 0
    assert not left and spark.conf.get(common.CLEANUP) == was
