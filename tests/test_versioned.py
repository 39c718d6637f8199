"""Versions that several publishers make at once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from clickledger.sources.versioned import publish, read_version


def test_publishers_at_once_get_different_numbers(spark, tmp_path):
    root = str(tmp_path / "versions")

    def one(value):
        return publish(spark, root, {"t": lambda: spark.range(1).select(F.lit(value).alias("v"))})

    one(0)
    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(one, range(1, 4)))
    log = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/published").orderBy("number").collect()
    assert [r.number for r in log] == [1, 2, 3, 4] and {r.version for r in log[1:]} == set(versions)
    newest = versions.index(log[-1].version) + 1
    assert read_version(spark, root, "t").first().v == newest
