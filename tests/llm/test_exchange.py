"""Exchanges of packed rows, in one hop and in two."""

import pytest
from pyspark.sql import functions as F

from quillspan.llm import common, exchange, hpylm, ngram_join


@pytest.mark.parametrize("fan", [100, 7, 1])
def test_rows_reach_their_partition(spark, fan):
    df = spark.range(3000).select((F.col("id") % 37).cast("int").alias("bucket"), "id", F.encode(F.col("id").cast("string"), "utf-8").alias("body")).repartition(5)
    got = exchange.exchange(df, 40, "bucket", fan).withColumn("at", F.spark_partition_id()).collect()
    assert sorted(r.id for r in got) == list(range(3000))
    assert all(r.at == r.bucket == r.id % 37 and bytes(r.body) == str(r.id).encode() for r in got)


def test_operators_are_the_same_in_two_hops(odd, monkeypatch):
    scores = lambda: hpylm.score(odd).select("doc_id", "n_tokens", "n_known", *[F.round(c, 6) for c in ("score", "base_score")])
    run = lambda: [sorted(map(str, df.collect())) for df in (ngram_join.join(odd, count=True), scores())]
    one = run()
    monkeypatch.setattr(exchange, "FAN", 2)
    assert run() == one


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_broadcasts_are_bounded_by_bytes(spark):
    df = spark.createDataFrame([(b"x" * 1000, [1] * 1000, "y", None)] * 10, "a binary, b array<int>, c string, d string")
    plan = lambda x: x._jdf.queryExecution().toString()
    assert "broadcast" in plan(common.broadcast_if_small(df, 300_000)) and "broadcast" not in plan(common.broadcast_if_small(df, 100_000))
    assert "broadcast" in plan(common.broadcast_if_small(df.limit(0), 0))
