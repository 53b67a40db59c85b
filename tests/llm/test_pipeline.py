from pyspark.sql import functions as F

import corpus_pipeline as P


def test_stages_on_test_tables(spark, tmp_path):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(P.STAGES):
        out = str(tmp_path / str(i))
        stage(spark, docs, d).write.parquet(out)
        docs = spark.read.parquet(out)
        seen.append(docs.count())
        if i < len(P.STAGES) - 1:
            assert docs.columns == columns, name
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.6 * seen[0]
    assert docs.select("shard").distinct().count() == P.SHARDS
    assert docs.groupBy("shard").agg((F.max("slot") + 1 - F.count("*")).alias("x")).where("x <> 0").count() == 0
    assert P.run(spark, d).count() == seen[-1]
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
