"""Connected components: the links of late rounds are few, whatever the number of shuffle partitions."""

from pyspark.sql import functions as F

from tallyloom.operators.linkage import connected_components


def test_few_links_start_few_tasks(spark):
    """On a table with 211 partitions, late rounds once started thousands of tasks, whose files and log were most of the disk in use."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few links", "connected components of a path")
        edges = spark.range(200).select(F.col("id").alias("id_l"), (F.col("id") + 1).alias("id_r"))
        got = {tuple(r) for r in connected_components(edges).collect()}
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("few links")]
        stages = [sc.statusTracker().getStageInfo(s) for s in {s for j in jobs for s in j.stageIds}]
        ran = sum(s.numCompletedTasks for s in stages if s)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {(i, 0) for i in range(201)}
    assert 0 < ran < 4000


def test_ids_may_be_text_and_links_none(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "x"), (None, "y"), ("b", "a")], "id_l string, id_r string")
    assert {tuple(r) for r in connected_components(edges).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert connected_components(edges.where("false")).collect() == []
