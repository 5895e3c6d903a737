"""The shared work folder comes from the session's spark.checkpoint.dir."""

from postflow.session import scratch, work_dir


def test_scratch_is_under_the_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured
    base = work_dir(spark)
    assert base == configured.rstrip("/")
    a, b = scratch(spark, "q"), scratch(spark, "q")
    assert a.startswith(base + "/postflow/q-") and a != b


def test_scratch_folders_are_removed_on_request(spark):
    from postflow import fs
    from postflow.session import drop_scratch
    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark)
    assert not fs.exists(spark, path)


def test_scratch_tables_leave_the_catalog(spark):
    from postflow.session import drop_scratch, scratch_namespace, scratch_table
    path = scratch(spark, "named")
    spark.range(3).write.option("path", path).saveAsTable("postflow_scratch_test")
    scratch_table("postflow_scratch_test")
    name = scratch_namespace(spark, "names")
    assert spark.catalog.tableExists("postflow_scratch_test") and spark.catalog.databaseExists(name)
    drop_scratch(spark)
    assert not spark.catalog.tableExists("postflow_scratch_test") and not spark.catalog.databaseExists(name)
