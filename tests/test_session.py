from tidemark import session


def test_shuffle_partitions_grow_with_the_input():
    gb = 1024 ** 3
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(10 * gb, 8) == 40
    assert session.shuffle_partitions(100 * 1024 * gb, 4000) == 409_600


def test_a_query_leaves_the_session_as_it_was(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    before = spark.sparkContext.getConf()
    try:
        with session.runtime_conf(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
            assert before.contains("spark.sql.session.timeZone")  # launched with one: left alone
            assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_work_folders_are_deleted(spark):
    path = session.work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.delete_work_folders(spark)
    assert not session.path_exists(spark, path)


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_stored_and_sizes(spark, rows, path):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    kept = session.stored(df, "t")
    assert rows(kept) == rows(df) and "FileScan" in kept._jdf.queryExecution().executedPlan().toString()
    df.write.parquet(path + "/t")
    assert session.path_exists(spark, path + "/t") and not session.path_exists(spark, path + "/no")


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    class Conf:
        def get(self, key, default=None):
            return "hdfs://lake/warehouse" if key == "spark.sql.warehouse.dir" else default

    class Cluster:
        conf = Conf()

    assert session.shared_dir(Cluster()) == "hdfs://lake/warehouse/_work"
