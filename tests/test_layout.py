from pyspark.sql import functions as F

from tidemark.operators import layout, metadata


def test_files_for():
    assert [layout.files_for(n, 100) for n in (0, 1, 100, 101)] == [1, 1, 1, 2]


def test_compact_keeps_rows_and_reduces_files(spark, rows, path):
    df = spark.range(1000)
    df.repartition(20).write.parquet(path + "/small")
    assert layout.compact(spark, path + "/small", path + "/large") == 1
    assert spark.read.parquet(path + "/large").count() == 1000
    files = metadata.file_sizes(spark, path + "/large").filter(F.col("path").endswith(".parquet"))
    assert files.count() == 1


def test_interleave(spark):
    got = spark.range(1).select(layout.interleave([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert got == 0b011011


def test_quantile_buckets_follow_a_skewed_distribution(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") < 900, F.col("id")).otherwise(F.col("id") * 1_000_000))
    sizes = layout.quantile_buckets(df, {"v": "b"}, 8).groupBy("b").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 260


def test_quantile_bucket_keeps_null_and_constant_columns(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "v int")
    assert layout.quantile_buckets(df, {"v": "b"}, 4).count() == 3


def test_zorder_lets_both_columns_skip_files(spark, rows, path):
    df = spark.range(10_000).select(F.col("id"), (F.xxhash64("id") % 1000).alias("a"),
                                    (F.xxhash64("id", F.lit(1)) % 1000).alias("b"))
    layout.zorder(df, ["a", "b"], files=16, bits=4).write.parquet(path + "/z")
    stored = spark.read.parquet(path + "/z")
    assert rows(stored.agg(F.count("*"), F.sum("id"))) == [(10_000, 49_995_000)]
    ranges = layout.file_ranges(stored, ["a", "b"])
    for column in ("a", "b"):
        hit = (F.col(f"min_{column}") <= 900) & (F.col(f"max_{column}") >= 900)
        report = layout.skip_report(ranges, hit).first()
        assert report.files == 16 and report.files_read <= 8


def test_derived_partition_is_pruned(spark, rows, plan, path):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01 06:00:00' + make_interval(0,0,0,id) ts FROM range(10)")
    layout.write_by_day(df, path + "/d", "ts")
    got = layout.between(spark.read.parquet(path + "/d"), "ts", "2024-01-03", "2024-01-05")
    assert rows(got, "id") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(_day" in plan(got)


def test_rewrite_partitions_leaves_the_others_alone(spark, rows, path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id int, p string")
    df.write.partitionBy("p").parquet(path + "/t")
    before = {r.path: r.length for r in metadata.file_sizes(spark, path + "/t").filter("path LIKE '%p=b%'").collect()}
    gone = F.col("id").isin(1, 4)
    touched = spark.read.parquet(path + "/t").filter(gone).select("p")
    layout.rewrite_partitions(spark, path + "/t", "p", touched, lambda r: r.filter(~gone))
    assert rows(spark.read.parquet(path + "/t"), "id", "p") == [(2, "a"), (3, "b")]
    after = {r.path: r.length for r in metadata.file_sizes(spark, path + "/t").filter("path LIKE '%p=b%'").collect()}
    assert before == after


def test_rewrite_partitions_reaches_the_null_partition_and_keeps_the_type(spark, rows, path):
    df = spark.sql("SELECT id, CASE id WHEN 1 THEN date'2024-01-01' WHEN 2 THEN date'2024-01-02' END AS d FROM range(1, 5)")
    df.write.partitionBy("d").parquet(path + "/t")
    for gone, left in (("id IN (1, 3)", [2, 4]), ("id = 4", [2])):
        touched = spark.read.parquet(path + "/t").filter(gone).select("d")
        layout.rewrite_partitions(spark, path + "/t", "d", touched, lambda r: r.filter(f"NOT ({gone})"))  # noqa: B023
        table = spark.read.parquet(path + "/t")
        assert [r[0] for r in rows(table, "id")] == left and table.schema["d"].dataType.typeName() == "date"


def test_curve_bits_follow_the_files():
    assert [layout.curve_bits(f, 2) for f in (1, 16, 32, 4096, 1 << 20)] == [1, 3, 4, 7, 11]


def test_storage_by_table(spark, rows, path):
    spark.range(10).write.parquet(path + "/a.parquet")
    spark.range(1000).coalesce(1).write.parquet(path + "/b.parquet")
    sizes = metadata.file_sizes(spark, path)
    report = metadata.storage_by_table(sizes, F.regexp_extract("path", r"/([ab])\.parquet/", 1))
    assert [r.table_name for r in report.filter("table_name <> ''").collect()] == ["b", "a"]
