import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import metadata
from tidemark.sources import files, generate, incremental, jdbc, messages, schemas
from tidemark.streaming import runs


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)
    return f"{path}/{name}"


def run(stream, path):
    runs.run_available(stream, f"{path}/table", f"{path}/checkpoint")


def test_create_table_as(spark, rows):
    files.create_table(spark.range(3), "ctas")
    files.create_table(spark.range(2), "ctas")
    assert rows(spark.table("ctas")) == [(0,), (1,)]
    with pytest.raises(Exception, match="exists"):
        files.create_table(spark.range(1), "ctas", replace=False)
    spark.sql("DROP TABLE ctas")


def test_csv_inferred_and_with_schema(spark, rows, path):
    put(path + "/in", "a.csv", "id,price\n1,2.5\n2,\n")
    assert files.read_csv(spark, path + "/in").dtypes == [("id", "int"), ("price", "double")]
    assert rows(files.read_csv(spark, path + "/in", "id string, price double")) == [("1", 2.5), ("2", None)]


def test_csv_permissive_keeps_bad_lines(spark, rows, path):
    put(path + "/in", "a.csv", "id,name\n1,x\n3\n4,5,6\n2,y\n")
    schema = StructType.fromDDL("id int, name string")
    got = rows(files.read_csv_permissive(spark, path + "/in", schema))
    assert got == [(1, "x", None), (2, "y", None), (3, None, "3"), (4, "5", "4,5,6")]
    assert rows(files.sound_rows(files.read_csv_permissive(spark, path + "/in", schema))) == [(1, "x"), (2, "y")]


def test_json_lines_and_documents(spark, rows, path):
    put(path + "/lines", "a.json", '{"a": 1}\n{"a": 2, "b": "x"}\n')
    assert rows(files.read_json(spark, path + "/lines")) == [(1, None), (2, "x")]
    put(path + "/docs", "a.json", json.dumps([{"a": 1}, {"a": 2}], indent=2))
    assert rows(files.read_json(spark, path + "/docs", multi_line=True)) == [(1,), (2,)]
    assert rows(spark.sql(f"SELECT a FROM json.`{path}/lines`")) == [(1,), (2,)]


def test_audit_columns(spark, path):
    put(path + "/in", "a.json", '{"a": 1}\n')
    df = files.with_audit(files.read_json(spark, path + "/in"), method="batch", run_id="r1", loaded_at="t", _env="dev")
    row = df.first()
    assert (row._ingestion_method, row._ingestion_run_id, row._env, row._ingested_at) == ("batch", "r1", "dev", "t")
    assert row._source_file.endswith("/in/a.json")
    assert files.without_audit(df).columns == ["a"]


def test_append_with_new_column_and_single_file_export(spark, rows, path):
    files.append(spark.createDataFrame([(1,)], "a int"), path + "/t")
    files.append(spark.createDataFrame([(2, "x")], "a int, b string"), path + "/t")
    want = [(1, None), (2, "x")]
    assert rows(files.read_merged(spark, path + "/t"), "a", "b") == want
    assert rows(files.read_merged(spark, path + "/t", "a int, b string")) == want
    files.export(spark.range(100).repartition(4), path + "/csv", "csv", single_file=True)
    assert len([n for n in os.listdir(path + "/csv") if n.endswith(".csv")]) == 1


def test_schema_evolution_modes():
    old, new = StructType.fromDDL("a bigint, b string"), StructType.fromDDL("a string, c double")
    assert schemas.evolve(None, new, "none") == new
    assert schemas.evolve(old, new, "addNewColumns").simpleString() == "struct<a:bigint,b:string,c:double>"
    assert schemas.evolve(old, new, "none") == old
    assert schemas.evolve(old, new, "rescue") == old
    with pytest.raises(schemas.NewColumns, match="c"):
        schemas.evolve(old, new, "failOnNewColumns")
    assert schemas.evolve(old, StructType.fromDDL("b string"), "failOnNewColumns") == old
    with pytest.raises(ValueError):
        schemas.evolve(old, new, "guess")
    ints, longs = StructType.fromDDL("a int, s struct<x: int>"), StructType.fromDDL("a double, s struct<x: bigint, y: int>")
    assert schemas.union_schema(ints, longs).simpleString() == "struct<a:double,s:struct<x:bigint,y:int>>"


def test_loader_takes_each_file_once(spark, rows, path):
    landing = path + "/landing"
    put(landing, "1.json", "".join(json.dumps({"id": i}) + "\n" for i in range(30)))
    for _ in range(2):
        run(incremental.load_files(spark, landing, "json", path + "/schema", "none"), path)
    assert spark.read.parquet(path + "/table").count() == 30
    put(landing, "2.json", "".join(json.dumps({"id": i}) + "\n" for i in range(30, 50)))
    run(incremental.load_files(spark, landing, "json", path + "/schema", "none"), path)
    table = spark.read.parquet(path + "/table")
    assert rows(metadata.source_file_totals(table, "_source_file")) == [(50, 2)]
    per_file = metadata.source_file_counts(table, "_source_file", "_load_time")
    assert [r.records for r in per_file.orderBy("first_load").collect()] == [30, 20]


def test_new_column_is_null_in_old_rows(spark, rows, path):
    landing = path + "/landing"
    put(landing, "1.json", '{"id": 1}\n{"id": 2}\n')
    run(incremental.load_files(spark, landing, "json", path + "/schema", "addNewColumns"), path)
    put(landing, "2.json", '{"id": 3, "referrer": "r"}\n')
    stream = incremental.load_files(spark, landing, "json", path + "/schema", "addNewColumns")
    run(stream, path)
    assert rows(files.read_merged(spark, path + "/table", stream.schema), "id", "referrer") == [
        (1, None), (2, None), (3, "r")]
    put(landing, "3.json", '{"id": 4, "other": 1}\n')
    with pytest.raises(schemas.NewColumns):
        incremental.load_files(spark, landing, "json", path + "/schema", "failOnNewColumns")


def test_inference_looks_at_unseen_files_only_and_at_no_clock(spark, path):
    put(path + "/in", "1.json", '{"a": 1}\n')
    args = (spark, path + "/in", "json", path + "/schema")
    assert incremental.prepare_schema(*args, "addNewColumns")[1] == ["a"]
    assert incremental.pending_files(spark, path + "/in", path + "/schema") == []
    assert incremental.prepare_schema(*args, "addNewColumns")[1] == ["a"]  # nothing pending
    late = put(path + "/in", "2.json", '{"b": 1}\n')
    os.utime(late, (time.time() - 5 * 86_400,) * 2)  # a copy that kept its time
    with pytest.raises(schemas.NewColumns):
        incremental.prepare_schema(*args, "failOnNewColumns")
    assert incremental.prepare_schema(*args, "addNewColumns")[1] == ["a", "b"]
    assert schemas.stored_schema(spark, path + "/schema")[0].names == ["a", "b"]


def test_values_that_do_not_fit_are_rescued_while_columns_are_added(spark, rows, path):
    landing = path + "/landing"
    put(landing, "1.json", '{"n": 1}\n')
    run(incremental.load_files(spark, landing, "json", path + "/schema", "addNewColumns"), path)
    put(landing, "2.json", '{"n": "x", "m": 2}\n')
    stream = incremental.load_files(spark, landing, "json", path + "/schema", "addNewColumns")
    run(stream, path)
    table = files.read_merged(spark, path + "/table", stream.schema)
    assert rows(table, "n", "m", "_rescued_data") == [(None, 2, '{"n":"x"}'), (1, None, None)]


def test_rescue_json(spark, rows):
    schema = StructType.fromDDL("id bigint, price double, day date, tags array<string>, s struct<x: int>")
    lines = spark.createDataFrame([
        ('{"id": 1, "price": 2.5, "day": "2024-01-02", "tags": ["a"], "s": {"x": 3}}',),
        ('{"id": "x", "price": 3, "extra": {"k": 1}}',), ('{"id": null}',), ("not json",), (None,)], "value string")
    got = [(r.id, r.price, str(r.day), r.tags, r.s and r.s.x, r._rescued_data)
           for r in incremental.rescue_json(lines, schema).collect()]
    assert got == [
        (1, 2.5, "2024-01-02", ["a"], 3, None),
        (None, 3.0, "None", None, None, '{"extra":"{\\"k\\":1}","id":"x"}'),
        (None, None, "None", None, None, None),
        (None, None, "None", None, None, '{"_corrupt_record":"not json"}'),
        (None, None, "None", None, None, None)]


def test_rescue_csv_stream(spark, rows, path):
    landing = path + "/landing"
    put(landing, "1.csv", "id,price\n1,2.5\n")
    run(incremental.load_files(spark, landing, "csv", path + "/schema", "rescue"), path)
    put(landing, "2.csv", "id,price\nx,3\n")
    run(incremental.load_files(spark, landing, "csv", path + "/schema", "rescue"), path)
    assert rows(spark.read.parquet(path + "/table"), "id", "price", "_rescued_data") == [
        (None, 3.0, '{"id":"x"}'), (1, 2.5, None)]


def test_csv_gains_a_column(spark, rows, path):
    """A longer header in a later file: added, rescued, ignored or refused, by mode."""
    want = {"addNewColumns": [(1, None, None), (2, "x", None), (3, None, None)], "none": [(1,), (2,), (3,)],
            "rescue": [(1, None), (2, '{"more":"x"}'), (3, None)]}
    for mode, expected in want.items():
        root = f"{path}/{mode}"
        put(root + "/in", "1.csv", "id\n1\n")
        run(incremental.load_files(spark, root + "/in", "csv", root + "/schema", mode), root)
        put(root + "/in", "2.csv", "id,more\n2,x\n")
        put(root + "/in", "3.csv", "id\n3\n")
        stream = incremental.load_files(spark, root + "/in", "csv", root + "/schema", mode)
        run(stream, root)
        table = spark.read.schema(stream.schema).parquet(root + "/table").drop("_source_file", "_load_time")
        assert rows(table) == expected, mode
    put(path + "/fail", "1.csv", "id\n1\n")
    incremental.load_files(spark, path + "/fail", "csv", path + "/fail-schema", "failOnNewColumns")
    put(path + "/fail", "2.csv", "id,more\n2,x\n")
    with pytest.raises(schemas.NewColumns):
        incremental.load_files(spark, path + "/fail", "csv", path + "/fail-schema", "failOnNewColumns")


def test_csv_headers_in_another_order_are_refused(spark, path):
    put(path + "/in", "1.csv", "id,name\n1,a\n")
    put(path + "/in", "2.csv", "name,id\nb,2\n")
    for mode in ("rescue", "addNewColumns", "none"):
        with pytest.raises(incremental.MixedLayout):
            incremental.load_files(spark, path + "/in", "csv", f"{path}/schema-{mode}", mode)
    assert incremental.csv_names(["a"], [["a", "b", "c"], ["a", "b"]]) == ["a", "b", "c"]


def test_rescue_columns_keeps_unknown_columns(spark, rows):
    texts = spark.createDataFrame([("1", "a", "f"), ("z", None, "g")], "id string, more string, _source_file string")
    got = rows(incremental.rescue_columns(texts, StructType.fromDDL("id int, missing double")))
    assert got == [(None, None, "g", '{"id":"z"}'), (1, None, "f", '{"more":"a"}')]


def test_loader_options(spark, path):
    for i in range(3):
        put(path + "/in/sub", f"{i}.json", '{"a": 1}\n')
    put(path + "/in/sub", "skip.txt", "x\n")
    stream = incremental.file_stream(spark, path + "/in", "json", "a int", max_files=1, glob="*.json", recursive=True)
    done = runs.run_available(stream, path + "/table", path + "/checkpoint")
    assert len([p for p in done.recentProgress if p.numInputRows]) == 3
    assert spark.read.parquet(path + "/table").count() == 3


def test_copy_into_loads_only_new_files(spark, path):
    put(path + "/in", "1.csv", "a\n1\n2\n")
    args = (spark, path + "/in", "csv", "a int", path + "/table", path + "/checkpoint")
    assert incremental.copy_into(*args, header="true") == 2
    assert incremental.copy_into(*args, header="true") == 0
    put(path + "/in", "2.csv", "a\n3\n")
    assert incremental.copy_into(*args, header="true") == 1
    assert spark.read.parquet(path + "/table").count() == 3


def test_rewritten_table_is_no_stream_source(spark, path):
    os.makedirs(path + "/t/_history")
    with pytest.raises(ValueError, match="batch"):
        incremental.table_stream(spark, path + "/t", "a int")


def test_envelope_round_trip_and_bad_payload(spark, rows):
    df = spark.sql("SELECT 'k' AS key, 1 AS a, timestamp'2024-01-01 00:00:00' AS at")
    packed = messages.to_envelope(df, "key", ["a"], "topic", F.lit(7), F.col("at"))
    bad = packed.withColumn("value", F.lit("oops").cast("binary"))
    parsed = messages.parse_envelope(packed.unionByName(bad), "a int", keep=("topic", "offset"))
    assert rows(parsed) == [("k", None, "topic", 7), ("k", 1, "topic", 7)]


def test_click_events_and_rate_stream(spark):
    numbered = spark.range(500).select(F.col("id").alias("value"), F.current_timestamp().alias("timestamp"))
    df = messages.click_events(numbered)
    assert {r[0] for r in df.select("action").distinct().collect()} == {"open", "close", "scroll"}
    assert df.filter("NOT customer_id RLIKE '^user-0[0-4][0-9]{2}$' OR NOT product_id RLIKE '^item-0[01][0-9]{2}$'").count() == 0
    long = numbered.select(messages.padded(F.lit(12_345), 3).alias("a"), messages.padded(F.lit(7), 3).alias("b")).first()
    assert tuple(long) == ("12345", "007")
    stream = messages.rate_events(spark)
    assert stream.isStreaming and stream.columns == ["timestamp", "customer_id", "product_id", "action"]


def test_flatten_and_change_rows(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": 2}}'), (2, "x")], "id int, js string")
    assert rows(messages.flatten(df, "js", "a int, b struct<c: int>").select("id", "a", "b.c")) == [
        (1, 1, 2), (2, None, None)]
    rows_in = spark.createDataFrame([("insert", 5, 1)], "op string, lsn int, k int")
    assert messages.change_rows(rows_in, "op", ["lsn"], ["k", "lsn"]).first() == ("INSERT", 5, 1)


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:x", "t", user="u", partition_column="id", lower_bound=0, upper_bound=100,
                                num_partitions=4)
    assert options == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "pushDownPredicate": "true", "user": "u",
                       "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    assert "numPartitions" not in jdbc.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", num_partitions=4)


def test_high_water_mark_is_pushed_down(spark, rows, plan, path):
    spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_interval(0,0,0,id) at FROM range(10)").write.parquet(path + "/s")
    source = spark.read.parquet(path + "/s")
    newer = jdbc.newer_than_mark(source, source.filter("id <= 6"), "at")
    assert rows(newer, "id") == [(7,), (8,), (9,)]
    assert "GreaterThan(at" in plan(newer)
    assert jdbc.newer_than_mark(source, source.limit(0), "at").count() == 10


def test_generated_orders_are_seeded_and_dirty(spark):
    n = 20_000
    df = generate.sales_orders(spark, n)
    shares = df.agg(F.count_if(F.expr("customer_id IS NULL")), F.count_if(F.expr("unit_price < 0")), F.count_if(F.expr("discount_pct > 0")),
                    F.count_if(F.col("status") == "done"), F.countDistinct("order_id"), F.min("quantity"),
                    F.max("quantity")).first()
    assert all(abs(x / n - want) < 0.012 for x, want in zip(shares, (0.05, 0.02, 0.25, 0.75)))
    assert tuple(shares[4:]) == (n, 1, 9)
    hashed = lambda d: d.agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    assert hashed(df) == hashed(generate.sales_orders(spark, n).repartition(3))
    assert hashed(df) != hashed(generate.sales_orders(spark, n, seed=43))
