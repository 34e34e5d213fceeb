from pyspark.sql import functions as F

from quillspark.operators.mailstore import NO_MONTH, read_mail_store, scan_store, write_mail_store

ROWS = [(f"c{i % 40}/{i}", "hot@x" if i % 3 else f"r{i % 17}@x", f"day {i % 28 + 1} Dec 2001", "s@x", f"body {i}",
         None if i % 50 == 0 else f"2001-{i % 12 + 1:02d}-{i % 28 + 1:02d} 10:00:00") for i in range(2000)]


def _store(spark, tmp_dir, rows=ROWS):
    df = spark.createDataFrame(rows, "row_key string, recipient string, date_text string, sender string, "
                                     "body string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    write_mail_store(df, tmp_dir + "/mail", 12)
    return read_mail_store(spark, tmp_dir + "/mail")


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scans_equal_filters_of_all_rows(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    want = {r[0] for r in ROWS if r[1] == "hot@x" and r[5] and r[5][:7] == "2001-05"}
    assert {r["row_key"] for r in scan_store(store, "hot@x", "2001-05").collect()} == want and want
    text = {r[0] for r in ROWS if r[1] == "r3@x" and "7 dec" in r[2].lower()}
    assert {r["row_key"] for r in scan_store(store, "r3@x", date_substring="7 DEC").collect()} == text and text
    assert scan_store(store, row_key="c7/7").count() == 1
    assert scan_store(store, month=NO_MONTH).count() == 40
    assert scan_store(store, "nobody@x").count() == 0


def test_plan_prunes_partitions_and_pushes_equality(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    plan = _plan(scan_store(store, "hot@x", "2001-05"))
    assert "PartitionFilters: [isnotnull(month" in plan and "EqualTo(recipient,hot@x)" in plan
    assert "sender" not in plan.split("ReadSchema")[1].split("\n")[0]
    one = scan_store(store, "hot@x", "2001-05")
    assert len(one.inputFiles()) <= len(store.inputFiles())
    files = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("month=2001-05" in r["f"] for r in files)


def test_a_frequent_recipient_is_split_over_files(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    per_file = store.where("recipient = 'hot@x'").groupBy(F.input_file_name()).count().collect()
    hot = sum(r["count"] for r in per_file)
    assert max(r["count"] for r in per_file) < hot / 4


def test_empty_store(spark, tmp_dir):
    df = spark.createDataFrame([], "row_key string, recipient string, date_text string, sender string, "
                                   "body string, ts timestamp")
    write_mail_store(df, tmp_dir + "/mail")
    assert scan_store(read_mail_store(spark, tmp_dir + "/mail"), "a@x").count() == 0
