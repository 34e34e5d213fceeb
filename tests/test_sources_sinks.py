import glob
import os

from pyspark.sql import functions as F

from quillspark.operators.aggregates import max_by_key
from quillspark.operators.lines import label_mean_by_year
from quillspark.operators.messages import filter_messages, message_table
from quillspark.sinks import writers
from quillspark.sources import text


def _write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(content)


def test_header_csv_quoted_comma_and_naive_shift(spark, tmp_dir):
    header = "ID,Date,Block,Location Description,Arrest,Year"
    lines = [header,
             '1,01/02/2020 01:05:00 PM,001XX A ST,"STREET, ALLEY",true,2020',
             "2,broken,002XX B ST,HOME,false,2020",
             header]
    _write(f"{tmp_dir}/in/a.csv", "\n".join(lines) + "\n")
    df = text.read_header_csv(spark, f"{tmp_dir}/in")
    assert df.columns == header.split(",")
    rows = df.collect()
    assert rows[0]["Location Description"] == "STREET, ALLEY" and rows[0]["Year"] == "2020"
    raw = spark.read.text(f"{tmp_dir}/in")
    naive = text.naive_split(raw, "value", {"date": 1, "year": 5}, header=header).collect()
    assert len(naive) == 2                       # both header lines removed by value
    assert naive[0]["year"] == "true"            # shifted by the quoted comma
    parsed = text.parse_csv_lines(raw, "value", "ID long, Date string, Block string, Loc string, "
                                  "Arrest string, Year int", header=header).collect()
    assert [r["Year"] for r in parsed] == [2020, 2020]


def test_declared_table_header_becomes_nulls(spark, tmp_dir):
    _write(f"{tmp_dir}/r/ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.0,100\n1,11,3.0,101\n")
    df = text.read_declared_table(spark, f"{tmp_dir}/r", "userId INT, movieId INT, rating FLOAT, ts BIGINT")
    rows = df.collect()
    assert tuple(rows[0]) == (None, None, None, None) and rows[1]["rating"] == 4.0


def test_ngram_lines_edge_rows(spark, tmp_dir):
    lines = ["chinu 1999 3 10.0", "chinu 1999 1 20.0", "hawk 2000 1 5", "only three 1",
             "nut 0 1 1", "nut 2025 1 1", "nut year 1 1", "NUT 2000 1 1", "  nudge\t2000  2 7  "]
    _write(f"{tmp_dir}/ng/part.txt", "\n".join(lines) + "\n")
    out = {(r["year"], r["substring"]): r["avg_volume"]
           for r in label_mean_by_year(text.read_ngram_lines(spark, f"{tmp_dir}/ng")).collect()}
    assert out == {("1999", "nu"): 15.0, ("2000", "haw"): 5.0, ("2000", "nu"): 7.0}


def test_csv_directory_max_duration(spark, tmp_dir):
    _write(f"{tmp_dir}/songs/a.csv", 'id,title,artist,duration\n1,x,Band,200.5\n2,y, Band ,300\n3,z,"Doe, J",nan\n')
    _write(f"{tmp_dir}/songs/b.csv", '4,w,"Doe, J", 120 \n5,v,Solo\n6,u,Solo,abc\n')
    _write(f"{tmp_dir}/songs/skip.txt", "7,q,Band,999\n")
    df = text.read_csv_dir(spark, f"{tmp_dir}/songs")
    out = dict(max_by_key(text.artist_durations(df), "artist", "duration").collect())
    assert out == {"Band": 300.0, "Doe, J": 120.0}


def test_csv_directory_judges_each_line_by_its_own_fields(spark, tmp_dir):
    _write(f"{tmp_dir}/mixed/a.csv", 'only,two\nt1,x,Band,7\nt2,,Band,99\n,,Solo,5,extra,"6, 7"\n\nx,"a,b,c,d"\n')
    _write(f"{tmp_dir}/mixed/b.csv", 't3,y,,4\n"q ""w"", z",y,Duo,8\n')
    lines = text.read_csv_dir(spark, f"{tmp_dir}/mixed")
    got = sorted(map(tuple, text.artist_durations(lines).collect()))
    assert got == [("", 4.0), ("Band", 7.0), ("Band", 99.0), ("Duo", 8.0), ("Solo", 5.0)]


def test_put_order_beats_row_order(spark):
    def msg(body):
        return f"To: k@x\nDate: Fri, 7 Dec 2001 10:06:42 -0800 (PST)\nFrom: x@y\n\n{body}"
    rows = [("d/f", msg("old"), 1), ("d/f", msg("new"), 2), ("d/g", msg("one"), 5)]
    for order in (rows, rows[::-1]):
        raw = spark.createDataFrame(order, "path string, text string, put long")
        got = {r["row_key"]: r["body"] for r in message_table(raw, put_order="put").collect()}
        assert got == {"d/f": "new", "d/g": "one"}


def test_merge_keeps_files_of_a_folder_apart(spark, tmp_dir):
    for name, first in (("a", 0), ("b", 4000)):
        _write(f"{tmp_dir}/fold/{name}.txt", "".join(f"{first + i}\n" for i in range(4000)))
    _write(f"{tmp_dir}/last.txt", "9000\n9001\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        writers.merge_files(spark, [f"{tmp_dir}/fold", f"{tmp_dir}/last.txt"], f"{tmp_dir}/m1")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [str(i) for i in range(8000)] + ["9000", "9001"]
    assert _read_lines(f"{tmp_dir}/m1") == want


def test_balanced_parts_hold_lines_in_order(spark, tmp_dir):
    names = [f"n{(i * 37) % 100:02d}" for i in range(100)]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    writers.write_balanced_parts(frame, f"{tmp_dir}/bp", ["name"], 3)
    parts = [_read_lines(d) for d in sorted(glob.glob(f"{tmp_dir}/bp/part=*"))]
    assert [len(p) for p in parts] == [34, 33, 33] and sum(parts, []) == sorted(names)


def test_block_reports(spark, tmp_dir):
    rows = spark.createDataFrame([("LR", 1.5, 2), ("GBT", 2.5, None)], "model string, rmse double, n int")
    writers.write_model_report(rows, f"{tmp_dir}/blocks")
    assert _read_lines(f"{tmp_dir}/blocks") == ["Model: GBT", "rmse: 2.5", "n: None", "",
                                                "Model: LR", "rmse: 1.5", "n: 2", ""]
    for p, word in ((0.01, "is statistically"), (0.2, "is not statistically")):
        res = spark.createDataFrame([(2.5, p)], "t_stat double, p_value double")
        writers.write_test_report(res, f"{tmp_dir}/t{p}")
        lines = _read_lines(f"{tmp_dir}/t{p}")
        assert lines[:2] == ["T-statistic: 2.5", f"P-value: {p}"] and word in lines[2]


def test_message_files_parse_and_filter(spark, tmp_dir):
    _write(f"{tmp_dir}/mail/user-a/1.", "To: k..lee@mail.example\nDate: Fri, 7 Dec 2001 10:06:42 -0800 (PST)\n"
           "From: a@mail.example\n\nBody one\n\nmore")
    _write(f"{tmp_dir}/mail/user-a/2.", "To: k..lee@mail.example,\n\tb@mail.example\nDate: Mon, 31 DEC 2001 17:18:31 -0800 (PST)\n"
           "From: c@mail.example\n\nBody two")
    _write(f"{tmp_dir}/mail/other/3.", "Date: Tue, 4 Dec 2001 01:00:00 -0800 (PST)\nFrom: d@mail.example")
    raw = text.read_message_files(spark, f"{tmp_dir}/mail")
    table = {r["row_key"]: r for r in message_table(raw).collect()}
    assert table["user-a/1."]["body"] == "Body one\n\nmore"
    assert table["user-a/2."]["recipient"] == "k..lee@mail.example,b@mail.example"
    assert table["user-a/2."]["ts"] is not None
    assert table["other/3."]["recipient"] == "unknown" and table["other/3."]["body"] == ""
    hits = filter_messages(message_table(raw), recipient="k..lee@mail.example", date_substring="Dec 2001").collect()
    assert [r["row_key"] for r in hits] == ["user-a/1."]
    typed = filter_messages(message_table(raw), month="2001-12").collect()
    # 31 Dec 17:18 -0800 is 1 Jan in UTC, so the typed month filter leaves it out.
    assert len(typed) == 2


def _read_lines(path):
    out = []
    for f in sorted(glob.glob(f"{path}/part-*")):
        with open(f) as fh:
            out.extend(fh.read().splitlines())
    return out


def test_sinks_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.5), ("c", None)], "artist string, max_value double")
    writers.write_report(df, f"{tmp_dir}/rep", order=["artist"])
    assert _read_lines(f"{tmp_dir}/rep")[0] == "artist: a, max_value: 1.5"
    writers.write_sorted_tsv(df, f"{tmp_dir}/tsv", ["artist"])
    assert _read_lines(f"{tmp_dir}/tsv")[:2] == ["a\t1.5", "b\t2.0"]
    writers.write_header_csv(df, f"{tmp_dir}/csv", rename={"max_value": "predicted"})
    assert _read_lines(f"{tmp_dir}/csv")[0] == "artist,predicted"
    writers.write_top_tsv(df, f"{tmp_dir}/top", [F.desc("max_value")], 1)
    assert _read_lines(f"{tmp_dir}/top") == ["b\t2.0"]
    kv = spark.createDataFrame([("1999", "nu", 1.0)], "year string, substring string, avg double")
    writers.write_key_value_lines(kv, f"{tmp_dir}/kv", ["year", "substring"], "avg")
    assert _read_lines(f"{tmp_dir}/kv") == ["1999,nu,1.0\t"]
    writers.write_keyed_table(spark.createDataFrame([("k", 1, "x"), ("k", 2, "y")], "k string, o int, v string"),
                              f"{tmp_dir}/keyed", "k", "o")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/keyed").collect()] == [("k", 2, "y")]
    writers.save_table(spark, df, "qs_test_db", "t1", location=f"{tmp_dir}/wh")
    assert spark.table("qs_test_db.t1").count() == 3


def test_fold_report_and_merge_and_split(spark, tmp_dir):
    folds = spark.createDataFrame([(0, "2008-01", "2008-06", "2008-07", 0.4), (1, "2008-07", "2008-12", "2009-01", 0.6)],
                                  "fold int, train_start string, train_end string, test_month string, mape double")
    writers.write_fold_report(folds, f"{tmp_dir}/folds")
    lines = _read_lines(f"{tmp_dir}/folds")
    assert lines[:3] == ["Mean MAPE = 0.5", "Max MAPE = 0.6", "Min MAPE = 0.4"]
    assert lines[3] == "Training from 2008-01 to 2008-06, Testing month: 2008-07" and lines[4] == "MAPE: 0.4"
    _write(f"{tmp_dir}/m/t2.txt", "z1\nz2\n")
    _write(f"{tmp_dir}/m/t1.txt", "a1\na2\na3\n")
    writers.merge_files(spark, [f"{tmp_dir}/m/t1.txt", f"{tmp_dir}/m/t2.txt"], f"{tmp_dir}/merged")
    assert _read_lines(f"{tmp_dir}/merged") == ["a1", "a2", "a3", "z1", "z2"]
    writers.write_balanced_parts(spark.range(10).withColumnRenamed("id", "k"), f"{tmp_dir}/parts", ["k"], 4)
    sizes = [len(_read_lines(d)) for d in sorted(glob.glob(f"{tmp_dir}/parts/part=*"))]
    assert sizes == [3, 3, 2, 2]


def test_scan_latest_equals_filter_of_keyed_table(spark):
    from quillspark.operators.messages import message_condition, scan_latest
    from quillspark.sources.text import parse_messages

    def msg(to, day, body):
        return f"To: {to}\nDate: Fri, {day} Dec 2001 10:06:42 -0800 (PST)\nFrom: x@y\n\n{body}"
    rows = [("f/a", msg("k@x", 7, "old match")), ("f/a", msg("other@x", 8, "newer, no match")),
            ("f/b", msg("k@x", 3, "older")), ("f/b", msg("k@x", 9, "latest match")),
            ("f/c", msg("k@x", 5, "dup")), ("f/c", msg("k@x", 5, "dup"))]
    raw = spark.createDataFrame(rows, "path string, text string")
    cond = message_condition(recipient="k@x", date_substring="dec 2001")
    fast = sorted(tuple(r) for r in scan_latest(parse_messages(raw), cond).collect())
    slow = sorted(tuple(r) for r in filter_messages(message_table(raw), recipient="k@x",
                                                   date_substring="dec 2001").collect())
    assert fast == slow
    assert [r[0] for r in fast] == ["f/b", "f/c"]


def test_undecodable_messages_are_skipped_and_listed(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/mail/inbox")
    for k in range(6):
        body = b"To: a@x\n\nbody \xff\xfe" if k % 3 == 0 else f"To: a@x\n\nbody é {k}".encode()
        with open(f"{tmp_dir}/mail/inbox/{k}", "wb") as f:
            f.write(body)
    rows = text.parse_messages(text.read_message_files(spark, f"{tmp_dir}/mail")).collect()
    assert {r["row_key"]: r["body"] for r in rows} == {f"inbox/{k}": f"body é {k}" for k in (1, 2, 4, 5)}
    bad = text.unreadable_messages(spark, f"{tmp_dir}/mail").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in bad) == ["0", "3"] and {r["length"] for r in bad} == {16}
