"""Files that hold awkward text, large arrays, hot categories; payloads with anything behind the object."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from souk.session import clean_scratch, hand_off, scratch_path
from souk.sources import files as FI
from souk.sources.payloads import flatten_tiki, split_malformed

TEXTS = ["a\nb", "a\r\nb", "\r", "\n", "tab\there", 'say "x"', '"', "\\", "\\n", "\\\\n", "\\\\\\", "back\\\\\nslash", "  blanks  ", ",", "a,\"b\"\n,c",
         "\u2028 line \u0085", "é\\r\r", None]


def test_csv_round_trip_of_any_text(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "i int, text string, `odd.name` string")
    path = FI.write_table(df, str(tmp_path / "t.csv"), fmt="csv")
    back = FI.read_table(spark, path, schema=df.schema)
    assert [tuple(r) for r in back.orderBy("i").collect()] == [(i, t, "x") for i, t in enumerate(TEXTS)]
    lines = [x for f in glob.glob(f"{path}/part-*") for x in open(f, newline="").read().split("\n") if x]
    assert len(lines) == len(TEXTS) + len(glob.glob(f"{path}/part-*"))  # one line a record, one header a file


def test_csv_from_elsewhere_is_left_as_it_is(spark, tmp_path):
    p = tmp_path / "plain.csv"
    p.write_text('a,b\n"C:\\new","x\\\\y"\n')
    assert tuple(FI.read_table(spark, str(p)).first()) == ("C:\\new", "x\\\\y")
    assert tuple(FI.read_table(spark, str(p), escaped=True).first()) == ("C:\new", "x\\y")


def test_csv_is_split_with_line_breaks(spark, tmp_path):
    df = spark.range(20000).select(F.concat(F.col("id").cast("string"), F.lit("\nsecond line\n")).alias("t")).coalesce(1)
    path = FI.write_table(df, str(tmp_path / "b.csv"), fmt="csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        back = FI.read_table(spark, path)
        assert back.rdd.getNumPartitions() > 4
        assert sorted(r.t for r in back.collect()) == sorted(r.t for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


RECORDS = [{"name": f"n{i}", "price": i, "deep": {"x": [{"y": i}, {}], "t": "},\n  {"}, "e": None} for i in range(3000)]


@pytest.mark.parametrize("indent, newline", [(2, "\n"), (4, "\n"), (2, "\r\n"), ("\t", "\n")])
def test_an_indented_array_is_split_at_its_records(spark, tmp_path, indent, newline):
    p = tmp_path / "crawl.json"
    p.write_bytes(json.dumps(RECORDS, ensure_ascii=False, indent=indent).replace("\n", newline).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        df = FI.read_table(spark, str(p), schema="name string, price string, deep string, e string", multi_line=True)
        assert df.rdd.getNumPartitions() > 5
        got = {r.name: r for r in df.collect()}
        assert len(got) == 3000 and got["n7"].price == "7" and json.loads(got["n7"].deep) == RECORDS[7]["deep"] and got["n7"].e is None
        text = FI.read_table(spark, str(p), multi_line=True, text=True)
        assert text.columns == ["deep", "e", "name", "price"] and text.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("records", [[], [{"a": "1"}], [{"a": "1"}, {"a": "2"}]])
@pytest.mark.parametrize("indent", [None, 2])
def test_small_arrays(spark, tmp_path, records, indent):
    p = tmp_path / "x.json"
    p.write_text("\ufeff" * 0 + json.dumps(records, indent=indent) + "\n")
    df = FI.read_table(spark, str(p), schema="a string", multi_line=True)
    assert sorted(r.a for r in df.collect()) == [r["a"] for r in records]


def test_one_file_is_looked_at(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.json").write_text('{"a": 1}\n')
    assert FI._head(spark, str(tmp_path)).startswith(b'{"a"') and FI._head(spark, str(tmp_path / "none*")) == b""
    assert FI.read_table(spark, str(tmp_path), fmt="json").count() == 3


def test_files_follow_the_bytes_of_a_category(spark, tmp_path):
    """A third of the rows in one category: many files for it, one for each small category, from many tasks."""
    df = spark.range(0, 60000, 1, 16).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("cat"),
                                             F.sha2(F.col("id").cast("string"), 512).alias("body"))
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        path = FI.write_table(df, str(tmp_path / "by_cat"), partition_by=["cat"], run_ts="r1")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    n = {os.path.basename(d): len(glob.glob(f"{d}/part-*")) for d in glob.glob(f"{path}/run_ts=r1/cat=*")}
    assert n.pop("cat=hot") > 3 and len(n) == 40 and sum(n.values()) <= 60
    assert spark.read.parquet(path).count() == 60000


BODIES = {
    '{"listings":[{"id":1}]}': None, ' {"listings":[{"id":1}]}\n': None, '{}': None,
    '{"listings":[{"id":1}]} {"listings":[{"id":2}]}': "trailing_text", '{"listings":[{"id":1}]}, {"listings":[]}': "trailing_text",
    '{"listings":[{"id":1}]} x}': "trailing_text", '{"listings":[{"id":1}]}], [{"listings":[]}': "trailing_text",
    '{"listings":[{"id":1}]}]}': "trailing_text", '{"listings":[{"id":1}]} <html>': "trailing_text",
    '{"listings":[{"id":1}]}, {"_end":"0"}': "trailing_text", '{"_end":"1","listings":[]}': None,
    '{"listings":[{"id":1}': "malformed", "{'listings':[]}": "malformed", '{"a":': "malformed",
    "<html>}": "not_json", "": "not_json", "[1]": "not_json", '{"listings":"blocked"}': "not_a_list",
}


def test_a_body_is_one_object_and_nothing_else(spark):
    rows = [("Tiki", f"k{i}", 1, None, b) for i, b in enumerate(BODIES)] + [("Tiki", "null", 1, None, None)]
    landing = spark.createDataFrame(rows, "platform string, url_key string, page int, fetched_at timestamp, body string")
    good, bad = split_malformed(landing)
    want = {f"k{i}": r for i, r in enumerate(BODIES.values()) if r} | {"null": "not_json"}
    assert {r.url_key: r.reason for r in bad.collect()} == want
    assert {r.url_key for r in good.collect()} == {f"k{i}" for i, r in enumerate(BODIES.values()) if not r}
    assert sorted(r.id for r in flatten_tiki(good).collect()) == ["1", "1"]


def test_hand_offs_go_at_the_end(spark):
    path = scratch_path(spark, "x")
    df = hand_off(spark.range(3).toDF("a"), "y")
    assert df.count() == 3
    fs, p = FI._fs(spark, os.path.dirname(path))
    assert fs.exists(p)  # registered to go with the application; clean_scratch is the earlier way
    n = clean_scratch(spark)
    assert n >= 2 and not fs.exists(p)


def test_array_lines_are_one_array_a_task(spark, tmp_path):
    path = str(tmp_path / "arrays.json")
    texts = ['  {\n    "a": "%d,]"\n  }' % i for i in range(7)]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # records are held over from batch to batch
    try:
        df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        FI.array_lines(df).write.text(path)
        FI.array_lines(df.where("value is null")).write.option("compression", "gzip").text(str(tmp_path / "none.json"))
        FI.array_lines(df).write.option("compression", "gzip").text(str(tmp_path / "packed.json"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    whole = "".join(open(f).read() for f in glob.glob(f"{path}/part-*"))
    assert json.loads(whole) == [{"a": f"{i},]"} for i in range(7)]
    for name in ("arrays.json", "packed.json"):
        back = FI.read_table(spark, str(tmp_path / name), schema="a string", multi_line=True)
        assert sorted(r.a for r in back.collect()) == [f"{i},]" for i in range(7)]
    assert FI.read_table(spark, str(tmp_path / "none.json"), schema="a string", multi_line=True).count() == 0
    with pytest.raises(ValueError, match="array"):
        FI.read_table(spark, str(tmp_path / "packed.json"), schema="a string")


def test_json_lines_in_compressed_files_of_bounded_rows(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "IF(id = 3, NULL, 'x') AS t").coalesce(1)
    path = FI.write_table(df, str(tmp_path / "t.json"), fmt="json", compression="gzip", file_rows=10)
    assert len(glob.glob(f"{path}/part-*.json.gz")) == 3
    back = FI.read_table(spark, path, schema="id long, t string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_json_queries_write_little(spark, sf_small, monkeypatch):
    """The JSON a query writes is compressed."""
    import souk.plans.queries as Q
    for name in ("src_json", "src_json_array"):
        files = Q.QUERIES[name](spark, sf_small).inputFiles()
        assert files and all(f.endswith(".gz") for f in files)


def test_the_csv_query_writes_compressed_files(spark, sf_small):
    from souk.plans.queries import QUERIES
    out = QUERIES["src_csv"](spark, sf_small)
    assert out.inputFiles() and all(f.endswith(".csv.gz") for f in out.inputFiles())
    assert out.count() > 0
