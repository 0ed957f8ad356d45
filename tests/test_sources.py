"""Payload flatteners, quarantine, file round trips."""

import json
import os
import tempfile

import pytest

from souk.sources import files as FI
from souk.sources.categories import category_dim
from souk.sources.payloads import (attach_category, empty_categories, flatten_lazada, flatten_shopee,
                                   flatten_tiki, split_malformed)


def landing(spark, rows):
    return spark.createDataFrame(
        [(p, k, pg, None, b if isinstance(b, str) else json.dumps(b)) for p, k, pg, b in rows],
        "platform string, url_key string, page int, fetched_at timestamp, body string")


def test_tiki_payload_cases(spark):
    body1 = {"listings": [], "data": [
        {"id": 1, "name": "A", "price": 10, "list_price": 0, "original_price": 12,
         "quantity_sold": {"value": 3, "text": "Đã bán 3"}, "brand": None,
         "badges": [{"text": "Freeship"}, {"text": None}, {"text": ""}], "url_path": "/a"},
        None,
        {"id": 2, "name": "B"}]}
    body2 = {"listings": [{"id": 3, "brand": {"name": "X"}, "current_seller": {"name": "S"}}]}
    rows = flatten_tiki(landing(spark, [("Tiki", "nha-sach-tiki", 1, body1), ("Tiki", "unknown", 2, body2)]))
    rows = attach_category(rows, category_dim(spark)).orderBy("id").collect()
    assert [r.id for r in rows] == ["1", "2", "3"]
    a, b, c = rows
    assert (a.original_price, a.badges, a.brand, a.url, a.quantity_sold_value) == ("12", "Freeship", None,
                                                                                    "https://tiki.vn/a", "3")
    assert (b.url, b.badges, b.quantity_sold_value) == ("https://tiki.vn", "", None)
    assert a.category_name == "Nhà Sách Tiki" and c.category_name is None
    assert (c.brand, c.seller_name) == ("X", "S")


def test_lazada_payload(spark):
    body = {"mods": {"listItems": [
        {"itemId": "9", "priceShow": "", "price": "100", "itemSoldCntShow": " 1.2k sold ", "itemUrl": "/p/9"},
        {"itemId": "8", "priceShow": "₫90", "itemSoldCntShow": None, "itemUrl": ""}]}}
    empty = {"mods": {"listItems": []}}
    out = flatten_lazada(landing(spark, [("Lazada", "laptop", 1, body), ("Lazada", "laptop", 2, empty)]))
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 2
    assert (rows["9"].price, rows["9"].sold_value, rows["9"].sold_text, rows["9"].url) == (
        "100", 1000, "1.2k sold", "https://www.lazada.vn/p/9")
    assert (rows["8"].price, rows["8"].sold_value, rows["8"].url) == ("₫90", None, None)


def test_shopee_shapes(spark):
    items = [{"item_basic": {"itemid": 1, "shopid": 2, "price": 12345600000, "item_rating": {"rating_star": 4.97},
                             "image": "abc"}},
             {"itemid": 0, "item_id": 3, "shopid": 4, "name": "flat"},
             {"itemid": 5},
             {"item_basic": {"itemid": 0, "shopid": 4}},
             {"itemid": 1, "shopid": 9}]
    out = flatten_shopee(landing(spark, [("Shopee", "k", 1, {"items": items[:3]}),
                                         ("Shopee", "k", 2, {"data": {"items": items[3:]}})]))
    rows = out.orderBy("page", "item_pos").collect()
    assert [(r.itemid, r.shopid) for r in rows] == [("1", "2"), ("3", "4"), ("1", "9")]
    r0 = rows[0]
    assert (r0.price, r0.rating_star, r0.name, r0.image, r0.url) == (
        123456.0, 4.9, "N/A", "https://down-vn.img.susercontent.com/file/abc", "https://shopee.vn/product/2/1")
    assert (rows[1].rating_star, rows[1].image, rows[1].location) == (0.0, "", "N/A")


def test_quarantine(spark):
    df = landing(spark, [("Lazada", "a", 1, "<html>blocked</html>"), ("Lazada", "a", 2, '{"mods": {'),
                         ("Lazada", "a", 3, "  {\"mods\": {\"listItems\": []}}"), ("Lazada", "a", 4, None)])
    good, bad = split_malformed(df)
    assert good.count() == 1
    assert sorted((r.page, r.reason) for r in bad.collect()) == [(1, "not_json"), (2, "malformed"), (4, "not_json")]


def test_odd_elements_cost_only_themselves(spark):
    rows = landing(spark, [
        ("Tiki", "k", 1, {"listings": [{"id": 1}, "junk", None, {}, 7, [], {"id": 2, "quantity_sold": 5, "price": 1.5}]}),
        ("Lazada", "k", 1, {"mods": {"listItems": ["junk", {"itemId": 3}, None]}}),
        ("Shopee", "k", 1, {"items": ["junk", {"itemid": 4, "shopid": 1, "price": 100000.5, "historical_sold": "12",
                                               "item_rating": {"rating_star": "4.97"}}]})])
    good, bad = split_malformed(rows)
    assert bad.count() == 0
    assert [(r.id, r.price, r.quantity_sold_value, r.item_pos) for r in flatten_tiki(good).orderBy("id").collect()] == [
        ("1", None, None, 0), ("2", "1.5", None, 1)]
    assert [r.id for r in flatten_lazada(good).collect()] == ["3"]
    s = flatten_shopee(good).first()
    assert (s.itemid, s.price, s.historical_sold, s.rating_star) == ("4", 1.0, 12, 4.9)


def test_wrong_shapes_are_quarantined(spark):
    bodies = [("Tiki", {"listings": "blocked"}), ("Tiki", {"listings": {"id": 1}}), ("Tiki", {"listings": None, "data": 5}),
              ("Lazada", {"mods": {"listItems": {"a": 1}}}), ("Lazada", {"mods": "blocked"}), ("Shopee", {"items": {"a": 1}}),
              ("Shopee", {"data": {"items": "x"}}), ("Tiki", '{"listings":[{"id":1}]} <html>'),
              ("Tiki", {"listings": [], "data": []}), ("Tiki", {"listings": 0}), ("Lazada", {}), ("Shopee", {"data": "x"})]
    good, bad = split_malformed(landing(spark, [(p, "k", i, b) for i, (p, b) in enumerate(bodies)]))
    assert sorted((r.page, r.reason) for r in bad.collect()) == [(i, "not_a_list") for i in range(7)] + [(7, "trailing_text")]
    assert good.count() == 4


def test_empty_categories(spark):
    dim = category_dim(spark)
    rows = spark.createDataFrame([("Tiki", "nha-sach-tiki")], "platform string, url_key string")
    assert empty_categories(dim, rows).count() == dim.count() - 1 == 43


def test_read_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        FI.read_table(spark, "/nonexistent/souk/x.csv")
    with pytest.raises(ValueError):
        FI.detect_format("data.xlsx")


def test_csv_round_trip_keeps_blanks_and_na(spark):
    d = tempfile.mkdtemp(prefix="souk-test-")
    df = spark.createDataFrame([(" 16% ", "N/A", 'a "q", b'), ("x\ny", None, "")], "a string, b string, c string")
    p = FI.write_table(df, os.path.join(d, "t.csv"), fmt="csv")
    back = sorted(FI.read_table(spark, p, schema=df.schema, multi_line=True).collect(), key=lambda r: r.a)
    assert [tuple(r) for r in back] == [(" 16% ", None, 'a "q", b'), ("x\ny", None, None)]


def test_json_array_file(spark):
    d = tempfile.mkdtemp(prefix="souk-test-")
    p = os.path.join(d, "x.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump([{"name": "Á", "price": "1"}, {"name": "B", "price": None}], f, ensure_ascii=False)
    df = FI.read_table(spark, p, schema="name string, price string", multi_line=True)
    assert sorted(tuple(r) for r in df.collect()) == [("B", None), ("Á", "1")]


    with pytest.raises(ValueError, match="array"):
        FI.read_table(spark, p, schema="name string, price string")


def test_csv_is_split(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_text("a,b\n" + "".join(f"{i},{'x' * 50}\n" for i in range(40000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = FI.read_table(spark, str(p))
        assert df.rdd.getNumPartitions() > 1 and df.count() == 40000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_with_bom_header(spark):
    d = tempfile.mkdtemp(prefix="souk-test-")
    p = os.path.join(d, "bom.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("name,price\nÁo,\"1,234\"\nB,N/A\n")
    df = FI.read_table(spark, p)
    assert df.columns == ["name", "price"]
    assert sorted(tuple(r) for r in df.collect()) == [("B", None), ("Áo", "1,234")]


def test_default_output_path():
    assert FI.default_output_path("data/lazada_all.csv") == "data/lazada_all_cleaned.csv"
    assert FI.default_output_path("x/merged.json") == "x/merged_cleaned.csv"
    assert FI.default_output_path("x/merged.jsonl") == "x/merged_cleaned.csv"
    assert FI.default_output_path("in.json/x.parquet/") == "in.json/x_cleaned.csv"
    with pytest.raises(ValueError):
        FI.default_output_path("x.xlsx")


def test_output_never_overwrites_input():
    for a, b in (("d/in.parquet", "d/in.parquet/"), ("d/in.parquet", "d"), ("d/in", "d/in/out"), ("/a/b", "/a/x/../b")):
        with pytest.raises(ValueError):
            FI.refuse_overwrite(a, b)
    FI.refuse_overwrite("d/in.parquet", "d/in_cleaned.csv")


def _listing(i, **kw):
    return {"name": f"p{i}", "price": f"{100 + i},000đ", "discount": f"{i % 4}0%", "rating": "4.5", "review_count": str(i),
            "sold_text": f"{i} sold", "sold_value": str(i * 3), "url": f"//www.lazada.vn/p/{i % 7}", "platform": "Lazada",
            "crawl_date": "2024-05-01"} | kw


def test_cli_clean_keeps_a_parquet_input(spark, tmp_path):
    from souk.__main__ import main
    src = tmp_path / "in.parquet"
    spark.createDataFrame([_listing(i) for i in range(20)]).write.parquet(str(src))
    assert main(["clean", str(src), "--run-ts", "2024-05-02 00:00:00"]) == 0
    assert spark.read.parquet(str(src)).count() == 20
    assert FI.read_table(spark, str(tmp_path / "in_cleaned.csv")).count() == 7
    with pytest.raises(ValueError):
        main(["clean", str(src), str(src)])


def test_cli_first_file_wins_whatever_its_size(spark, tmp_path):
    from souk.__main__ import main
    src = tmp_path / "crawl.jsonl"
    src.mkdir()
    (src / "a.jsonl").write_text(json.dumps(_listing(1, name="first")) + "\n")
    (src / "b.jsonl").write_text("".join(json.dumps(_listing(1 + 7 * i, name="second" + "x" * 500)) + "\n" for i in range(200)))
    assert main(["clean", str(src), "--run-ts", "2024-05-02 00:00:00"]) == 0
    rows = FI.read_table(spark, str(tmp_path / "crawl_cleaned.csv")).collect()
    assert [r.product_name for r in rows] == ["first"]


def test_cli_ingest_and_run(spark, tmp_path):
    from souk.__main__ import main
    src = tmp_path / "landing.json"
    pages = [{"platform": "Tiki", "url_key": "nha-sach-tiki", "page": i, "fetched_at": f"2024-05-01T00:0{i}:00",
              "body": json.dumps({"listings": [{"id": i * 10 + k, "name": f"n{k}", "price": 10 * k, "url_path": f"/{i}-{k}"} for k in range(5)]})}
             for i in range(3)]
    src.write_text("".join(json.dumps(p) + "\n" for p in pages))
    for ts in ("2024-05-02 00:00:00", "2024-05-02 01:00:00"):
        assert main(["ingest", str(src), str(tmp_path / "rows"), "--stamped", "--run-ts", ts]) == 0
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert {(r["run_ts"], r["count"]) for r in rows.groupBy("run_ts").count().collect()} == {("2024-05-02_00-00", 15), ("2024-05-02_01-00", 15)}
    assert main(["run", str(src), str(tmp_path / "all"), "--run-ts", "2024-05-02 00:00:00"]) == 0
    assert spark.read.parquet(str(tmp_path / "all" / "labeled")).count() == 15
    for name in ("price_outliers", "rating_outliers", "avg_sold_ci", "price_kde"):
        assert (tmp_path / "all" / name).exists()


def test_session_is_the_submitted_one(tmp_path):
    import subprocess
    import sys
    code = ("from souk.session import submitted_session as s; c = s(); "
            "print([c.sparkContext.master, c.conf.get('spark.sql.shuffle.partitions'), c.conf.get('spark.sql.session.timeZone'), "
            "c.sparkContext._jvm.System.getProperty('x')])")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=500 --conf spark.ui.enabled=false "
                        "--conf spark.driver.extraJavaOptions=-Dx=1 pyspark-shell", "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "['local[2]', '500', 'UTC', '1']", out.stderr[-500:]


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from souk.session import ensure_checkpoint_dir

    def get(_):
        raise KeyError
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=get)))


def test_scratch_is_removed(spark, tmp_path):
    from souk.session import clean_scratch, hand_off
    df = hand_off(spark.range(3), "t")
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path) and clean_scratch(spark) >= 1 and not os.path.exists(path)


def test_cli_clean_features_label_report(spark, tmp_path):
    from souk.__main__ import main
    src = tmp_path / "crawl.json"
    rows = [{"name": f"p{i}", "price": f"{100 + i},000đ", "discount": f"{i % 4}0%", "rating": "4.5",
             "review_count": str(i), "sold_text": f"{i} sold", "sold_value": str(i * 3),
             "url": f"//www.lazada.vn/p/{i % 7}", "platform": "Lazada", "crawl_date": "2024-05-01"}
            for i in range(30)]
    src.write_text(json.dumps(rows, ensure_ascii=False))
    out = tmp_path / "clean.csv"
    assert main(["clean", str(src), str(out), "--multi-line", "--run-ts", "2024-05-02 00:00:00"]) == 0
    cleaned = FI.read_table(spark, str(out))
    assert cleaned.count() == 7  # seven distinct links, first occurrence kept
    assert main(["features", str(out), str(tmp_path / "f.parquet")]) == 0
    assert main(["label", str(tmp_path / "f.parquet"), str(tmp_path / "l.parquet")]) == 0
    assert main(["report", str(tmp_path / "l.parquet"), str(tmp_path / "rep")]) == 0
    assert (tmp_path / "rep" / "label_distribution").exists()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_parsed_once(spark, sf_small):
    """A filter on what was parsed does not parse again: each step's from_json stands in the plan once (the reason's twice)."""
    from souk.plans.ingest import ingest
    from souk.sources.fixture import landing_from_tables
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    try:
        parts = ingest(landing_from_tables(spark, sf_small), category_dim(spark))
        plans = {k: _optimized(parts[k]) for k in ("tiki", "lazada", "shopee")}
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for p in plans.values():
        assert 0 < p.count("from_json") + p.count("jsontostructs") <= 8
        assert p.count("Relation [l_orderkey") == 1  # the lineitems are read once a platform


def test_stream_slices_share_their_pages(spark, sf_small):
    from souk.plans.queries import _stream_slices
    for part in _stream_slices(spark, sf_small):
        assert "Aggregate" not in _optimized(part)
