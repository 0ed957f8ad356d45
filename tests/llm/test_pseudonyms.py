import datetime
import re

from pyspark.sql import functions as F

from souk.llm import pseudonyms as P

VALUES = ["4041894974608795", "4041-8949-7460-8795", "+1 (988) 555-2485", "988-555-2485", "+33 6 12 34 56 78", "152.143.123.131", "2024-02-29", "29.02.2024",
          "31/12/1999", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "Some.One+x9@mail8.example.com"]
INVALID = ["4041894974608796", "300.1.1.1", "2023-02-29", "000-12-3456", "666-12-3456", "GB00 WEST 1234 5698 7654 32", "1.2.3.4.5", "12345", "123-456-789", "(188) 555-2485"]


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def masked(spark, texts, **kw):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["masked"] for r in P.pseudonymise(d, **kw).orderBy("row.doc_id").collect()]


def shape(s):
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s)))


def test_format_validity_and_round_trip(spark):
    out = masked(spark, VALUES)
    assert masked(spark, out, inverse=True) == VALUES
    for a, b in zip(VALUES, out, strict=True):
        assert a != b
        if a != "152.143.123.131":
            assert shape(a) == shape(b)
    assert luhn(out[0]) and luhn(out[1]) and out[0] == out[1].replace("-", "")
    assert out[2].endswith(out[3][4:]) and out[2][4:7] == out[3][:3]
    assert all(int(x) < 256 for x in out[5].split("."))
    assert datetime.date.fromisoformat(out[6]) == datetime.datetime.strptime(out[7], "%d.%m.%Y").date()
    assert mod97(out[10]) == mod97(out[11]) == 1
    assert masked(spark, VALUES, key="other") != out


def test_what_fails_its_check_stays(spark):
    assert masked(spark, INVALID) == INVALID


def test_linked_across_documents_and_defined_cases(spark):
    long = "word " * 100_000 + VALUES[0]
    texts = [None, "", "nothing here", f"a {VALUES[0]} b {VALUES[5]}.", f"({VALUES[0]})", long, f"{VALUES[0]}{VALUES[0]}", "@ 1 @2"]
    out = masked(spark, texts)
    assert out[:3] == texts[:3] and out[6:] == texts[6:]
    one = masked(spark, [VALUES[0]])[0]
    assert one in out[3] and out[4] == f"({one})" and out[5] == "word " * 100_000 + one
    assert VALUES[5] not in out[3]


def test_what_follows_a_value_does_not_hide_it(spark):
    card, iban, phone, date = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332", "+33 6 12 34 56 78", "12.05.2024"
    c, plain, i, p, d = masked(spark, [card, "4111111111111111", iban, phone, date])
    assert c != card and i != iban and p != phone
    texts = [f"{card} 12/27", "4111111111111111 2 items", f"{iban} THE", f"{phone} 12 items", f"4111111111111111 {date}",
             f"\ufdd0 {card} 12/27 {iban} THE\ufdd0\ufdd2", f"{phone} 99 and {phone}"]
    assert masked(spark, texts) == [f"{c} 12/27", f"{plain} 2 items", f"{i} THE", f"{p} 12 items", f"{plain} {d}",
                                    f"\ufdd0 {c} 12/27 {i} THE\ufdd0\ufdd2", f"{p} 99 and {p}"]


def test_feistel_is_a_permutation(spark):
    for sizes in ([7], [5, 3], [4, 3, 6]):
        d = spark.range(1).select(F.array().cast("array<int>").alias("v"))
        for n in sizes:
            d = d.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("x"), "v").select(F.concat("v", F.array(F.col("x").cast("int"))).alias("v"))
        r = F.array(*[F.lit(n) for n in sizes])
        out = d.select("v", P.feistel(F.col("v"), r, "k", "t").alias("w")).withColumn("back", P.feistel(F.col("w"), r, "k", "t", inverse=True)).collect()
        assert len({tuple(x["w"]) for x in out}) == len(out) and all(x["v"] == x["back"] for x in out)
        assert all(0 <= c < n for x in out for c, n in zip(x["w"], sizes, strict=True))


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string, masked int")
    assert P.pseudonymise(d).count() == 0


def test_the_key_is_the_callers(spark):
    """An argument, else the session's setting, else one drawn once a session: nothing in the source undoes a mapping."""
    before = spark.conf.get(P.KEY_CONF, None)
    try:
        spark.conf.unset(P.KEY_CONF)
        drawn = masked(spark, VALUES)
        assert masked(spark, VALUES) == drawn and len(spark.conf.get(P.KEY_CONF)) == 64
        spark.conf.set(P.KEY_CONF, "one")
        assert masked(spark, VALUES) == masked(spark, VALUES, key="one") != drawn
        spark.conf.unset(P.KEY_CONF)
        assert P.session_key(spark) != P.session_key(spark.newSession())
    finally:
        spark.conf.unset(P.KEY_CONF)
        if before:
            spark.conf.set(P.KEY_CONF, before)
