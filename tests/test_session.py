import pytest

import __spark_entry__ as entry
from souk import session as S


@pytest.mark.parametrize("key", ["fill_defaults", "src_csv", "dedup_id"])
def test_listing_queries_leave_nothing_to_the_interpreter(spark, sf_small, monkeypatch, key):
    """Without the JVM option, fused methods above HotSpot's limit are given up; the rows stay the same."""
    want = entry.queries()[key](spark, sf_small)
    assert spark.conf.get(S.METHOD_LIMIT) == "65535"  # the test session's JVM compiles them
    monkeypatch.setattr(S, "JIT_OPTION", "-XX:-NotGiven")
    other = spark.newSession()
    got = entry.queries()[key](other, sf_small)
    assert other.conf.get(S.METHOD_LIMIT) == S.HOTSPOT_LIMIT
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(got) == rows(want)


def test_a_limit_that_is_set_stays(spark, monkeypatch):
    monkeypatch.setattr(S, "JIT_OPTION", "-XX:-NotGiven")
    other = spark.newSession()
    other.conf.set(S.METHOD_LIMIT, "4000")
    S.fit_codegen(other)
    assert other.conf.get(S.METHOD_LIMIT) == "4000"


def test_listing_queries_start_with_enough_shuffle_partitions(spark, sf_small):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "8")
    entry.queries()["dedup_first"](other, sf_small)
    assert other.conf.get(S.INITIAL_PARTITIONS) == "200"
    for key, value in (("spark.sql.shuffle.partitions", "500"), (S.INITIAL_PARTITIONS, "30")):
        other = spark.newSession()
        other.conf.set(key, value)
        S.fit_shuffles(other)
        assert other.conf.get(S.INITIAL_PARTITIONS, None) == ("30" if value == "30" else None)
