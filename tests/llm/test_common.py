"""Helpers that operators share."""

from wordloom.llm import common


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([("a", 1, 2, "x"), (None, 3, 4, "y")], "text STRING, `a.b` INT, Text_Length INT, `c d` STRING")
    out = common.add_columns(df, ["TEXT", "a.b"], "text_length BIGINT, twice BIGINT", lambda: lambda t, n: ([len(x or "") for x in t], [2 * x for x in n]))
    assert out.columns == ["text", "a.b", "c d", "text_length", "twice"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 1, "x", 1, 2), (None, 3, "y", 0, 6)], key=str)


def test_dropped_and_replaced_inputs(spark):
    df = spark.createDataFrame([("ab", 5)], "text STRING, n INT")
    out = common.add_columns(df, ["text", "n", "text"], "n BIGINT", lambda: lambda t, n, again: [[len(t[0] + again[0]) + n[0]]], drop=["text"])
    assert out.columns == ["n"] and out.first().n == 9


def test_worker_caches_go_with_their_operator(monkeypatch):
    monkeypatch.setattr(common, "_owner", "")
    monkeypatch.setattr(common, "_cleaners", {})
    dropped = []
    common.worker_cache("one", lambda: dropped.append("one"))
    common.worker_cache("one", lambda: dropped.append("one"))
    assert dropped == []
    common.worker_cache("two", lambda: dropped.append("two"))
    assert dropped == ["one"]


def test_pieces():
    assert list(common.pieces(b"aa bb cc", 3)) == [b"aa bb", b" cc"]
    assert list(common.pieces(b"aaaa", 2)) == [b"aaaa"] and list(common.pieces(b"")) == [b""]
