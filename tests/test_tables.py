"""Functions as spark.sql sees them."""

import pytest

from quire.functions import edit, tables, text


@pytest.fixture(scope="module")
def sql(spark):
    text.register(spark)
    tables.register(spark)
    rows = [(1, "first line here\nsecond one there\n\nthird is last", "third is last\nfirst line hera\nsecond one there"), (2, "a\nb", ""), (3, None, "x"), (4, "same", "same")]
    spark.createDataFrame(rows, "id int, ref string, pred string").createOrReplaceTempView("pages")
    return spark.sql


def test_line_pairs(sql):
    got = {(r["id"], r["ref_line"], r["pred_line"]): r for r in sql("SELECT id, t.* FROM pages, LATERAL line_pairs(ref, pred) t").collect()}
    assert sorted(got) == [(1, 0, 1), (1, 1, 2), (1, 2, 0), (4, 0, 0)]
    assert got[1, 0, 1]["pred_text"] == "first line hera" and got[1, 0, 1]["similarity"] == pytest.approx(1 - 1 / 15)
    assert sql("SELECT id FROM pages, LATERAL line_pairs(ref, pred, 0.99D) t WHERE id = 1").count() == 2


def test_order_metrics(sql):
    got = {r["id"]: tuple(r)[1:] for r in sql("SELECT id, t.* FROM pages, LATERAL order_metrics(ref, pred) t").collect()}
    ref, pred = "first line here\nsecond one there\n\nthird is last", "third is last\nfirst line hera\nsecond one there"
    keys = [[text.skeleton_of(x) for x in t.split("\n") if x.strip()] for t in (ref, pred)]
    assert got[1] == tuple(edit.line_order(ref, pred, *keys, 0.5)) and got[2] == (3, 0, 0, 0, 2, 0) and set(got) == {1, 2, 4}


def test_arguments_are_checked(sql):
    for call in ("line_pairs(1, 'a')", "line_pairs('a')", "order_metrics('a', 'b', 2.0D)", "line_pairs('a', 'b', NULL)"):
        with pytest.raises(Exception, match="least similarity"):
            sql(f"SELECT * FROM {call}").collect()


def test_levels_by_name(sql):
    assert sql("SELECT diacritic_insensitive('كَتَب') AS x").first()["x"] == "كتب"
