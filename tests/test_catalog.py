import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from notecode.sources.catalog import Catalog, decode_result, find_file, list_files, serialize

SCHEMAS = {"a": "id string, n int, at timestamp", "b": "id string, n int, at timestamp"}


@pytest.fixture
def catalog(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/c", SCHEMAS)
    assert c.bootstrap() == ["a", "b"] and c.bootstrap() == []
    return c


def content(catalog, name="a"):
    return sorted((r.id, r.n) for r in catalog.table(name).collect())


def test_writes(spark, catalog):
    rows = spark.createDataFrame([("x", 1, "extra"), ("y", None, "extra")], "id string, n int, other string")
    catalog.append("a", rows)
    catalog.append("a", rows.where("id = 'x'"))
    assert content(catalog) == [("x", 1), ("x", 1), ("y", None)]
    catalog.overwrite("a", catalog.table("a").distinct())  # from itself
    assert content(catalog) == [("x", 1), ("y", None)]
    catalog.insert_union("a", spark.createDataFrame([("p", 7)], "k string, v int"), spark.createDataFrame([("q", 8)], "z string, w int"))
    catalog.update_where("a", F.col("n") > 7, {"n": F.lit(0)})
    source = spark.createDataFrame([("y", 5), ("y", 5), ("none", 5)], "id string, m int")
    catalog.merge_update("a", source, "id", {"n": F.coalesce("t.n", "s.m")})
    assert content(catalog) == [("p", 7), ("q", 0), ("x", 1), ("y", 5)]
    catalog.insert_values("b", id_column="id", at_column="at", n=3)
    row = catalog.table("b").head()
    assert len(row.id) == 36 and row.n == 3 and row.at is not None


def test_reads(spark, catalog):
    assert catalog.first_of(["nothing", "a"]) is None
    catalog.append("b", spark.createDataFrame([("it's", 2), ("o", 3)], "id string, n int"))
    assert catalog.first_of(["nothing", "a", "b"]).count() == 2
    assert catalog.sql("select n from {b} where id = :who", {"who": "it's"}).head().n == 2
    catalog.create_view("big", "select * from {b} where n > 2")
    assert [r.id for r in catalog.table("big").collect()] == ["o"]
    later = Catalog(spark, catalog.root, SCHEMAS)
    later.open_views(["big"])
    assert later.sql("select count(*) as k from {big}").head().k == 1
    with pytest.raises(ValueError):
        catalog.table("nothing")


def test_files(spark, tmp_path):
    for name in ("x.csv", "Y.JSON", "a_Relationship_1.txt", "b_Relationship_2.txt", "note.md"):
        (tmp_path / name).write_text("")
    found = list_files(spark, f"file://{tmp_path}", (".csv", ".json"))
    assert {k: len(v) for k, v in found.items()} == {".csv": 1, ".json": 1}
    assert find_file(spark, f"file://{tmp_path}", "relationship").endswith("b_Relationship_2.txt")
    assert find_file(spark, f"file://{tmp_path}", "description") is None
    assert list_files(spark, f"file://{tmp_path}/gone", (".csv",)) == {".csv": []}


def test_plain_values(spark):
    row = spark.createDataFrame([(decimal.Decimal("1.5"), datetime.date(2025, 1, 2), datetime.datetime(2025, 1, 2, 3), None)], "a decimal(4,2), b date, c timestamp, d string").head()
    assert serialize(row) == {"a": 1.5, "b": "2025-01-02", "c": "2025-01-02T03:00:00", "d": None}
    assert decode_result([("n", "BIGINT"), ("x", "DECIMAL(4,2)"), ("b", "BOOLEAN"), ("s", "STRING")], [["1", "2.5", "t", "u"], [None, None, "false", None]]) == [{"n": 1, "x": 2.5, "b": True, "s": "u"}, {"n": None, "x": None, "b": False, "s": None}]
