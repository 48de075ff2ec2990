"""Table operators on the small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from fixtures import PATHS, PLANT_ROWS, PLANTS, PRICES, rows
from millrace.functions.jsons import json_values
from millrace.functions.scalars import concat, to_bigint, to_text
from millrace.operators import columns, joins
from millrace.operators.aggregates import group_count_max, group_count_sum, top_per_group
from millrace.operators.changelog import changelog_aggregate
from millrace.operators.rows import distinct_rows, filter_not_equal, limit_rows
from millrace.operators.userdefined import CountSum, Largest, aggregate
from millrace.operators.userfunctions import map_rows
from millrace.plans.inspect import explain, explain_sql, print_schema, schema_lines, sql_query
from millrace.sources.memory import from_collection, from_elements


@pytest.fixture
def raw(spark):
    return from_elements(spark, PLANTS, ["id", "data"])


@pytest.fixture
def plants(raw):
    return columns.drop_columns(columns.add_columns(raw, json_values(F.col("data"), PATHS)), "data")


def test_add_and_drop_columns(plants):
    assert rows(plants) == PLANT_ROWS
    assert plants.dtypes == [("id", "bigint"), ("species", "string"), ("height", "string"), ("country", "string")]


def test_limit(plants):
    assert rows(limit_rows(plants, 2, "id")) == PLANT_ROWS[:2]
    assert limit_rows(plants, 2).count() == 2


def test_filter(plants):
    assert rows(filter_not_equal(plants, "id", 5)) == [r for r in PLANT_ROWS if r[0] != 5]


def test_filter_drops_null(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "id BIGINT")
    assert rows(filter_not_equal(df, "id", 3)) == [(1,)]


def test_group_count_max(plants):
    out = group_count_max(plants, ["country"], "id", to_bigint(F.col("height")), "n", "most")
    assert rows(out) == [("Kenya", 1, 80), ("Norway", 1, 30), ("Peru", 3, 210)]


def test_changelog(plants):
    df = plants.withColumn("height", to_bigint(F.col("height")))
    log = changelog_aggregate(df, ["country"], "id", {"n": ("count", "id"), "most": ("max", "height")})
    assert rows(log) == sorted([
        ("Norway", 1, "+I", 1, 30), ("Kenya", 7, "+I", 1, 80), ("Peru", 3, "+I", 1, 45),
        ("Peru", 5, "-U", 1, 45), ("Peru", 5, "+U", 2, 45), ("Peru", 9, "-U", 2, 45), ("Peru", 9, "+U", 3, 210),
    ], key=str)


def test_changelog_is_silent_when_nothing_changes(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 3, 9)], "k STRING, i BIGINT, v BIGINT")
    log = changelog_aggregate(df, ["k"], "i", {"most": ("max", "v")})
    assert rows(log) == [("a", 1, "+I", 5), ("a", 3, "+U", 9), ("a", 3, "-U", 5)]


def test_distinct(plants):
    assert rows(distinct_rows(plants, "country")) == [("Kenya",), ("Norway",), ("Peru",)]


def test_join(spark, plants):
    prices = columns.rename_columns(from_elements(spark, PRICES, ["id", "price"]), {"id": "r_id"})
    joined = joins.join_inner(plants, prices, [("id", "r_id")])
    assert [(r.id, r.r_id, r.price) for r in joined.orderBy("id").collect()] == [(1, 1, 4.5), (5, 5, 12.0), (9, 9, 30.0)]
    assert joined.columns == ["id", "species", "height", "country", "r_id", "price"]


def test_join_refuses_equal_names(spark, plants):
    with pytest.raises(ValueError, match="id"):
        joins.join_inner(plants, from_elements(spark, PRICES, ["id", "price"]), [("id", "id")])


SPLIT = [(1, "sedge"), (1, "blue"), (3, "fern"), (5, "lily"), (5, "white"), (7, "rose"), (7, "tea"), (7, "red"),
         (9, "agave"), (9, "")]


def test_lateral_split(plants):
    out = joins.lateral_split(plants, "species", "-", "a")
    assert rows(out.select("id", "a")) == sorted(SPLIT, key=str)
    assert out.columns == ["id", "species", "height", "country", "a"]


def test_lateral_python_function(plants):
    split = joins.table_function(lambda text: [(part,) for part in text.split("-")], "a STRING")
    out = joins.join_lateral(plants, split, "species")
    assert rows(out.select("id", "a")) == sorted(SPLIT, key=str)


def test_lateral_without_rows_drops_the_row(plants):
    none_for_fern = joins.table_function(lambda n: iter([] if n == "fern" else [(n,)]), "a STRING")
    assert sorted(r.id for r in joins.join_lateral(plants, none_for_fern, "species").collect()) == [1, 5, 7, 9]


@pytest.mark.parametrize("separator", ["i", ".", "|", "a+", "\\"])
def test_split_is_literal(spark, separator):
    texts = ["a.b", "x|y||", "a+a+", "\\", "", "none", f"{separator}x{separator}"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = rows(joins.lateral_split(df, "t", separator, "p"))
    assert got == sorted(((t, p) for t in texts for p in t.split(separator)), key=str)


def test_sql_lateral(spark, raw):
    def flat_plant(data):
        plant = json.loads(data)
        return [(plant["species"], plant["height"], plant["origin"]["country"])]

    joins.register_table_function(spark, "flat_plant", flat_plant, "species STRING, height INT, country STRING")
    out = sql_query(spark, "SELECT * FROM {t} AS p, LATERAL flat_plant(p.data) AS x(species, height, country)", t=raw)
    assert rows(out.drop("data")) == [(i, n, int(h), c) for i, n, h, c in PLANT_ROWS]
    assert dict(out.dtypes)["height"] == "int"


def test_rename_keeps_position(plants):
    out = columns.rename_columns(plants, {"height": "cm"})
    assert out.columns == ["id", "species", "cm", "country"]
    assert rows(out) == PLANT_ROWS


def test_replace_keeps_position(plants):
    out = columns.add_or_replace_columns(plants, {"id": concat(F.col("species"), F.lit("#"), to_text(F.col("id")))})
    assert sorted(r.id for r in out.collect()) == ["agave-#9", "fern#3", "lily-white#5", "rose-tea-red#7", "sedge-blue#1"]
    assert out.dtypes[0] == ("id", "string")


def test_column_checks(plants):
    with pytest.raises(ValueError):
        columns.add_columns(plants, {"SPECIES": F.lit(1)})
    with pytest.raises(ValueError):
        columns.drop_columns(plants, "data")
    with pytest.raises(ValueError):
        columns.rename_columns(plants, {"width": "cm"})
    with pytest.raises(ValueError):
        columns.rename_columns(plants, {"height": "species"})


def test_swap_names(plants):
    swapped = columns.rename_columns(plants, {"height": "species", "species": "height"})
    assert swapped.columns == ["id", "height", "species", "country"]


def test_concat_with_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x STRING, y STRING")
    assert rows(df.select(concat(F.col("x"), F.lit("_"), F.col("y")))) == [("a_b",), (None,)]


def test_map(raw):
    def tall(row):
        return row["id"], json.loads(row["data"])["height"] >= 80

    assert rows(map_rows(raw, tall, ["id", "data"], "id BIGINT, tall BOOLEAN")) == [
        (1, False), (3, False), (5, False), (7, True), (9, True)]


def test_flat_map(raw):
    def beds(key, data):
        bed = json.loads(data)["origin"]["bed"]
        return [(key, bed)] * (2 if bed == "pond" else bed != "shade")

    out = joins.flat_map(raw, joins.table_function(beds, "id BIGINT, bed STRING"), "id", "data")
    assert out.columns == ["f0", "f1"]
    assert rows(out) == [(1, "pond"), (1, "pond"), (5, "pond"), (5, "pond"), (7, "north"), (9, "south")]


def test_count_sum(plants):
    want = [("Kenya", 1, 80), ("Norway", 1, 30), ("Peru", 3, 300)]
    assert rows(group_count_sum(plants, ["country"], to_bigint(F.col("height")))) == want
    assert rows(aggregate(plants, ["country"], CountSum("height"), ["height"])) == want


def test_top2(plants):
    want = [("Kenya", 80), ("Norway", 30), ("Peru", 210), ("Peru", 45)]
    numbered = plants.withColumn("height", to_bigint(F.col("height")))
    assert rows(top_per_group(numbered, ["country"], "height")) == want
    assert rows(aggregate(plants, ["country"], Largest("height"), ["height"])) == want


def test_largest_takes_no_change_log(spark):
    df = spark.createDataFrame([("a", "-U", 1)], "k STRING, op STRING, v BIGINT")
    with pytest.raises(Exception, match="taken back"):
        aggregate(df, ["k"], Largest("v"), ["v"], op="op").collect()


@pytest.mark.parametrize("values,want", [
    ([5, 0, -1], [5]), ([7, 7, 7], [7, 7]), ([-3, -1, -2], [-2, -1]), ([0], []), ([4], [4]), ([0, 0, 3], [3]),
])
def test_top2_rules(spark, values, want):
    df = spark.createDataFrame([("k", v) for v in values], "k STRING, v BIGINT").repartition(3)
    expected = sorted([("k", v) for v in want], key=str)
    assert rows(top_per_group(df, ["k"], "v")) == expected
    assert rows(aggregate(df, ["k"], Largest("v"), ["v"])) == expected


def test_strict_and_lenient_integers(spark):
    df = spark.createDataFrame([("12",), ("x",)], "t STRING")
    assert rows(df.select(to_bigint(F.col("t"), strict=False))) == [(12,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(to_bigint(F.col("t"))).collect()


def test_schema_and_plans(spark, plants, capsys):
    assert schema_lines(plants) == ["`id` BIGINT", "`species` STRING", "`height` STRING", "`country` STRING"]
    print_schema(plants)
    assert "`height` STRING" in capsys.readouterr().out
    text = explain(plants)
    assert "Analyzed Logical Plan" in text and "Physical Plan" in text
    assert "Optimized Logical Plan" in explain_sql(spark, "SELECT species FROM {p}", p=plants)


def test_declared_types(spark):
    df = from_collection(spark, [("a", 1, 1.5)], "k STRING, i INT, f FLOAT")
    assert df.dtypes == [("k", "string"), ("i", "int"), ("f", "float")]
    with pytest.raises(Exception):
        from_collection(spark, [("a", "x", 1.5)], "k STRING, i INT, f FLOAT").collect()
