"""How the work of a query grows: what its plan reads and deals out, and how it is spread."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import chars
from lexweave.operators import tree
from lexweave.plans import queries

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    return queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def assert_dealt_out(spark, name: str) -> None:
    """A file of one row group is one task's, so the text is dealt out before it is looked at."""
    text = plan(spark, name)
    assert text.count("RepartitionByExpression [doc_id") == text.count("Relation [doc_id") == 1


def test_span_class_is_dealt_out(spark):
    assert_dealt_out(spark, "f03_span_class")


def test_letters_of_two_code_units_join(spark):
    d = spark.createDataFrame([("a-\nb \U0001d400-\nc --\nd _-\ne-\nF",)], "t string")
    assert d.select(chars.dehyphenate("t")).first()[0] == "ab \U0001d400c --\nd _e-\nF"


def test_furniture_reads_documents_once(spark):
    assert_dealt_out(spark, "p05_furniture")


def test_misencoded_is_dealt_out(spark):
    assert_dealt_out(spark, "f08_misencoded")


@pytest.mark.parametrize("name, groups", [("i02_eids", 0), ("m01_meta", 0), ("w01_outline", 0), ("c05_external", 1)])
def test_a_tree_is_not_brought_together_again(spark, name, groups):
    """What a document's tree alone says is in its rows: no join, window or group over them; only c05 groups what it counts."""
    df = queries.QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    after = text[: text.index("MapInArrow")]
    assert (after.count("Join"), after.count("Window"), after.count("Aggregate")) == (0, 0, groups)
    assert "InMemoryRelation" not in text
    assert text.count("MapInArrow") == 1


@pytest.mark.parametrize("day, month, year", [("31", "February", "2020"), ("29", "Feb", "1900"), ("29", "feb", "2000"), ("0", "Ma", "2001"), ("1", "Foo", "2020"), ("31", "June", "2020"), ("30", "November", "0000")])
def test_impossible_dates_are_those_of_the_column(spark, day, month, year):
    column = chars.iso_date(*(F.lit(x) for x in (day, month, year)))
    assert tree.impossible(day, month, year) == (spark.range(1).select(column.alias("x")).first()["x"] is None)


def test_numbers_are_those_of_the_column(spark):
    nums = ["(1)", "12A.", "(iv)", "", "Section 4", "-5", "4 ", "a  b", "sec. 7-B", "--3", "\t(2)", "ಕ"]
    got = spark.createDataFrame([(x,) for x in nums], "n string").select(chars.normal_num("n")).collect()
    assert [tree.normal_num(x) for x in nums] == [r[0] for r in got]


def test_only_repeated_eids_are_counted(spark):
    """i05: rows of eIds given once go before the count."""
    text = plan(spark, "i05_collisions")
    assert text.count("MapInArrow") == 1 and "InMemoryRelation" not in text and "Union" not in text
    assert "(copies#" in text and "repeated#" in text


def test_reflow_is_dealt_out(spark):
    assert_dealt_out(spark, "l07_reflow")
