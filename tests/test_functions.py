from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from cargolake.functions import dates, expenses, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def each(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def test_strip_takes_every_kind_of_blank(spark):
    got = each(spark, ["\t ab \n", " ab　", "a b", "", None], "string", text.strip)
    assert got == ["ab", "ab", "a b", "", None]


def test_blank_to_null_and_collapse(spark):
    assert each(spark, [" ", "\t\r\n", " x "], "string", text.blank_to_null) == [None, None, "x"]
    assert each(spark, ["a \t\n b  c"], "string", text.collapse_blanks) == ["a b c"]


def test_tokens(spark):
    names = ["Ivanov  Ivan Ivanovich", " Petrov Petr", "Sidorov", "", None]
    assert each(spark, names, "string", lambda c: text.token(c, 0)) == ["Ivanov", "Petrov", "Sidorov", "", ""]
    assert each(spark, names, "string", lambda c: text.token(c, 2)) == ["Ivanovich", "", "", "", ""]


def test_file_name_parts(spark):
    names = ["delivery_230_A%20777_20250101_101010.jsonl", "trip.jsonl", "a+b_7_x"]
    decoded = each(spark, names, "string", text.decoded_file_name)
    assert decoded == ["delivery_230_A 777_20250101_101010.jsonl", "trip.jsonl", "a+b_7_x"]
    assert each(spark, decoded, "string", text.key_from_file_name) == ["230", None, "7"]
    assert each(spark, ["май_2025.xlsx", "a.b.xlsx", "plain"], "string", text.stem) == ["май_2025", "a.b", "plain"]


def test_money_text(spark):
    given = ["1 200,50 ₽", "300", "-1", "abc", "", None, "2 000,1"]
    expected = [Decimal("1200.50"), Decimal("300.00"), Decimal("-1.00"), None, None, None, Decimal("2000.10")]
    assert each(spark, given, "string", numbers.money_text) == expected


def test_round_mean_sends_ties_up_on_both_sides_of_zero(spark):
    got = each(spark, [2.675, -2.675, 2.674, None], "double", lambda c: numbers.round_mean(c, 2))
    assert got == [2.68, -2.68, 2.67, None]


def test_safe_ratio_and_clamp(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(numbers.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [2.0, None, None]
    assert each(spark, [-5, 0, 4, None], "int", numbers.clamp_min) == [0, 0, 4, None]


def test_compose_date(spark):
    cells = [
        ("05.03", "март_2025", date(2025, 3, 5)),
        ("05.04", "март_2025", date(2025, 4, 5)),  # the month comes from the cell
        ("31.02", "февраль_2025", None),
        ("05", "март_2025", None),
        ("05.03", "март", None),
        ("5.3", "march_2025", date(2025, 3, 5)),
        ("a.b", "march_2025", None),
        ("05.03", "march_x", None),
        (None, "march_2025", None),
        ("05.03", None, None),
        ("05.", "march_2025", None),
    ]
    df = spark.createDataFrame(cells, "d string, m string, e date")
    for r in df.withColumn("x", dates.compose_date(F.col("d"), F.col("m"))).collect():
        assert r["x"] == r["e"], r


def test_weeks_start_on_sunday_and_weekdays_on_monday(spark):
    days = [date(2024, 12, 28), date(2024, 12, 29), date(2024, 12, 30)]
    assert each(spark, days, "date", dates.week_start) == [date(2024, 12, 22), date(2024, 12, 29), date(2024, 12, 29)]
    assert each(spark, days, "date", dates.date_key) == [20241228, 20241229, 20241230]


def test_epoch_millis_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = each(spark, [0, 1704067207179, None], "bigint", dates.from_epoch_millis)
        assert got == [datetime(1970, 1, 1), datetime(2024, 1, 1, 0, 0, 7, 179000), None]
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-09 23:59:30' a, TIMESTAMP_NTZ'2024-03-10 12:00:29.9' b")
        assert df.select(dates.whole_minutes(F.col("a"), F.col("b"))).first()[0] == 720
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_categories(spark):
    labels = [*expenses.CATEGORY_OF_LABEL, "Ремонт (запчасти)", "топливо", None]
    got = each(spark, labels, "string", expenses.category_of)
    assert got == ["fuel"] * 3 + ["repair"] * 4 + ["wash"] * 2 + ["other"] * 3


def test_money_sums_are_exact(spark):
    biggest = Decimal("9999999999999.99")
    df = spark.createDataFrame([(biggest,), (biggest,), (Decimal("-0.01"),), (Decimal("0.07"),), (None,)], "m decimal(15,2)")
    assert df.agg(numbers.sum_money(F.col("m"))).first()[0] == 2 * biggest + Decimal("0.06")
    cents = spark.range(100000).select((F.col("id") / 100).cast("decimal(15,2)").alias("m"))
    assert cents.agg(numbers.sum_money(F.col("m"))).first()[0] == Decimal(100000 * 99999 // 2) / 100
    assert df.where("m IS NULL").agg(numbers.sum_money(F.col("m"))).first()[0] is None
