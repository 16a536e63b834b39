from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterlake.catalog import MASTERS
from meterlake.functions import measures, parse, text
from meterlake.plans.masters import bronze_master, landed_master


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("function", "values", "expected"),
    [
        (text.clean_text, ["  Compute ", "   ", "", None], ["compute", None, None, None]),
        (text.clean_region, ["US_East", " eu-west", "_", None], ["us-east", "eu-west", "-", None]),
        (
            text.clean_service,
            ["AI", "Object-Storage", " computing ", "databases", "network", "foo", " ", None],
            ["genai", "storage", "compute", "database", "networking", "foo", None, None],
        ),
        (text.unknown_service, ["compute", "foo", None], [False, True, False]),
        (text.unknown_region, ["us-east", "US_East", None], [False, True, False]),
        (parse.to_flag, ["True", " true ", "TRUE", "1", "yes", "", None], [True] * 3 + [False] * 4),
        (parse.to_number, ["109.0", " 124 ", "", "abc", "1e3", None], [109.0, 124.0, None, None, 1000.0, None]),
        (parse.to_day, ["2024-02-29", "2024-02-30", "bad", "", None], [date(2024, 2, 29)] + [None] * 4),
        (
            parse.to_instant,
            ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "bad", None],
            [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [None] * 2,
        ),
    ],
)
def test_columns(spark, function, values, expected):
    assert apply(spark, function, values) == expected


def test_share_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 2), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(measures.share(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0]


def test_measures_skip_the_unknown(spark):
    df = spark.createDataFrame([(True, 2.0), (None, 4.0), (False, 8.0), (True, None)], "f boolean, v double")
    found = df.agg(measures.rows(), measures.hits(F.col("f")), measures.sum_where(F.col("v"), F.col("f")))
    assert tuple(found.first()) == (4, 2, 2.0)


def test_csv_ingest_keeps_one_row_per_key(spark, tmp_path, rows):
    path = tmp_path / "billing_monthly.csv"
    path.write_text(
        "invoice_id,org_id,month,subtotal,credits,taxes,currency,exchange_rate_to_usd\n"
        "i1,o1,2025-07-01,1.0,,x,USD,\n"
        "i1,o1,2025-07-01,2.0,,x,USD,\n"
        "i2,o1,July,3.0,1,2,USD,1.5\n"
        "i3,o1\n"
    )
    table = MASTERS["billing_monthly"]
    found = bronze_master(landed_master(spark, table, str(path)), table)
    assert rows(found, "invoice_id", "month", "subtotal", "taxes", "exchange_rate_to_usd", "source_file") == [
        ("i1", date(2025, 7, 1), 2.0, None, None, "landing/billing_monthly.csv"),
        ("i2", None, 3.0, 2.0, 1.5, "landing/billing_monthly.csv"),
        ("i3", None, None, None, None, "landing/billing_monthly.csv"),
    ]
    assert found.schema.names == table.bronze.names


def test_all_seven_masters_have_a_contract():
    assert {n: t.keys for n, t in MASTERS.items()} == {
        "customers_orgs": ("org_id",),
        "users": ("user_id",),
        "billing_monthly": ("invoice_id",),
        "resources": ("resource_id",),
        "support_tickets": ("ticket_id",),
        "marketing_touches": ("touch_id",),
        "nps_surveys": ("org_id", "survey_date"),
    }
