from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.contracts import base_contract, base_contracts
from meterlake.functions.columns import duration_minutes, lenient_cast, required, snake_case
from meterlake.operators.bronze import canonical_columns
from meterlake.plans.exploration import duration_buckets, monthly_volume


@pytest.mark.parametrize(
    "name,expected",
    [
        ("VendorID", "vendor_id"),
        ("RatecodeID", "ratecode_id"),
        ("PUlocationID", "pu_location_id"),
        ("DOLocationID", "do_location_id"),
        ("SR_Flag", "s_r_flag"),
        ("dropOff_datetime", "drop_off_datetime"),
        ("Affiliated_base_number", "affiliated_base_number"),
        ("LocationID", "location_i_d"),
        ("_source_file", "_source_file"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_contract_sizes():
    sizes = {name: len(contract.columns) for name, contract in base_contracts().items()}
    assert sizes == {"yellow": 20, "green": 20, "fhv": 7, "fhvhv": 25, "taxi_zones": 4}


@pytest.mark.parametrize(
    "text,kind,expected",
    [
        ("1", T.LongType(), 1),
        ("1.0", T.LongType(), 1),
        ("9007199254740993", T.LongType(), 9007199254740993),
        ("abc", T.LongType(), None),
        ("1e300", T.LongType(), None),
        ("2.5", T.DoubleType(), 2.5),
        ("", T.DoubleType(), None),
        ("7", T.IntegerType(), 7),
        ("99999999999", T.IntegerType(), None),
    ],
)
def test_lenient_cast(spark, text, kind, expected):
    frame = spark.createDataFrame([(text,)], "v string")
    assert frame.select(lenient_cast(F.col("v"), kind)).first()[0] == expected


def test_canonical_value_order(spark):
    """Physical first, then the rescued name, then the rescued alias; keys match exactly."""
    frame = spark.createDataFrame(
        [
            (1, 5.0, '{"total_amount": "9"}'),
            (None, None, '{"total_amount": "9.5", "VendorID": "2.0"}'),
            (None, None, '{"Airport_fee": "1.25", "vendorid": "3"}'),
            (None, None, '{"airport_fee": "2.5", "Airport_fee": "1.25"}'),
            (None, None, None),
            (None, None, "not json"),
        ],
        "vendorid int, total_amount double, _rescued_data string",
    )
    rows = canonical_columns(frame, base_contract("yellow"), []).select(
        "VendorID", "total_amount", "airport_fee", "_rescued_data", "trip_distance"
    ).collect()
    assert [tuple(r)[:3] for r in rows] == [
        (1, 5.0, None),
        (2, 9.5, None),
        (None, None, 1.25),
        (None, None, 2.5),
        (None, None, None),
        (None, None, None),
    ]
    assert rows[5]["_rescued_data"] == "not json"
    assert all(r["trip_distance"] is None for r in rows)


def test_what_does_not_fit_is_kept(spark):
    frame = spark.createDataFrame(
        [("7", "x"), ("seven", None), (None, "y")], "VendorID string, surprise string"
    )
    rows = canonical_columns(frame, base_contract("yellow"), []).select("VendorID", "_rescued_data").collect()
    assert [tuple(r) for r in rows] == [
        (7, '{"surprise":"x"}'),
        (None, '{"VendorID":"seven"}'),
        (None, '{"surprise":"y"}'),
    ]


def test_duration_truncates_toward_zero(spark):
    frame = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:00.5' AS a, TIMESTAMP '2024-01-01 00:00:00' AS b, "
        "TIMESTAMP '2024-01-01 00:01:30.9' AS c"
    )
    row = frame.select(
        duration_minutes(F.col("a"), F.col("b")), duration_minutes(F.col("b"), F.col("c"))
    ).first()
    assert tuple(row) == (0.0, 1.5)


def test_required_raises_on_null(spark):
    frame = spark.createDataFrame([("a",), (None,)], "x string")
    with pytest.raises(Exception, match="null in required column x"):
        frame.select(required("x")).collect()


def test_duration_bucket_edges(spark):
    values = [None, -0.1, 0.0, 5.0, 5.1, 15.0, 30.0, 60.0, 120.0, 1440.0, 1440.1]
    frame = spark.createDataFrame([(v,) for v in values], "trip_duration_minutes double")
    rows = duration_buckets(frame).collect()
    assert [(r["faixa_duracao"][:2], r["quantidade_corridas"]) for r in rows] == [
        ("00", 1), ("01", 1), ("02", 2), ("03", 2), ("04", 1), ("05", 1), ("06", 1), ("07", 1), ("08", 1)
    ]
    assert sum(r["quantidade_corridas"] for r in rows) == len(values)


def test_change_starts_with_null(spark):
    frame = spark.createDataFrame([("2023-01",)] * 3 + [("2023-02",)] * 4, "_reference_month string")
    rows = monthly_volume(frame).collect()
    assert [r["variacao_percentual_mes_anterior"] for r in rows] == [None, 33.33]


def test_values_that_only_nearly_fit_are_rescued(spark):
    """Fractions, whole numbers beyond 2^53 and text with decimals are cut in the column and kept in the rescue text."""
    frame = spark.sql(
        "SELECT * FROM VALUES (1.5D, 9007199254740993L, '2.9'), (2.0D, 7L, '3.0'), (3.0D, NULL, 'x'), (NULL, 9L, '1e2') "
        "AS t(VendorID, total_amount, PULocationID)"
    )
    rows = canonical_columns(frame, base_contract("yellow"), []).select("VendorID", "PULocationID", "_rescued_data").collect()
    assert [tuple(r) for r in rows] == [
        (1, 2, '{"VendorID":1.5,"total_amount":9007199254740993,"PULocationID":"2.9"}'),
        (2, 3, None),
        (3, None, '{"PULocationID":"x"}'),
        (None, 100, None),
    ]


def test_own_rescue_text_and_leftovers_are_merged(spark):
    frame = spark.createDataFrame(
        [
            (1, '{"a":1}', "n"),
            (2, None, "n"),
            (3, '{"a":1}', None),
            (4, "{}", "n"),
            (5, '{"note":"own"}', "n"),
            (6, "no object", "n"),
            (7, "no object", None),
        ],
        "VendorID long, _rescued_data string, note string",
    )
    rows = canonical_columns(frame, base_contract("yellow"), []).select("VendorID", "_rescued_data").collect()
    assert dict(map(tuple, rows)) == {
        1: '{"a":1,"note":"n"}',
        2: '{"note":"n"}',
        3: '{"a":1}',
        4: '{"note":"n"}',
        5: '{"note":"own","_column_note":"n"}',
        6: '{"_rescued_data":"no object","note":"n"}',
        7: "no object",
    }
