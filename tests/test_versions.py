"""Full refreshes as versions: what readers see before, during and after one, in this session and the next."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.sources.tables import Lake, TableSpec, committed, ensure_table, publish, publish_months

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("month", T.StringType())])


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path), "unused", "v_bronze", "v_silver", "v_gold", "v_quality")
    lake.create_databases(spark)
    yield lake
    for database in (lake.bronze, lake.silver, lake.gold, lake.quality):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def rows(spark, lake, name="v_gold.t"):
    return sorted(map(tuple, spark.table(name).select("id", "month").collect()), key=repr)


@pytest.mark.parametrize("partition_by", [(), ("month",)])
def test_versions(spark, lake, partition_by):
    spec = TableSpec("v_gold.t", SCHEMA, partition_by)
    first = [(1, "2023-01"), (2, "2023-02"), (3, None)]
    publish(spark, lake, spec, spark.createDataFrame(first, SCHEMA))
    assert rows(spark, lake) == sorted(first, key=repr)
    reader = spark.table("v_gold.t").select("id", "month")
    reader.collect()

    failing = spark.createDataFrame(first, SCHEMA).withColumn("id", F.when(F.col("id") > 0, F.raise_error(F.lit("broken"))).cast("long"))
    with pytest.raises(Exception, match="broken"):
        publish(spark, lake, spec, failing)
    assert rows(spark, lake) == sorted(first, key=repr)
    assert committed(spark, lake, spec.name)[0] == 1

    # A table may be refreshed from itself; a month goes, one comes, one changes.
    second = spark.table("v_gold.t").where("id <> 1").withColumn("id", F.col("id") + 10).unionByName(spark.createDataFrame([(9, "2023-03")], SCHEMA))
    publish(spark, lake, spec, second)
    expected = [(12, "2023-02"), (13, None), (9, "2023-03")]
    assert rows(spark, lake) == sorted(expected, key=repr)
    assert sorted(map(tuple, reader.collect()), key=repr) == sorted(first, key=repr)

    # Another session's catalogue knows nothing yet.
    spark.sql("DROP TABLE v_gold.t")
    ensure_table(spark, lake, spec)
    assert rows(spark, lake) == sorted(expected, key=repr)
    if partition_by:
        publish_months(spark, lake, spec, spark.createDataFrame([(20, "2023-03"), (0, "2023-02")], SCHEMA), "month", ["2023-03"])
        expected[-1] = (20, "2023-03")
        assert rows(spark, lake) == sorted(expected, key=repr)

    publish(spark, lake, spec, spark.createDataFrame([], SCHEMA))
    assert rows(spark, lake) == []
    publish(spark, lake, spec, spark.createDataFrame(first, SCHEMA))
    assert rows(spark, lake) == sorted(first, key=repr)
    folders = [p.name for p in (lake_path(lake) / "v_gold" / "t").iterdir()]
    assert sorted(f[:9] for f in folders if f[0] == "0") == ["000000003", "000000004"]


def lake_path(lake):
    from pathlib import Path

    return Path(lake.root) / "_versions"
