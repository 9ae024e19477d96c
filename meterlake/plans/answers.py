"""The analytical questions, over the gold tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.months import in_window, month_label, month_start

PICKUP = "tpep_pickup_datetime"


def coverage(consumption: DataFrame, start: datetime, end: datetime) -> DataFrame:
    return consumption.filter(in_window(F.col(PICKUP), start, end)).agg(
        F.min(PICKUP).alias("primeira_coleta"),
        F.max(PICKUP).alias("ultima_coleta"),
        F.count(F.lit(1)).alias("quantidade_viagens"),
        F.count("total_amount").alias("viagens_com_total_amount"),
        F.count("passenger_count").alias("viagens_com_passenger_count"),
    )


def monthly_average_amount(consumption: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Mean amount by the month of the pickup, not of the file."""
    return (
        consumption.filter(in_window(F.col(PICKUP), start, end))
        .groupBy(month_start(F.col(PICKUP)).alias("month"))
        .agg(
            F.round(F.avg("total_amount"), 2).alias("media_total_amount"),
            F.count("total_amount").alias("viagens_com_total_amount"),
        )
        .select(month_label(F.col("month")).alias("mes_referencia"), "media_total_amount", "viagens_com_total_amount")
        .orderBy("mes_referencia")
    )


def passengers_by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        F.col("hour_of_day").alias("hora_do_dia"),
        F.round("average_passenger_count", 2).alias("media_yellow_green"),
        F.round("average_yellow_passenger_count", 2).alias("media_apenas_yellow"),
        F.round("average_green_passenger_count", 2).alias("media_apenas_green"),
        F.col("trips_considered").alias("viagens_consideradas"),
        F.col("yellow_trips_considered").alias("viagens_yellow"),
        F.col("green_trips_considered").alias("viagens_green"),
        F.col("trips_discarded").alias("viagens_descartadas"),
    ).orderBy("hora_do_dia")
