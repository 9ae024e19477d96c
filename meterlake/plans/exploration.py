"""Exploratory results over the yellow consumption table.

Every result aggregates first; windows and sorts only ever see aggregated rows (months,
vendors, buckets), which is what makes a window without partitions safe.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.columns import bucket, duration_minutes, percent_change, percent_of
from meterlake.functions.months import in_window, month_label, month_start

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
MONTH = "mes_referencia"

# --- Fixed values: bucket limits in minutes (inclusive) and the published labels
FIXED_MISSING = "00. Não informada"
FIXED_NEGATIVE = "01. Negativa"
FIXED_ALL_BUCKETS = (
    (5, "02. Até 5 min"),
    (15, "03. 5 a 15 min"),
    (30, "04. 15 a 30 min"),
    (60, "05. 30 a 60 min"),
    (120, "06. 1 a 2 h"),
    (1440, "07. 2 a 24 h"),
)
FIXED_OVER_A_DAY = "08. Acima de 24 h"
FIXED_VALID_BUCKETS = (
    (5, "01. Até 5 min"),
    (15, "02. 5 a 15 min"),
    (30, "03. 15 a 30 min"),
    (60, "04. 30 a 60 min"),
    (120, "05. 1 a 2 h"),
)
FIXED_LONGEST_VALID = "06. 2 a 24 h"
FIXED_DAY_MINUTES = 1440
FIXED_NO_VENDOR = "NÃO INFORMADO"
# --- End of fixed values



def trips_with_duration(consumption: DataFrame, start_month: str, end_month: str) -> DataFrame:
    return consumption.filter(F.col("_reference_month").between(start_month, end_month)).select(
        "VendorID",
        "passenger_count",
        "total_amount",
        PICKUP,
        DROPOFF,
        "_reference_month",
        duration_minutes(F.col(PICKUP), F.col(DROPOFF)).alias("trip_duration_minutes"),
    )


def _by_month(trips: DataFrame):
    return trips.groupBy(F.col("_reference_month").alias(MONTH))


def _non_negative() -> Column:
    return F.when(F.col("total_amount") >= 0, F.col("total_amount"))


def _kept_and_removed() -> list[Column]:
    return [
        F.count_if(F.col("total_amount") >= 0).alias("corridas_consideradas"),
        F.count_if(F.col("total_amount") < 0).alias("corridas_negativas_removidas"),
    ]


def _sensitivity() -> list[Column]:
    return [
        F.round(F.sum(_non_negative()), 2).alias("receita_sem_negativos"),
        F.round(F.avg(_non_negative()), 2).alias("ticket_medio_sem_negativos"),
        F.round(F.sum(_non_negative()) - F.sum("total_amount"), 2).alias("impacto_na_receita"),
    ]


def monthly_volume(trips: DataFrame) -> DataFrame:
    counts = _by_month(trips).agg(F.count(F.lit(1)).alias("quantidade_corridas"))
    change = percent_change(F.col("quantidade_corridas"), Window.orderBy(MONTH))
    return counts.withColumn("variacao_percentual_mes_anterior", change).orderBy(MONTH)


def pickup_versus_reference(trips: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Trips per file month against trips per pickup month, for every file month.

    The trips are read once: counted by both months together, they shrink to a few rows,
    and each of those then counts for its file month and for its pickup month.
    """
    pickup_month = F.when(in_window(F.col(PICKUP), start, end), month_start(F.col(PICKUP)))
    pairs = (
        trips.groupBy(F.col("_reference_month").alias("file_month"), pickup_month.alias("pickup_start"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select("file_month", month_label(F.col("pickup_start")).alias("pickup_month"), "trips")
    )

    def side(month: str, **counts: Column) -> Column:
        nothing = F.lit(None).cast("long")
        values = {name: counts.get(name, nothing) for name in ("by_file", "by_pickup")}
        return F.struct(F.col(month).alias("mes_pickup"), *[c.alias(n) for n, c in values.items()])

    sides = pairs.select(
        F.inline(
            F.array(
                side("file_month", by_file=F.col("trips")),
                side("pickup_month", by_pickup=F.col("trips")),
            )
        )
    )
    change = percent_change(F.col("corridas_mes_pickup"), Window.orderBy("mes_pickup"))
    return (
        sides.groupBy("mes_pickup")
        .agg(
            F.sum("by_file").alias("corridas_mes_arquivo"),
            F.sum("by_pickup").alias("corridas_mes_pickup"),
        )
        .filter(F.col("corridas_mes_arquivo").isNotNull())
        .select(
            "mes_pickup",
            "corridas_mes_arquivo",
            "corridas_mes_pickup",
            (F.col("corridas_mes_pickup") - F.col("corridas_mes_arquivo")).alias("diferenca"),
            change.alias("variacao_percentual_mes_anterior"),
        )
        .orderBy("mes_pickup")
    )


def revenue(trips: DataFrame) -> DataFrame:
    return (
        _by_month(trips)
        .agg(
            F.round(F.sum("total_amount"), 2).alias("receita_total_registrada"),
            F.round(F.avg("total_amount"), 2).alias("ticket_medio"),
            F.count("total_amount").alias("corridas_com_valor"),
            (F.count(F.lit(1)) - F.count("total_amount")).alias("corridas_sem_valor"),
        )
        .orderBy(MONTH)
    )


def revenue_sensitivity(trips: DataFrame) -> DataFrame:
    total, mean, impact = _sensitivity()
    return _by_month(trips).agg(total, mean, *_kept_and_removed(), impact).orderBy(MONTH)


def _by_vendor(trips: DataFrame, *measures: Column) -> DataFrame:
    label = F.coalesce(F.col("VendorID").cast("string"), F.lit(FIXED_NO_VENDOR))
    return trips.groupBy("VendorID").agg(*measures).withColumn("vendor_id", label).drop("VendorID")


def vendors(trips: DataFrame) -> DataFrame:
    counted = _by_vendor(
        trips,
        F.count(F.lit(1)).alias("quantidade_corridas"),
        F.round(F.sum("total_amount"), 2).alias("receita_total_registrada"),
        F.round(F.avg("total_amount"), 2).alias("ticket_medio"),
    )
    everything = F.sum("quantidade_corridas").over(Window.partitionBy())
    return counted.select(
        "vendor_id",
        "quantidade_corridas",
        "receita_total_registrada",
        "ticket_medio",
        percent_of(F.col("quantidade_corridas"), everything, 2).alias("percentual_corridas"),
    ).orderBy(F.desc("quantidade_corridas"), "vendor_id")


def vendor_sensitivity(trips: DataFrame) -> DataFrame:
    measured = _by_vendor(trips, *_kept_and_removed(), *_sensitivity())
    first = ["vendor_id", "corridas_consideradas", "corridas_negativas_removidas"]
    rest = [c for c in measured.columns if c not in first]
    return measured.select(*first, *rest).orderBy(F.desc("corridas_consideradas"), "vendor_id")


def passengers(trips: DataFrame) -> DataFrame:
    count = F.col("passenger_count")
    return (
        _by_month(trips)
        .agg(
            F.round(F.avg(count), 2).alias("media_passageiros_informada"),
            F.round(F.avg(F.when(count > 0, count)), 2).alias("media_passageiros_validos"),
            F.count(F.lit(1)).alias("quantidade_corridas"),
            F.count(count).alias("corridas_com_passageiros_informados"),
            F.count_if(count.isNull()).alias("corridas_sem_passageiros_informados"),
            F.count_if(count <= 0).alias("corridas_com_passageiros_nao_positivos"),
        )
        .orderBy(MONTH)
    )


def duration_buckets(trips: DataFrame) -> DataFrame:
    minutes = F.col("trip_duration_minutes")
    label = (
        F.when(minutes.isNull(), FIXED_MISSING)
        .when(minutes < 0, FIXED_NEGATIVE)
        .otherwise(bucket(minutes, FIXED_ALL_BUCKETS, FIXED_OVER_A_DAY))
    )
    counts = trips.groupBy(label.alias("faixa_duracao")).agg(F.count(F.lit(1)).alias("quantidade_corridas"))
    everything = F.sum("quantidade_corridas").over(Window.partitionBy())
    share = percent_of(F.col("quantidade_corridas"), everything, 4)
    return counts.withColumn("percentual_corridas", share).orderBy("faixa_duracao")


def _valid(trips: DataFrame) -> DataFrame:
    return trips.filter(
        F.col("trip_duration_minutes").between(0, FIXED_DAY_MINUTES) & F.col("total_amount").isNotNull()
    )


def correlation(trips: DataFrame) -> DataFrame:
    return _valid(trips).agg(
        F.round(F.corr("trip_duration_minutes", "total_amount"), 4).alias("correlacao_duracao_valor"),
        F.count(F.lit(1)).alias("corridas_consideradas"),
    )


def duration_amount_buckets(trips: DataFrame) -> DataFrame:
    """Counts, means and the exact median per bucket.

    Amounts are counted by cents, so what meets per bucket is bounded by the distinct amounts; rounding
    keeps their order, so the first one at half of the count is the rounded median.
    """
    label = bucket(F.col("trip_duration_minutes"), FIXED_VALID_BUCKETS, FIXED_LONGEST_VALID)
    cents = (
        _valid(trips)
        .groupBy(label.alias("faixa_duracao"), F.round("total_amount", 2).alias("cents"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("trip_duration_minutes").alias("minutes"), F.sum("total_amount").alias("amount"))
    )
    rising = Window.partitionBy("faixa_duracao").orderBy("cents").rowsBetween(Window.unboundedPreceding, 0)
    counted = cents.withColumn("upto", F.sum("n").over(rising)).withColumn(
        "everything", F.sum("n").over(Window.partitionBy("faixa_duracao"))
    )
    return (
        counted.groupBy("faixa_duracao")
        .agg(
            F.sum("n").alias("quantidade_corridas"),
            F.round(F.sum("minutes") / F.sum("n"), 2).alias("duracao_media_minutos"),
            F.round(F.sum("amount") / F.sum("n"), 2).alias("valor_total_medio"),
            F.min(F.when(2 * F.col("upto") >= F.col("everything"), F.col("cents"))).alias("mediana_total_amount"),
        )
        .orderBy("faixa_duracao")
    )
