"""The fund domain on the supplied TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.plans import gold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def class_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as share classes: the digits of the name are the CNPJ."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("CNPJ_FUNDO_CLASSE"), F.col("s_name").alias("DENOM_SOCIAL")
    )


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw report rows: several per fund and day."""
    returned = F.col("l_returnflag") == "R"
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("CNPJ_FUNDO_CLASSE"),
        F.col("l_shipdate").cast("date").alias("DT_COMPTC"),
        F.col("l_quantity").alias("VL_PATRIM_LIQ"),
        F.when(~returned, price).otherwise(F.lit(0.0)).alias("CAPTC_DIA"),
        F.when(returned, price).otherwise(F.lit(0.0)).alias("RESG_DIA"),
        F.col("l_linenumber").cast("double").alias("NR_COTST"),
    )


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items summed to one report row per supplier and day, in whole cents."""
    returned = F.col("l_returnflag") == "R"
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("DT_COMPTC"))
        .agg(
            (F.sum(F.rint(F.col("l_quantity") * 100).cast("long")) / 100).alias("VL_PATRIM_LIQ"),
            (F.sum(F.when(~returned, cents).otherwise(F.lit(0))) / 100).alias("CAPTC_DIA"),
            (F.sum(F.when(returned, cents).otherwise(F.lit(0))) / 100).alias("RESG_DIA"),
            F.countDistinct("l_orderkey").cast("double").alias("NR_COTST"),
        )
        .withColumn("CNPJ_FUNDO_CLASSE", F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
        .drop("l_suppkey")
    )


def dim_fundo(spark: SparkSession, sf_dir: str, variant: str = "local", key: str = "parity") -> DataFrame:
    return gold.dim_fundo(class_registry(spark, sf_dir), variant, key=key)


def fact(spark: SparkSession, sf_dir: str, variant: str = "local", key: str = "parity") -> DataFrame:
    """Daily fact; the report above has one row per fund and day."""
    return gold.fct_fundo_diario(
        daily_report(spark, sf_dir), dim_fundo(spark, sf_dir, key=key), variant, one_row_per_day=True, key=key
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as applications and errors as redemptions of the user, in the feed's columns."""
    kind = F.when(F.col("event_type") == "purchase", "A").when(F.col("event_type") == "error", "R")
    number = F.get_json_object("props", "$.k").cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("purchase", "error"))
        .select(
            F.col("user_id").alias("fk_cliente"),
            number.alias("fk_classe"),
            number.alias("fk_subclasse"),
            kind.alias("natureza_operacao"),
            F.col("value").cast("decimal(19,2)").alias("valor"),
            F.col("ts").alias("data"),
        )
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sk_cliente"), F.col("c_mktsegment").alias("segmento")
    )
