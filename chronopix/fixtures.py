"""The driver's tables seen as a cube: parts are pixels, shipments are observations, orders are scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.model import Measurement
from chronopix.sources.catalog import KEYS, Catalog

PQ_FLAGS = {
    "contiguous": {"bits": 0, "values": {0: False, 1: True}},
    "cloud": {"bits": 1, "values": {0: "no_cloud", 1: "cloud"}},
    "bright": {"bits": 2, "values": {0: False, 1: True}},
}
STATUS = {"status": {"bits": [0, 1], "values": {0: "open", 1: "final", 2: "pending"}}}

BANDS = (
    Measurement("blue", "float64"), Measurement("green", "float64"), Measurement("red", "float64", 0.0), Measurement("nir", "float64", 0.0), Measurement("gain", "float64"),
    Measurement("raw_red", "float64"), Measurement("raw_nir", "float64"), Measurement("water", "uint8"), Measurement("pq", "int32", flags_definition=PQ_FLAGS), Measurement("count8", "int8", -1),
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _keys(part: str = "l_partkey") -> list:
    y, x = F.floor(F.col(part) / 50).cast("int"), (F.col(part) % 50).cast("int")
    return [F.floor(x / 10).cast("int").alias("tile_x"), F.floor(y / 10).cast("int").alias("tile_y"), y.alias("y"), x.alias("x"), F.col("l_shipdate").alias("time"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord")]


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = lineitem(spark, sf_dir)
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    water = F.when(flag == "A", F.when(line == "F", 128).otherwise(132)).when(flag == "N", F.when(line == "F", 0).otherwise(4)).otherwise(F.when(line == "F", 64).otherwise(2))
    bit = lambda c, b: F.when(c, 1 << b).otherwise(0)
    return li.select(
        *_keys(),
        F.col("l_quantity").alias("blue"),
        F.col("l_extendedprice").alias("green"),
        F.col("l_discount").alias("red"),
        F.col("l_tax").alias("nir"),
        (F.col("l_discount") + 1).alias("gain"),
        F.col("l_discount").alias("raw_red"),
        F.col("l_tax").alias("raw_nir"),
        water.alias("water"),
        (bit(F.col("l_discount") > 0, 0) + bit(F.col("l_tax") > 0.06, 1) + bit(F.col("l_quantity") > 25, 2)).alias("pq"),
        (F.col("l_quantity") - 25).cast("int").alias("count8"),
        "l_orderkey", "l_partkey", "l_returnflag",
    )


def six_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("swir1"), F.col("p_retailprice").alias("swir2"))
    return cube(spark, sf_dir).select(*KEYS, "blue", "green", "red", "nir", "l_partkey").join(part, "l_partkey")


def order_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return lineitem(spark, sf_dir).select(*_keys(), "l_orderkey").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), status.alias("status"), F.col("o_totalprice").alias("level")), "l_orderkey").drop("l_orderkey").withColumn("lon", F.col("x") * 3.0)


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ancestor scenes: their customers' balance is their quality."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("dataset_id"), F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("center_time"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.col("c_acctbal").alias("quality"))
    return o.join(c, "c_custkey").drop("c_custkey")


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    c = Catalog()
    c.register("obs", lambda: cube(spark, sf_dir).withColumn("dataset_id", F.col("l_orderkey")).withColumn("lon", F.col("x") * 3.0), BANDS)
    c.register("obs_utc", lambda: cube(spark, sf_dir).withColumn("lon", F.lit(0.0)), BANDS)  # whose solar day is the date
    for flag in "ANR":
        c.register(f"obs_{flag}", lambda flag=flag: cube(spark, sf_dir).where(F.col("l_returnflag") == flag), BANDS)
    c.register("six", lambda: six_bands(spark, sf_dir), [*BANDS[:4], Measurement("swir1", "float64"), Measurement("swir2", "float64")])
    c.register("order_mask", lambda: order_masks(spark, sf_dir), [Measurement("status", "int32", flags_definition=STATUS), Measurement("level", "float64")])
    c.register("scenes", lambda: scenes(spark, sf_dir), [])
    return c
