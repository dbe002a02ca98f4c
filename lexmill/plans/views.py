"""Views of the driver's tables as taxonomies, graphs and mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long term table from part: type is the group, name the canonical, brand the alias, key the place."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("grp"), F.lit(0).alias("grp_pos"), F.col("p_name").alias("canonical"), F.lit(0).alias("canonical_pos"), F.col("p_brand").alias("alias"), F.col("p_partkey").alias("alias_pos"))


def odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with separators, parentheses and versions, made from part."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 7
    word = F.split("p_name", " ")
    name = (
        F.when(k == 0, F.concat("p_brand", F.lit("/"), "p_name"))
        .when(k == 1, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
        .when(k == 2, F.concat("p_name", F.lit(" and "), "p_type"))
        .when(k == 3, F.concat(F.lit("Advanced  "), "p_name"))
        .when(k == 4, F.concat("p_name", F.lit(", "), "p_type"))
        .when(k == 5, F.concat("p_name", F.lit(" v"), F.col("p_size").cast("string")))
        .otherwise(F.concat(F.lit("  "), F.upper("p_name"), F.lit("-"), "p_brand"))
    )
    return p.select("p_partkey", name.alias("name"), word[0].alias("first_word"))


def skill_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their number of orders, by nation and region."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, sf_dir, "customer").join(o, "c_custkey", "left")
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("skill"), F.coalesce("n", F.lit(0)).cast("bigint").alias("total_count"), F.col("n_name").alias("grp"), F.col("r_name").alias("super_grp"))


def jd_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), "l_partkey")
    return li.join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("item")), F.col("l_partkey") == F.col("p_partkey")).select("doc", "item").distinct()


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("Skill "), F.get_json_object("props", "$.k")).alias("name"),
        F.col("event_type").alias("tag"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("event_id").alias("ord"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").alias("grp"))
