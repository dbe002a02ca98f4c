"""Count outliers: global, by group, and for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.operators.ranges import weighted_medians

MAD_SCALE = 1.4826


def log_outliers(nodes: DataFrame, sigma: float = 2.0) -> DataFrame:
    """[AN-01, AG-07, FN-20, PD-07, PD-08] (skill, total_count, log_count, z, flagged) of nodes (skill, total_count > 0)."""
    live = nodes.filter("total_count > 0").withColumn("x", F.ln("total_count"))
    fit = live.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    z = S.z_score(F.col("x"), F.col("m"), F.col("s"))
    return live.crossJoin(F.broadcast(fit)).select("skill", "total_count", F.round("x", 4).alias("log_count"), F.round(z, 4).alias("z"), (F.abs(z) >= sigma).alias("flagged"))  # one row


def _fit(rows: DataFrame, keys: list[str], robust: bool) -> DataFrame:
    if not robust:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.avg("x").alias("center"), F.stddev_samp("x").alias("spread"))
    hist = rows.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n"))
    center = weighted_medians(hist, keys).withColumnRenamed("median", "center")
    off = hist.join(center, keys).groupBy(*keys, F.abs(F.col("x") - F.col("center")).alias("off")).agg(F.sum("n").alias("n"))
    spread = weighted_medians(off, keys, "off").select(*keys, (F.col("median") * MAD_SCALE).alias("spread"))
    return center.join(spread, keys)


def _plain(name: str) -> Column:
    """Rounded to 4, without a negative zero."""
    return F.when(F.round(name, 4) == 0, 0.0).otherwise(F.round(name, 4))


def group_outliers(nodes: DataFrame, sigma: float = 2.0, alpha: float = 0.4, beta: float = 0.6, least: int = 5, robust: bool = True) -> DataFrame:
    """[AN-02, AG-08, AG-09, FN-22..24, WN-06] Global and group z-scores of nodes (skill, total_count, grp, super_grp).

    Center and spread of a group are rounded to 4 before use, those of all nodes aren't; without a global spread there
    are no rows.  Medians come from histograms in ranges, so that no task holds the values of a group.
    """
    live = nodes.filter("total_count > 0").withColumn("x", F.ln("total_count"))
    both = live.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("all"), "grp", "x").withColumn("grp", F.when(F.col("all"), "").otherwise(F.col("grp")))
    fits = _fit(both, ["all", "grp"], robust)  # of all nodes and of each group in one go
    whole = fits.filter("all").select(F.col("center").alias("gc"), F.col("spread").alias("gs"))
    kept = F.col("size") >= least
    group = fits.filter(~F.col("all")).select("grp", "size", F.when(kept, F.round("center", 4)).alias("c"), F.when(kept, F.round("spread", 4)).alias("s"))
    rows = live.join(group, "grp").crossJoin(F.broadcast(whole))  # one row
    rows = rows.withColumn("g", S.z_score(F.col("x"), F.col("gc"), F.col("gs"))).withColumn("l", S.z_score(F.col("x"), F.col("c"), F.when(F.col("s") > 0, F.col("s")))).filter("g is not null")
    sus = S.suspicion(F.col("g"), F.col("l"), alpha, beta)
    return rows.select("skill", "total_count", F.round("x", 4).alias("log_count"), "grp", "super_grp", "size", _plain("g").alias("global_z"), _plain("l").alias("group_z"), F.round(sus, 4).alias("suspicion_score"), S.verdict(F.col("g"), F.col("l"), sigma).alias("verdict"))


def anomaly_ln1p(nodes: DataFrame) -> DataFrame:
    """[AN-03, AG-10, FN-21] z-scores of ln(count + 1), zero counts kept; a group of one has deviation 0.1."""
    rows = nodes.withColumn("x", F.ln(F.col("total_count") + 1))
    fit = rows.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    group = rows.groupBy("grp").agg(F.avg("x").alias("gm"), F.when(F.count(F.lit(1)) == 1, 0.1).otherwise(F.stddev_samp("x")).alias("gs"))
    out = rows.join(group, "grp").crossJoin(F.broadcast(fit))  # one row
    return out.select("skill", "grp", "total_count", F.round("x", 4).alias("log_count"), F.round(S.z_score(F.col("x"), F.col("m"), F.col("s")), 4).alias("global_z"), F.round(S.z_score(F.col("x"), F.col("gm"), F.col("gs")), 4).alias("group_z"))


def refit(nodes: DataFrame, least_count: int, threshold: float = 2.0) -> DataFrame:
    """[AN-04, WN-07, PD-10, PD-15] Fit again on nodes of at least ``least_count``, with the display class."""
    return log_outliers(nodes.filter(F.col("total_count") >= least_count), threshold).withColumn("class", S.dashboard_class(F.col("z"), F.lit(None).cast("double"), threshold))


def log_histogram(nodes: DataFrame, step: float = 0.2, top: float = 9.0) -> DataFrame:
    """[AG-22, AN-06, AN-07] (bin, n): bins [bin * step, bin * step + step) of log counts within [0, top]."""
    live = nodes.filter("total_count > 0").withColumn("x", F.ln("total_count")).filter(F.col("x") <= top)
    return live.groupBy(F.floor(F.col("x") / step).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bin_members(nodes: DataFrame, lo: float, hi: float) -> DataFrame:
    """[AN-07]"""
    return nodes.filter("total_count > 0").filter((F.ln("total_count") >= lo) & (F.ln("total_count") < hi)).orderBy(F.desc("total_count"), "skill")


def fitted_curve(nodes: DataFrame, step: float = 0.05, top: float = 9.0) -> DataFrame:
    """[AN-06, FN-25]"""
    fit = nodes.filter("total_count > 0").agg(F.avg(F.ln("total_count")).alias("m"), F.stddev_samp(F.ln("total_count")).alias("s"))
    points = fit.select("m", "s", F.explode(F.sequence(F.lit(0), F.lit(round(top / step)))).alias("i"))
    return points.select("i", F.round(S.gaussian(F.col("i") * step, F.col("m"), F.col("s")), 6).alias("density"))


def outlier_summary(scored: DataFrame, nodes: DataFrame, sigma: float = 2.0, least: int = 5) -> DataFrame:
    """[AG-11, AG-23]"""
    flagged = scored.agg(F.count_if(F.col("suspicion_score") >= sigma).alias("flagged"))
    groups = nodes.filter("total_count > 0").groupBy("grp").count().agg(F.count_if(F.col("count") >= least).alias("groups_sufficient"), F.count_if(F.col("count") < least).alias("groups_fallback"))
    seen = nodes.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("total_count") > 0).alias("connected"), F.count_if(F.col("total_count") <= 0).alias("disconnected"))
    return seen.crossJoin(groups).crossJoin(flagged)


def health_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """[AN-08, FN-42, AG-20]"""
    covered = nodes.agg(F.avg(F.when(F.col("total_count") > 0, 1.0).otherwise(0.0)).alias("coverage"))
    noise = edges.agg((100 * F.avg(F.when(F.col("weight") <= 1, 1.0).otherwise(0.0))).alias("noise"))
    row = covered.crossJoin(noise)
    return row.select(F.round("coverage", 4).alias("coverage"), F.round("noise", 4).alias("noise"), S.health(F.col("coverage"), 0.7, 0.5, True).alias("coverage_health"), S.health(F.col("noise"), 30, 40, False).alias("noise_health"))


def subgroups(nodes: DataFrame) -> DataFrame:
    """[AG-21]"""
    return nodes.groupBy("super_grp").agg(F.count_distinct("grp").alias("sub_groups"))


def top_outliers(scored: DataFrame, column: str, k: int = 50) -> DataFrame:
    """[ST-06, ST-08] The ``k`` rows of largest absolute ``column``, with their rank; ties by count, then by name."""
    out = scored.filter(F.col(column).isNotNull()).orderBy(F.desc(F.abs(column)), F.desc("total_count"), "skill").limit(k)
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.abs(column)), F.desc("total_count"), "skill")))  # k rows


def by_verdict(scored: DataFrame, k: int = 12) -> DataFrame:
    """[ST-06, ST-08] The ``k`` most suspicious rows of each verdict."""
    rank = F.row_number().over(Window.partitionBy("verdict").orderBy(F.desc("suspicion_score"), F.desc("total_count"), "skill"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def with_labels(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """[AN-05] Nodes with the label of a fixed list (name, label), compared without regard to case; null where there is none."""
    known = labels.groupBy(F.lower(F.trim("name")).alias("k")).agg(F.min("label").alias("label"))
    return nodes.join(known, F.lower(F.trim("skill")) == F.col("k"), "left").drop("k")
