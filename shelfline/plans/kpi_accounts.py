"""Account KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import pct, ratio
from shelfline.functions.time import day, months_back, week_start
from shelfline.operators.ranking import rank_within, top_n
from shelfline.plans.facts import net_sale_lines
from shelfline.session import settle


def _flag(condition):
    return F.coalesce(condition, F.lit(False))


def top_retailers(sales: DataFrame, returns: DataFrame, accounts: DataFrame, as_of: str,
                  k: int = 20) -> DataFrame:
    """Exactly ``k`` accounts by net revenue of the last complete week, with share,
    rank and movement against the week before."""
    this = F.date_sub(week_start(day(as_of)), 7)
    last = F.date_sub(week_start(day(as_of)), 14)
    upto = week_start(day(as_of))
    recent = sales.where((F.col("transaction_date") >= last) & (F.col("transaction_date") < upto))
    # Only returns of the two weeks' transactions matter; the left join filters them.
    lines = net_sale_lines(recent, returns, ["transaction_date", "retailer_id"])
    week = F.col("transaction_date") >= this
    by_account = lines.groupBy("retailer_id").agg(
        F.sum(F.when(week, F.col("net_revenue"))).cast("decimal(18,4)").alias("retailer_net_revenue"),
        F.sum(F.when(~week, F.col("net_revenue"))).cast("decimal(18,4)").alias("prior_revenue"))
    named = by_account.join(accounts.select("retailer_id", "retailer_name", "region", "retail_segment"), "retailer_id")
    # One row per account; total, ranking and prior rank all read it.
    named = settle(named, "account-weeks")
    sold = named.where("retailer_net_revenue IS NOT NULL")
    total = sold.agg(F.sum("retailer_net_revenue")).scalar()
    best = top_n(sold, [F.col("retailer_net_revenue").desc(), F.col("retailer_id")], k, "revenue_rank")
    moved = rank_within(best, named, "retailer_id", "prior_revenue", "prior_period_rank")
    return moved.select(
        this.alias("period_start_date"), F.date_sub(upto, 1).alias("period_end_date"), "retailer_id",
        "retailer_name", "region", "retail_segment", "retailer_net_revenue",
        pct("retailer_net_revenue", total, 18, 4).alias("pct_of_total_revenue"), "revenue_rank",
        "prior_period_rank", (F.col("prior_period_rank") - F.col("revenue_rank")).alias("rank_movement"))


def acquisition_cost(accounts: DataFrame, spend: DataFrame, as_of: str) -> DataFrame:
    """Spend per newly activated account of the prior month by (segment, region)."""
    first = months_back(as_of, 1)
    new = accounts.where(F.trunc("account_activation_date", "month") == first)
    paid = (spend.where(F.trunc("period_start_date", "month") == first).groupBy("retailer_id")
            .agg(F.sum("total_acquisition_cost_usd").alias("_spend")))
    kpi = (new.join(paid, "retailer_id", "left").groupBy("retail_segment", "region")
           .agg(F.count_distinct("retailer_id").alias("new_accounts_count"),
                F.coalesce(F.sum("_spend"), F.lit(0)).cast("decimal(18,4)").alias("total_acquisition_spend"))
           .withColumn("cac_usd", ratio("total_acquisition_spend", "new_accounts_count", 18, 4)))
    return kpi.withColumns({
        "period_month": F.date_format(first, "yyyy-MM"), "period_start_date": first,
        "period_end_date": F.last_day(first), "cac_warn_flag": _flag(F.col("cac_usd") > 3000),
        "cac_critical_flag": _flag(F.col("cac_usd") > 5000)})


def retention(sales: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Accounts active two months ago that were active last month too.

    One aggregate per account holds both activity flags; no set is built twice.
    """
    before, after, upto = months_back(as_of, 2), months_back(as_of, 1), months_back(as_of, 0)
    d = F.col("transaction_date")
    active = (sales.where((d >= before) & (d < upto)).groupBy("retailer_id")
              .agg(F.bool_or(d < after).alias("_prior"), F.bool_or(d >= after).alias("_kept")))
    kpi = (active.where("_prior").join(accounts.select("retailer_id", "region", "retail_segment"), "retailer_id")
           .groupBy("region", "retail_segment")
           .agg(F.count("*").alias("prior_period_active_count"), F.count_if("_kept").alias("retained_count")))
    kpi = kpi.withColumns({
        "period_month": F.date_format(after, "yyyy-MM"),
        "churned_count": F.col("prior_period_active_count") - F.col("retained_count"),
        "retention_rate_pct": pct("retained_count", "prior_period_active_count")})
    return kpi.withColumns({"retention_warn_flag": _flag(F.col("retention_rate_pct") < 85),
                            "retention_critical_flag": _flag(F.col("retention_rate_pct") < 75)})


def concentration(sales: DataFrame, returns: DataFrame, as_of: str) -> DataFrame:
    """Share of the five largest accounts and of the largest in the prior month."""
    first, upto = months_back(as_of, 1), months_back(as_of, 0)
    d = F.col("transaction_date")
    lines = net_sale_lines(sales.where((d >= first) & (d < upto)), returns, ["retailer_id"])
    by_account = lines.groupBy("retailer_id").agg(F.sum("net_revenue").cast("decimal(18,4)").alias("net"))
    by_account = settle(by_account, "account-month")
    total = by_account.agg(F.sum("net").cast("decimal(18,4)")).scalar()
    top = top_n(by_account, [F.col("net").desc(), F.col("retailer_id")], 5, "_rank")
    kpi = top.agg(F.sum("net").cast("decimal(18,4)").alias("top5_net_revenue"),
                  F.min_by("retailer_id", "_rank").alias("top1_retailer_id"),
                  F.max(F.when(F.col("_rank") == 1, F.col("net"))).alias("_top1"))
    kpi = kpi.withColumns({
        "period_month": F.date_format(first, "yyyy-MM"), "total_net_revenue": total,
        "top5_concentration_pct": pct("top5_net_revenue", total), "top1_revenue_pct": pct("_top1", total)})
    return kpi.drop("_top1").withColumns({
        "concentration_warn_flag": _flag(F.col("top5_concentration_pct") > 30),
        "concentration_critical_flag": _flag((F.col("top5_concentration_pct") > 40)
                                             | (F.col("top1_revenue_pct") > 15))})
