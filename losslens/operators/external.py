"""External-dataset operators (P15-P19, A14-A16, M18): preprocessing,
canonical base, group metrics, account features and targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.functions import exprs as X
from losslens.operators.ordered import group_quantiles
from losslens.session import cut_lineage, stored

# fixed values: loss candidates in priority order, date columns
LOSS_CANDIDATES = ["total_loss", "gross_financial_loss", "Gross Financial Loss",
                   "gross_financial_loss_amt", "total_return_cogs", "Total Return COGS",
                   "gross_financial_loss_total", "Gross Profit", "Product Cost", "CreditReturn Sales",
                   "Credit Return Sales"]
DATE_COLS = ["Booked Date", "Billed Date", "Reference Booked Date", "Prev_Return_Date"]


def q(c: str):
    return F.col(f"`{c}`")


def load_lines(df: DataFrame, account: str = "Bill To Act #") -> DataFrame:
    """Parse the date columns (coerce), drop rows without an account."""
    cols = [F.try_to_timestamp(q(c).cast("string")).alias(c) if c in DATE_COLS and
            dict(df.dtypes)[c] == "string" else q(c) for c in df.columns]
    return df.select(*cols).where(q(account).isNotNull())


def preprocess(df: DataFrame, returns_col: str = "Returns") -> DataFrame:
    """Returns flag coerced from text, else inferred from a negative
    billed / ordered qty or credit sales; total_loss = |first available
    loss candidate|; rows without a loss dropped."""
    if returns_col in df.columns:
        flag = X.coerce_bool(returns_col)
    else:
        flag = reduce(lambda a, b: a | b, [
            F.coalesce(q(c).try_cast("double") < 0, F.lit(False))
            for c in ("Billed Qty", "Ordered Qty", "CreditReturn Sales") if c in df.columns], F.lit(False))
    cand = next((c for c in LOSS_CANDIDATES if c in df.columns), None)
    loss = F.abs(q(cand).try_cast("double")) if cand else F.lit(None).cast("double")
    out = df.withColumn("Returns", flag).withColumn("total_loss", loss)
    return out.dropna(subset=["total_loss"])


def category_label(pillar: str = "Pillar", market: str = "Major Market Cat", dept: str = "Department"):
    """P17: 'Pillar-Market-Department', missing parts -> 'Unknown'."""
    part = lambda c: F.trim(F.coalesce(q(c).cast("string"), F.lit("Unknown")))
    return F.concat_ws("-", part(pillar), part(market), part(dept))


def canonical_base(df: DataFrame) -> DataFrame:
    """(is_returned_item, profit_erosion = |loss|, category)."""
    return df.select(q("Returns").cast("int").alias("is_returned_item"),
                     F.abs("total_loss").alias("profit_erosion"), category_label().alias("category"))


def group_metrics(base: DataFrame, group: str = "category") -> DataFrame:
    """Erosion on returned lines LEFT JOIN the return rate on all lines
    (groups without returns drop out; empty returned set -> zeros)."""
    rr = base.groupBy(group).agg(F.avg("is_returned_item").alias("return_rate"))
    ret = base.where(F.col("is_returned_item") == 1)
    ero = ret.groupBy(group).agg(F.sum("profit_erosion").alias("total_profit_erosion"),
                                 F.count("profit_erosion").alias("returned_items"),
                                 F.avg("profit_erosion").alias("mean_profit_erosion_per_return"))
    return ero.join(rr, [group], "left").withColumn("avg_profit_erosion",
                                                    F.col("mean_profit_erosion_per_return"))


def account_features(df: DataFrame, account: str = "Bill To Act #") -> DataFrame:
    """Twelve account measures (two-level aggregation for the order
    mean, item price with a two-step fallback, tenure = date span, recency
    to the data's last date)."""
    is_ret = (q("Sales_Type") == "RETURN") if "Sales_Type" in df.columns else F.lit(True)
    qty = F.abs(q("Ordered Qty"))
    has_qty = qty > 0
    ref = q("Reference Sale Amount")
    has_ref = ref.isNotNull() & (ref > 0)
    price = F.when(has_qty & has_ref, ref / qty).when(is_ret & has_qty, F.abs(q("CreditReturn Sales")) / qty)
    d = df.select(q(account).alias("account_id"), q("Order Number").alias("_order"),
                  q("Order Line ID").alias("_line"), q("Booked Date").alias("_date"),
                  is_ret.cast("int").alias("_ret"), q("Lines Per Order").alias("_lpo"),
                  ref.alias("_ref"), q("gross_financial_loss").alias("_gfl"), price.alias("_price"),
                  q("total_loss").alias("_loss"))
    d = stored(d, "account-lines")  # ten narrow columns, read by three aggregates
    orders = d.groupBy("account_id", "_order").agg(F.sum("_ref").alias("_order_ref"))
    aov = orders.groupBy("account_id").agg(F.avg("_order_ref").alias("avg_order_value"),
                                           F.count("_order").alias("order_frequency"))
    mx = d.agg(F.max("_date").alias("_maxd"))
    acc = d.groupBy("account_id").agg(
        F.sum("_ret").cast("long").alias("return_frequency"),
        F.avg("_lpo").alias("avg_basket_size"), F.count("_line").alias("total_items"),
        F.sum("_ref").alias("total_sales"), F.sum("_gfl").alias("total_margin"),
        F.avg("_price").alias("avg_item_price"), F.avg("_gfl").alias("avg_item_margin"),
        F.min("_date").alias("_min"), F.max("_date").alias("_max"), F.sum("_loss").alias("total_loss"))
    acc = acc.crossJoin(mx).join(aov, ["account_id"], "left")  # mx: one row
    # one row an account, read several times; the lines' shuffles are made once
    return cut_lineage(acc.select(
        "account_id", "order_frequency", "return_frequency", "avg_basket_size", "total_items",
        "total_sales", "total_margin", "avg_item_price", "avg_item_margin", "total_loss",
        (F.col("return_frequency") / F.col("total_items")).alias("customer_return_rate"),
        X.day_floor_diff("_max", "_min").alias("customer_tenure_days"),
        X.day_floor_diff("_maxd", "_max").alias("purchase_recency_days"), "avg_order_value"))


def targets(accounts: DataFrame, value: str = "total_loss", p: float = 0.75) -> DataFrame:
    """External label ``>=`` P75 (the primary set uses ``>``)."""
    thr = group_quantiles(accounts, [], [("_thr", value, p)])
    return accounts.crossJoin(F.broadcast(thr)).withColumn(
        "is_high_erosion_customer", F.coalesce(F.col(value) >= F.col("_thr"), F.lit(False)).cast("int")
    ).drop("_thr")


def regression_features(accounts: DataFrame, features, fill: str = "zero") -> DataFrame:
    """P18 / P19 (D8 decided): missing features are created; ``fill='zero'``
    (v1) or ``'median'`` (v2, exact column medians; a missing column still 0)."""
    out = accounts
    present = [c for c in features if c in accounts.columns]
    for c in features:
        if c not in accounts.columns:
            out = out.withColumn(c, F.lit(0.0))
    if fill == "median" and present:
        types = dict(accounts.dtypes)
        med = group_quantiles(accounts, [], [(f"_m_{c}", c, 0.5) for c in present])
        # integral columns stay integral (pandas fills float columns only;
        # an int column cannot hold NaN there): rounded median
        fillv = {c: (F.col(f"_m_{c}") if types[c] in ("double", "float")
                     else F.rint(F.col(f"_m_{c}")).cast(types[c])) for c in present}
        out = out.crossJoin(F.broadcast(med)).withColumns(
            {c: F.coalesce(F.col(c), fillv[c]) for c in present}
        ).drop(*[f"_m_{c}" for c in present])
    else:
        out = out.fillna(0.0, subset=[c for c in present])
    return out.withColumnRenamed("total_loss", "total_profit_erosion") if "total_loss" in out.columns \
        else out
