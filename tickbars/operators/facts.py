"""Company facts joined with the newest statement of each kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.functions.values import percent_of, price_change, target_upside
from tickbars.operators.latest import latest_row

# The facts a snapshot shows.
FACTS = [
    "currentPrice",
    "previousClose",
    "marketCap",
    "totalRevenue",
    "netIncomeToCommon",
    "trailingPE",
    "dividendYield",
    "beta",
    "profitMargins",
    "returnOnEquity",
    "grossMargins",
    "operatingMargins",
    "targetMeanPrice",
    "targetHighPrice",
    "targetLowPrice",
    "recommendationMean",
    "numberOfAnalystOpinions",
]


def latest_statement(statements: DataFrame, order: list[str], columns: dict[str, str]) -> DataFrame:
    """The newest statement of each ticker; ``columns`` maps new names to its columns."""
    return latest_row(
        statements, ["ticker"], order, {new: F.col(old) for new, old in columns.items()}
    )


def company_snapshot(
    facts: DataFrame,
    balance: DataFrame,
    cashflow: DataFrame,
    balance_order: list[str],
    cashflow_order: list[str],
) -> DataFrame:
    """Facts with price change and upside, newest balance and newest cash flow per ticker.

    Each statement is cut to one row per ticker first, and that aggregate is already
    partitioned by the join key.
    """
    newest_balance = latest_statement(
        balance,
        balance_order,
        {
            "total_assets": "Total Assets",
            "total_debt": "Total Debt",
            "cash": "Cash And Cash Equivalents",
        },
    )
    newest_cashflow = latest_statement(
        cashflow,
        cashflow_order,
        {
            "operating_cash_flow": "Operating Cash Flow",
            "free_cash_flow": "Free Cash Flow",
            "capital_expenditure": "Capital Expenditure",
        },
    ).withColumn("capital_expenditure", F.abs("capital_expenditure"))
    price, previous = F.col("currentPrice"), F.col("previousClose")
    change = price_change(price, previous)
    return (
        facts.select(
            "ticker",
            *FACTS,
            change.alias("price_change"),
            percent_of(change, previous).alias("price_change_pct"),
            target_upside(F.col("targetMeanPrice"), price).alias("upside"),
        )
        .join(newest_balance, "ticker", "left")
        .join(newest_cashflow, "ticker", "left")
    )


def news_head(news: DataFrame, order: str, count: int = 10) -> DataFrame:
    """The first ``count`` news rows by ``order``."""
    return news.orderBy(order).limit(count)
