import pytest

from tickbars.operators.facts import FACTS, company_snapshot, latest_statement, news_head
from tickbars.sources.facts import read_facts


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "news.csv"
    path.write_text(
        "title,summary,url,score\n"
        'One,"a, ""quoted"" word",u1,1.5\n'
        'Two,"two\nlines",u2,2\n'
        "Three,,u3,\n"
    )
    rows = read_facts(spark, str(path)).orderBy("url").collect()
    assert [r.summary for r in rows] == ['a, "quoted" word', "two\nlines", None]
    assert [r.score for r in rows] == [1.5, 2.0, None]


def test_snapshot_takes_the_newest_statement_of_each_ticker(spark):
    facts = spark.createDataFrame(
        [("A", *[10.0] * len(FACTS)), ("B", *[0.0] * len(FACTS))],
        ", ".join(["ticker string", *[f"{name} double" for name in FACTS]]),
    )
    balance = spark.createDataFrame(
        [("A", "2024-09-30", 1.0, 2.0, 3.0), ("A", "2025-09-30", 4.0, None, 6.0)],
        "ticker string, date string, `Total Assets` double, `Total Debt` double, "
        "`Cash And Cash Equivalents` double",
    )
    cashflow = spark.createDataFrame(
        [("A", "2025-09-30", 7.0, 8.0, -9.0), ("A", "2021-09-30", 1.0, 1.0, -1.0)],
        "ticker string, date string, `Operating Cash Flow` double, `Free Cash Flow` double, "
        "`Capital Expenditure` double",
    )
    rows = {
        r.ticker: r
        for r in company_snapshot(facts, balance, cashflow, ["date"], ["date"]).collect()
    }
    a, b = rows["A"], rows["B"]
    # A missing value of the newest statement is not filled from an older one.
    assert (a.total_assets, a.total_debt, a.cash) == (4.0, None, 6.0)
    assert (a.operating_cash_flow, a.free_cash_flow, a.capital_expenditure) == (7.0, 8.0, 9.0)
    assert (a.price_change, a.price_change_pct, a.upside) == (0.0, 0.0, 0.0)
    assert (b.total_assets, b.price_change_pct, b.upside) == (None, None, None)


@pytest.mark.parametrize("order", [["date"], ["date", "total"]])
def test_latest_statement(spark, order):
    frame = spark.createDataFrame(
        [("A", 1, 5.0), ("A", 2, 3.0), ("B", 1, 9.0)], "ticker string, date int, total double"
    )
    for columns in ({"t": "total"}, {"t": "total", "d": "date"}):
        rows = latest_statement(frame, order, columns).collect()
        assert {r.ticker: r.t for r in rows} == {"A": 3.0, "B": 9.0}


def test_news_head(spark):
    assert [r.id for r in news_head(spark.range(100), "id").collect()] == list(range(10))
