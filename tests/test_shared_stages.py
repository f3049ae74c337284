"""Queries that need one table twice build it once."""

import pytest

from shopspan.plans import queries


@pytest.mark.parametrize("name", ["score_closed_form", "feature_scores"])
def test_household_weeks_are_built_once(spark, monkeypatch, name):
    built = []
    original = queries._household_weeks
    monkeypatch.setattr(queries, "_household_weeks", lambda *a: built.append(a) or original(*a))
    assert queries.REGISTRY[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(built) == 1


@pytest.mark.parametrize("name", ["rolling_sales", "read_as_of", "table_history"])
def test_lines_and_orders_are_joined_once(spark, monkeypatch, name):
    """What the steps read is the stored lines, never the join of the star schema."""
    seen = []
    original = queries.staged

    def record(df, label):
        if label == "sales":
            seen.append(original(df, label))
            return seen[-1]
        return original(df, label)

    def only_stored(operator):
        def run(*args, **kwargs):
            sales = next(a for a in args if hasattr(a, "columns") and "merch_sales" in a.columns)
            assert seen and sales is seen[0]
            return operator(*args, **kwargs)
        return run

    monkeypatch.setattr(queries, "staged", record)
    monkeypatch.setattr(queries.gold, "annualized_sales", only_stored(queries.gold.annualized_sales))
    monkeypatch.setattr(queries.rolling, "advance_stored", only_stored(queries.rolling.advance_stored))
    assert queries.REGISTRY[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 1
