from datetime import date, timedelta

import pytest

from shopspan.operators import household_state as hs
from shopspan.operators.features import REGION
from shopspan.sources.staging import new_staging_path

START = date(2001, 1, 6)
SCHEMA = f"hhn bigint, week_ending_date date, n_transaction bigint, {REGION} string"


def _week(k):
    return START + timedelta(weeks=k)


def _rows(spark, n_weeks=12):
    rows = [
        (h, _week(k), (h + k) % 3, "north" if k < 7 else "south")
        for h in range(1, 40) for k in range(n_weeks) if (h * 7 + k * 5) % 4 and not (h == 5 and k > 1) and not (h == 6 and k < 9)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _found(state):
    return sorted((r.hhn, tuple(r.weeks), tuple(r.events), r[REGION]) for r in state.collect())


def test_weekly_moves_equal_the_full_build(spark):
    rows, path = _rows(spark), new_staging_path(spark, "state")
    for k in range(3, 12):
        hs.advance_stored(path, rows, _week(k), 5)
        assert _found(hs.stored_state(path, spark, _week(k))) == _found(hs.build_state(rows, _week(k), 5))
    households = {r.hhn for r in hs.stored_state(path, spark, _week(11)).collect()}
    assert 5 not in households and 6 in households  # one has left the window, one came in


def test_a_move_reads_one_week(spark):
    """Rows of other weeks, though wrong, change nothing."""
    rows, path = _rows(spark), new_staging_path(spark, "state")
    hs.advance_stored(path, rows, _week(8), 5)
    want = _found(hs.build_state(rows, _week(9), 5))
    hs.advance_stored(path, rows.where(rows.week_ending_date == _week(9)), _week(9), 5)
    assert _found(hs.stored_state(path, spark, _week(9))) == want


def test_a_week_may_be_run_again_with_corrected_rows(spark):
    rows, path = _rows(spark), new_staging_path(spark, "state")
    hs.advance_stored(path, rows, _week(8), 5)
    hs.advance_stored(path, rows, _week(9), 5)
    corrected = rows.where((rows.week_ending_date != _week(9)) | (rows.hhn % 2 == 0))
    hs.advance_stored(path, corrected, _week(9), 5)
    assert _found(hs.stored_state(path, spark, _week(9))) == _found(hs.build_state(corrected, _week(9), 5))


def test_gaps_and_other_windows_are_built_in_full(spark):
    rows, path = _rows(spark), new_staging_path(spark, "state")
    hs.advance_stored(path, rows, _week(5), 5)
    hs.advance_stored(path, rows, _week(8), 5)
    assert _found(hs.stored_state(path, spark, _week(8))) == _found(hs.build_state(rows, _week(8), 5))
    hs.advance_stored(path, rows, _week(9), 7)
    assert _found(hs.stored_state(path, spark, _week(9))) == _found(hs.build_state(rows, _week(9), 7))


@pytest.mark.parametrize("moves", [0, 1])
def test_no_rows_give_an_empty_state(spark, moves):
    path = new_staging_path(spark, "state")
    for k in range(moves + 1):
        hs.advance_stored(path, _rows(spark).limit(0), _week(k), 5)
    assert hs.build_state(_rows(spark).limit(0), _week(3), 5).count() == 0


def test_segments_of_a_household_that_never_bought(spark):
    rows = spark.createDataFrame([(1, _week(0), 0, "north"), (2, _week(0), 2, None), (2, _week(2), 0, "west")], SCHEMA)
    lookup = spark.createDataFrame([(1, "north"), (2, "south")], f"div_reg_index int, {REGION} string")
    got = {r.hhn: r for r in hs.state_segments(hs.build_state(rows, _week(2), 5), _week(2), lookup, "south").collect()}
    assert (got[1].recency, got[1].n_events, got[1].n_steps, got[1].region_id) == (None, 0, 3, 1)
    assert (got[2].recency, got[2].n_events, got[2].n_steps, got[2].region_id, got[2].recency_bin) == (2, 1, 3, 2, 1)
