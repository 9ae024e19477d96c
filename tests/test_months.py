from __future__ import annotations

from datetime import date, datetime

import pytest

from meterlake.functions.months import month_bounds, month_sequence, previous_month, window_dates


def test_window_crosses_the_year():
    assert month_sequence("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]


def test_previous_month_crosses_the_year():
    assert previous_month(date(2026, 1, 10)) == "2025-12"
    assert previous_month(date(2026, 3, 31)) == "2026-02"


def test_bounds_carry_december():
    assert month_bounds("2023-12") == (datetime(2023, 12, 1), datetime(2024, 1, 1))


def test_window_ends_on_the_last_day():
    assert window_dates("2023-01", "2024-02") == (date(2023, 1, 1), date(2024, 2, 29))


@pytest.mark.parametrize("start,end", [("2024-02", "2024-01"), ("2024-13", "2024-14"), ("2024", "2025")])
def test_bad_windows_are_errors(start, end):
    with pytest.raises(ValueError):
        month_sequence(start, end)
