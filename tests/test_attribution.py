"""First click and click counts: hand cases and brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickledger.operators.click_counts import clicks_in_window
from clickledger.operators.first_click import first_click_attribution
from clickledger.operators.interval_join import attribution_pairs


def credited(df):
    return {r.checkout_id: r.attributed_click_id for r in df.collect()}


def test_earliest_click_wins(make_clicks, make_checkouts):
    clicks = make_clicks(
        ("c1", "u", "2024-01-01 10:30:00"),
        ("c2", "u", "2024-01-01 10:27:00"),
        ("c3", "v", "2024-01-01 10:20:00"),
    )
    checkouts = make_checkouts(("k", "u", "2024-01-01 10:40:00", "9.99"))
    assert credited(first_click_attribution(clicks, checkouts)) == {"k": "c2"}


def test_equal_times_go_to_the_lower_id_as_text(make_clicks, make_checkouts):
    at = "2024-01-01 10:30:00"
    clicks = make_clicks(("9", "u", at), ("10", "u", at), ("11", "u", at))
    checkouts = make_checkouts(("k", "u", "2024-01-01 10:40:00", "1"), ("m", "u", at, "1"))
    assert credited(first_click_attribution(clicks, checkouts)) == {"k": "10", "m": "10"}


@pytest.mark.parametrize(
    "at, inside",
    [
        ("2024-01-01 09:00:00", True),
        ("2024-01-01 10:00:00", True),
        ("2024-01-01 10:00:00.000001", False),
        ("2024-01-01 08:59:59.999999", False),
    ],
)
def test_both_bounds_are_included(make_clicks, make_checkouts, at, inside):
    clicks = make_clicks(("c", "u", at))
    checkouts = make_checkouts(("k", "u", "2024-01-01 10:00:00", "1"))
    expected = 1 if inside else 0
    assert first_click_attribution(clicks, checkouts).count() == expected
    assert clicks_in_window(clicks, checkouts).count() == expected
    assert attribution_pairs(clicks, checkouts).count() == expected


def test_seconds_truncate_each_side_first(make_clicks, make_checkouts):
    clicks = make_clicks(("c", "u", "2024-01-01 10:00:00.9"))
    checkouts = make_checkouts(("k", "u", "2024-01-01 10:00:02.1", "1"))
    row = first_click_attribution(clicks, checkouts).first()
    assert row.attribution_window_seconds == 2


def test_a_click_may_serve_two_checkouts_and_a_checkout_may_have_none(
    make_clicks, make_checkouts
):
    clicks = make_clicks(("c", "u", "2024-01-01 10:00:00"))
    checkouts = make_checkouts(
        ("k1", "u", "2024-01-01 10:10:00", "1"),
        ("k2", "u", "2024-01-01 10:20:00", "1"),
        ("k3", "u", "2024-01-01 12:00:00", "1"),
        ("k4", "w", "2024-01-01 10:10:00", "1"),
    )
    result = first_click_attribution(clicks, checkouts)
    assert credited(result) == {"k1": "c", "k2": "c"}


def test_repeated_deliveries_and_nulls(make_clicks, make_checkouts):
    clicks = make_clicks(
        ("c", "u", "2024-01-01 10:00:00"),
        ("c", "u", "2024-01-01 10:00:00"),
        ("x", None, "2024-01-01 10:00:00"),
        ("y", "u", None),
    )
    checkouts = make_checkouts(
        ("k", "u", "2024-01-01 10:10:00", "1"),
        ("k", "u", "2024-01-01 10:10:00", "1"),
        ("n", None, "2024-01-01 10:10:00", "1"),
        ("z", "u", None, "1"),
    )
    assert credited(first_click_attribution(clicks, checkouts)) == {"k": "c"}
    # Two copies of the click for each of two copies of the checkout, as a join would count them.
    counts = clicks_in_window(clicks, checkouts).collect()
    assert [(r.checkout_id, r.total_clicks_in_window) for r in counts] == [("k", 4)]


def _random_feeds(seed: int):
    """Coarse times make ties, window edges and busy slots common; user a has most of the rows."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def events(prefix: str, n: int):
        return [
            (
                f"{prefix}{i}",
                rng.choice("aaab"),
                start + timedelta(seconds=rng.randrange(0, 900, rng.choice([1, 30]))),
            )
            for i in range(n)
        ]

    return events("c", 120), events("k", 80)


@pytest.mark.parametrize("seed, window", [(1, 60), (2, 61), (3, 300), (4, 3600)])
def test_brute_force(make_clicks, make_checkouts, seed, window):
    clicks, checkouts = _random_feeds(seed)
    span = timedelta(seconds=window)
    found = {
        (k, at): sorted((t, c) for c, v, t in clicks if v == user and at - span <= t <= at)
        for k, user, at in checkouts
    }
    click_df = make_clicks(*[(c, u, str(t)) for c, u, t in clicks])
    checkout_df = make_checkouts(*[(k, u, str(t), "1.50") for k, u, t in checkouts])
    first = first_click_attribution(click_df, checkout_df, span).collect()
    assert {r.checkout_id: (r.first_click_timestamp, r.attributed_click_id) for r in first} == {
        k: pairs[0] for (k, _), pairs in found.items() if pairs
    }
    assert all(0 <= r.attribution_window_seconds <= window for r in first)
    counts = clicks_in_window(click_df, checkout_df, span).collect()
    assert {r.checkout_id: r.total_clicks_in_window for r in counts} == {
        k: len(pairs) for (k, _), pairs in found.items() if pairs
    }
    joined = attribution_pairs(click_df, checkout_df, span).collect()
    assert sorted((r.checkout_event_id, r.click_event_id) for r in joined) == sorted(
        (k, c) for (k, _), pairs in found.items() for _, c in pairs
    )


def test_since_prunes_without_changing_rows(make_clicks, make_checkouts):
    clicks, checkouts = _random_feeds(5)
    click_df = make_clicks(*[(c, u, str(t)) for c, u, t in clicks])
    checkout_df = make_checkouts(*[(k, u, str(t), "1") for k, u, t in checkouts])
    since = F.lit(datetime(2024, 1, 1, 0, 6))
    window = timedelta(minutes=5)
    whole = first_click_attribution(click_df, checkout_df, window)
    kept = whole.where(F.col("checkout_timestamp") >= since)
    pruned = first_click_attribution(click_df, checkout_df, window, since=since)
    assert sorted(pruned.collect()) == sorted(kept.collect())


def test_windows_are_whole_seconds(make_clicks, make_checkouts):
    clicks, checkouts = make_clicks(("c", "u", None)), make_checkouts(("k", "u", None, "1"))
    for window in (timedelta(0), timedelta(milliseconds=1500), timedelta(seconds=-5)):
        with pytest.raises(ValueError):
            first_click_attribution(clicks, checkouts, window)
