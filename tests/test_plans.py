"""The shape of the queries' plans: no cross joins, pruned scans, filters at the scan, few shuffles."""

import re

import pytest

from tickloom.operators import grid
from tickloom.plans import catalogue
from tickloom.sources import mapping as m

SF = "/root/testdata/sf0.001"
#: A one-row table (the archive's last day) is joined to a plan.
ONE_ROW = {"archive_edge"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_cross_joins_and_no_row_udfs(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text
    assert name in ONE_ROW or "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned_and_filtered(spark):
    text = plan(m.trades(spark, SF).select("exchange", "seq"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert "value" not in read and "props" not in read and "ts:" not in read
    assert "PushedFilters: [In(event_type" in text or "PushedFilters: [Or(" in text


def test_shuffles_are_few(spark):
    most = {"market_aggregate_1h": 9, "book_metrics": 2, "trade_dedup_report": 2, "book_final_state": 1, "trade_continuity": 4, "vwap_by_symbol": 1, "silence_gaps": 3, "tx_match_roles": 2}
    for name, n in most.items():
        assert plan(catalogue.QUERIES[name](spark, SF)).count("Exchange hashpartitioning") <= n, name


def test_watched_keys_are_joined_before_they_are_grouped(spark):
    """One broadcast join over the exploded keys, below the aggregate: only matches are shuffled."""
    text = plan(catalogue.QUERIES["tx_match_roles"](spark, SF))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    assert text.index("keys=[signature") < text.index("BroadcastHashJoin") and text.count("FileScan") == 1


def test_no_window_over_a_whole_instrument(spark):
    """Raw rows are windowed in blocks; a window by instrument alone sees a row for each block."""
    names = ("trade_continuity", "silence_gaps", "silence_stats", "possible_dropped_estimate", "trailing_rate", "wire_regressions", "late_events_count", "holdback_membership")
    names += ("book_seq_gaps", "book_dense_gaps", "connection_gaps", "tx_order_check", "dataset_stats", "event_sync_snapshots", "slot_verdicts")
    own = {"slot_verdicts": ("slot", "bank_id", "_w")}
    for name in names:
        text = plan(catalogue.QUERIES[name](spark, SF))
        for order in re.findall(r"windowspecdefinition\(([^)]*)\)", text):
            assert "_block" in order or any(order.startswith(c) for c in own.get(name, ())), (name, order)


def test_short_periods_go_in_blocks(spark):
    """A grid of 100 ms has more rows a key than one window should order."""
    quotes = m.quotes(spark, SF)
    for period, blocks in ((100_000, True), (3_600_000_000, False)):
        text = plan(grid.market_aggregate(quotes, quotes, m.trades(spark, SF), m.liquidations(spark, SF), m.funding(spark, SF), m.open_interest(spark, SF), period))
        orders = re.findall(r"windowspecdefinition\(([^)]*)\)", text)
        assert orders and all(("_block" in order) == blocks for order in orders)
