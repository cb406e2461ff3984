"""Canonical tables: one fixed schema for each datatype, times in UTC epoch microseconds."""

from __future__ import annotations

from pyspark.sql.types import StructType

DECIMAL = "decimal(38,18)"

TRADES = "source_trade_ts_us long, symbol string, side string, price double, amount double, exchange string, id string, local_trade_ts_us long, source_trade_rtt_us long, origin string"
ORDERBOOKS = "orderbook_ts_us long, symbol string, exchange string, side string, level long, price double, size double, source_orderbook_ts_us long, local_orderbook_ts_us long, source_orderbook_rtt_us long"
BOOK_STATE = "timestamp_us long, symbol string, exchange string, side string, level long, price double, size double"
LIQUIDATIONS = "liquidation_ts_us long, symbol string, side string, price double, amount double, exchange string"
FUNDING_RATES = "funding_rate_ts_us long, symbol string, funding_rate double, next_funding_ts_us long, exchange string, local_funding_ts_us long, recv_seq long, conn_epoch_us long, premium double, interval_hours int"
FUNDING_SETTLEMENTS = "funding_time_us long, symbol string, funding_rate double, premium double, exchange string, local_ts_us long, rtt_us long"
OPEN_INTERESTS = "open_interest_ts_us long, symbol string, open_interest double, open_interest_value double, exchange string, local_oi_ts_us long, recv_seq long, conn_epoch_us long, mark_px double"
TRANSACTIONS = (
    "source_tx_ts_us long, address string, exchange string, match_role string, local_tx_ts_us long, source_tx_rtt_us long, recv_seq long, conn_epoch_us long, "
    "commitment string, slot long, block_height long, blockhash string, tx_index long, signature string, version string, success boolean, fee_lamports long, "
    "compute_units_consumed long, compute_unit_limit long, compute_unit_price_micro_lamports long, priority_fee_lamports long, cost_units long, "
    "signers array<string>, account_keys array<string>, log_messages array<string>, failure_error string, failure_instruction_index long, failure_program_id string, "
    "failure_instruction_error string, failure_instruction_data string, failure_log_program_id string, failure_log_message string"
)
MARKET_AGGREGATE = (
    "ts_us long, ob_mid_price double, ob_spread double, ob_imbalance double, trade_volume double, trade_vwap double, trade_count long, liq_notional double, liq_count long, "
    "liq_imbalance double, fr_rate double, fr_annualized double, fr_next_settlement_delta long, oi_contracts double, oi_value double, oi_change double, trade_notional double, "
    "trade_buy_volume double, trade_buy_notional double, trade_buy_count long, trade_sell_volume double, trade_sell_notional double, trade_sell_count long, trade_imbalance double, "
    "trade_px_first double, trade_px_last double"
)
LEAF_INDEX = "filename string, sha256 string, rows long, t_min_us long, t_max_us long, schema_id string, heartbeat boolean, symbol string, last_slot long, last_block_height long"
GAP_LEDGER = "opened_epoch_us long, closed_epoch_us long, window_us long, cause string, exchange string, symbol string, possible_dropped_trades long, prev_slot long, prev_height long, next_slot long, next_height long, blocks_lost long"
LEVELS = "array<struct<price:string,size:string>>"
BOOK_DELTAS = f"symbol string, bids {LEVELS}, asks {LEVELS}, update_id long, sequence long, source_orderbook_ts_us long, local_orderbook_ts_us long, source_orderbook_rtt_us long, checksum long, orders array<struct<order_id:string,is_ask:boolean,price:string,size:string,removed:boolean>>, is_snapshot boolean"

#: By datatype: schema, and what columns missing from older files hold.
TABLES: dict[str, tuple[str, dict[str, object]]] = {
    "trades": (TRADES, {"local_trade_ts_us": 0, "source_trade_rtt_us": 0, "origin": "ws"}),
    "orderbooks": (ORDERBOOKS, {"source_orderbook_ts_us": 0, "local_orderbook_ts_us": 0, "source_orderbook_rtt_us": 0}),
    "liquidations": (LIQUIDATIONS, {}),
    "funding_rates": (FUNDING_RATES, {"local_funding_ts_us": 0, "recv_seq": 0, "conn_epoch_us": 0, "premium": None, "interval_hours": 8}),
    "funding_settlements": (FUNDING_SETTLEMENTS, {}),
    "open_interests": (OPEN_INTERESTS, {"local_oi_ts_us": 0, "recv_seq": 0, "conn_epoch_us": 0, "mark_px": None}),
    "transactions": (TRANSACTIONS, {}),
    "market_aggregate": (MARKET_AGGREGATE, {}),
}

#: The column that orders a datatype in time, and the one that stands in where it is 0.
TIMES: dict[str, tuple[str, str | None]] = {
    "trades": ("source_trade_ts_us", "local_trade_ts_us"),
    "orderbooks": ("orderbook_ts_us", None),
    "liquidations": ("liquidation_ts_us", None),
    "funding_rates": ("funding_rate_ts_us", "local_funding_ts_us"),
    "funding_settlements": ("funding_time_us", None),
    "open_interests": ("open_interest_ts_us", "local_oi_ts_us"),
    "transactions": ("source_tx_ts_us", "local_tx_ts_us"),
    "market_aggregate": ("ts_us", None),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def schema_id(datatype: str) -> str:
    return f"{datatype}.v1"
