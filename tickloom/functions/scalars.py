"""Column functions: symbols, times, sides, prices, order ids. All JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quotes of pairs written without a separator, in the order in which they are tried.
KNOWN_QUOTES = ("USDT", "USDC", "BUSD", "TUSD", "FDUSD", "USDD", "USD", "BTC", "ETH", "EUR", "GBP", "DAI", "BNB")

# How each venue writes a pair: form, separator, lower case or not.
CODECS: dict[str, tuple[str, str, bool]] = {
    "binance": ("joined", "", True),
    "bybit": ("joined", "", False),
    "bitget": ("joined", "", False),
    "htx": ("joined", "", True),
    "coinbase": ("parted", "-", False),
    "okx": ("parted", "-", False),
    "kucoin": ("parted", "-", False),
    "kraken": ("parted", "/", False),
    "gateio": ("parted", "_", False),
    "poloniex": ("parted", "_", False),
    "bitso": ("parted", "_", True),
    "upbit": ("reversed", "-", False),
    "hyperliquid": ("coin", "", False),
    "solana": ("address", "", False),
}


def asset(name: Column) -> Column:
    """Trimmed and upper case; a venue prefix before a colon keeps its lower case."""
    name = F.trim(name)
    at = F.instr(name, ":")
    prefixed = F.concat(F.lower(F.substring_index(name, ":", 1)), F.lit(":"), F.upper(F.substr(name, at + 1)))
    return F.when((at > 1) & (at < F.length(name)), prefixed).otherwise(F.upper(name))


def _pair(base: Column, quote: Column, named=asset) -> Column:
    """BASE/QUOTE, or null if a side is missing."""
    return F.when((F.length(F.trim(base)) > 0) & (F.length(F.trim(quote)) > 0), F.concat(named(base), F.lit("/"), named(quote)))


def _upper(name: Column) -> Column:
    return F.upper(F.trim(name))


def _parted(raw: Column, mark: str, named=_upper, turned: bool = False) -> Column:
    """Split at the first mark."""
    at = F.instr(raw, mark)
    left, right = F.substr(raw, F.lit(1), at - 1), F.substr(raw, at + 1)
    return F.when(at > 0, _pair(right, left, named) if turned else _pair(left, right, named))


def canonical(raw: Column) -> Column:
    """A pair written BASE/QUOTE."""
    return _parted(raw, "/", asset)


def joined(raw: Column) -> Column:
    """A pair without a separator: the longest known quote that ends it and leaves a base."""
    up = F.upper(raw)
    pattern = f"^(.+?)({'|'.join(KNOWN_QUOTES)})$"
    return F.when(up.rlike(pattern), F.regexp_replace(up, pattern, "$1/$2"))


def bare_coin(raw: Column) -> Column:
    coin = F.trim(raw)
    return F.when((F.length(coin) > 0) & ~coin.rlike("[:@/_-]"), F.concat(F.upper(coin), F.lit("/USDC")))


def lenient(raw: Column) -> Column:
    """A pair in any of three spellings: with a slash, with a hyphen, joined."""
    return F.coalesce(canonical(raw), _parted(raw, "-"), joined(raw))


def _by_spelling(exchange: Column, spell: Callable[..., Column | None]) -> Column:
    """One expression for each spelling, whatever the number of venues that share it."""
    venues: dict[tuple, list[str]] = {}
    for venue, codec in CODECS.items():
        venues.setdefault(codec, []).append(venue)
    out = F.lit(None).cast("string")
    for codec, own in venues.items():
        text = spell(*codec)
        out = out if text is None else F.when(exchange.isin(own), text).otherwise(out)
    return out


def decode_symbol(raw: Column, exchange: Column) -> Column:
    """A venue's symbol as BASE/QUOTE; null where it is none (or an address)."""
    raw = F.trim(raw)

    def spell(form: str, mark: str, low: bool) -> Column | None:
        if form == "joined":
            return joined(raw)
        if form == "parted":
            return canonical(raw) if mark == "/" else _parted(raw, mark)
        if form == "reversed":
            return _parted(raw, mark, turned=True)
        return bare_coin(raw) if form == "coin" else None

    return _by_spelling(exchange, spell)


def base(pair: Column) -> Column:
    return F.substring_index(pair, "/", 1)


def quote(pair: Column) -> Column:
    return F.substring_index(pair, "/", -1)


def encode_symbol(pair: Column, exchange: Column) -> Column:
    """BASE/QUOTE as the venue writes it."""

    def spell(form: str, mark: str, low: bool) -> Column:
        if form in ("coin", "address"):
            text = base(pair) if form == "coin" else pair
        else:
            text = F.concat_ws(mark, *((quote(pair), base(pair)) if form == "reversed" else (base(pair), quote(pair))))
        return F.lower(text) if low else text

    return _by_spelling(exchange, spell)


def wire_symbol(pair: Column, exchange: Column) -> Column:
    """BASE/QUOTE as a venue's live feed writes it: as ``encode_symbol``, but binance's is upper case."""
    text = encode_symbol(pair, exchange)
    return F.when(exchange == "binance", F.upper(text)).otherwise(text)


def wire_pair(raw: Column, exchange: Column) -> Column:
    """A live feed's symbol as BASE/QUOTE: as ``decode_symbol``, but a coin of a named dex (``dex:ticker``) is one too."""
    coin = F.trim(raw)
    named = coin.rlike("^[0-9A-Za-z]+:[0-9A-Za-z]+$")
    return F.when((exchange == "hyperliquid") & named, F.concat(asset(coin), F.lit("/USDC"))).otherwise(decode_symbol(raw, exchange))


def normalized(pair: Column) -> Column:
    return F.lower(F.concat(base(pair), quote(pair)))


def file_symbol(pair: Column) -> Column:
    return F.translate(pair, "/:", "-_")


def instrument_kind(name: Column) -> Column:
    return F.when(F.instr(name, "/") > 0, "pair").otherwise("address")


def epoch_to_us(t: Column) -> Column:
    """Epoch numbers of any unit, told apart by size."""
    t = t.cast("long")
    return F.when(t >= 10**17, div(t, 1000)).when(t >= 10**14, t).when(t >= 10**11, t * 1000).otherwise(t * 1000000)


def div(a: Column, b: int | Column) -> Column:
    """Integer division of longs, exact beyond 2**53."""
    return F.call_function("div", a, F.lit(b).cast("long") if isinstance(b, int) else b)


def saturating_since(a: Column, b: Column) -> Column:
    return F.greatest(a - b, F.lit(0).cast("long"))


def effective(*times: Column) -> Column:
    """The first positive time, else 0."""
    return F.coalesce(*(F.when(t > 0, t) for t in times), F.lit(0).cast("long"))


def trade_side(raw: Column) -> Column:
    """buy or sell; anything else is null, never guessed."""
    low = F.lower(raw)
    return F.when(low.isin("buy", "sell"), low)


def book_side(raw: Column) -> Column:
    low = F.lower(raw)
    return F.when(low.isin("bid", "bids", "buy"), "bid").when(low.isin("ask", "asks", "sell", "offer"), "ask")


def decimal(raw: Column) -> Column:
    """An exact decimal, or null for what is none."""
    return raw.try_cast("decimal(38,18)")


def mid_price(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    mid = mid_price(bid, ask)
    return F.when(mid > 0, (ask - bid) / mid * 10000)


def row_of(ts_us: Column, period_us: int) -> Column:
    """The grid row that closes the period of a time."""
    return div(ts_us, period_us) + 1


def floor_div(a: Column, b: int) -> Column:
    """As ``div``, but rounded down."""
    return div(a, b) - (a % b < 0).cast("long")


def day_named(days: Column) -> Column:
    """The day of a number of days since 1970, beyond dates and timestamps too: the calendar repeats after 400 years, and a day is found within these."""
    date = F.date_from_unix_date(F.pmod(days, F.lit(146_097)).cast("int"))
    year = F.year(date) + floor_div(days, 146_097) * 400
    text = year.cast("string")
    return F.concat(F.when(year.between(0, 999), F.lpad(text, 4, "0")).otherwise(text), F.substring(date.cast("string"), 5, 6))


def day_of(ts_us: Column) -> Column:
    """The UTC day."""
    return day_named(floor_div(ts_us, 86_400_000_000))


def order_id(side: Column, kind: Column, ts_us: Column) -> Column:
    """Side in bit 63 (ask 1), type in bit 62 (limit 1), 60 bits of time above two free ones."""
    time = F.shiftleft(ts_us.bitwiseAND(F.lit((1 << 60) - 1)), 2)
    side_bit = F.when(side == "ask", F.lit(-(1 << 63))).otherwise(F.lit(0).cast("long"))
    kind_bit = F.when(kind == "limit", F.lit(1 << 62)).otherwise(F.lit(0).cast("long"))
    return time.bitwiseOR(side_bit).bitwiseOR(kind_bit)


def order_id_side(oid: Column) -> Column:
    return F.when(oid < 0, "ask").otherwise("bid")


def order_id_kind(oid: Column) -> Column:
    return F.when(F.shiftrightunsigned(oid, 62).bitwiseAND(F.lit(1).cast("long")) == 1, "limit").otherwise("market")


def order_id_time(oid: Column) -> Column:
    return F.shiftrightunsigned(oid, 2).bitwiseAND(F.lit((1 << 60) - 1))


def blocks_lost(previous: Column, height: Column) -> Column:
    return saturating_since(height - 1, previous)


def possible_dropped(per_minute: Column, window_us: Column) -> Column:
    """Prints that a silence may have cost, from the rate before it."""
    return F.ceil(per_minute / 60.0 * (window_us / 1e6)).cast("long")


def human_bytes(n: Column) -> Column:
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in ((1, "KiB"), (2, "MiB"), (3, "GiB"), (4, "TiB")):
        size = 1024.0**power
        out = F.when(n >= size, F.concat(F.format_number(n / size, 1), F.lit(f" {unit}"))).otherwise(out)
    return out


# Latency histogram bounds in milliseconds.
LATENCY_BUCKETS_MS = (0.5, 1.0, 2.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2000.0)


def latency_bucket(ms: Column) -> Column:
    """The least bound that holds the value; null above all of them."""
    out = F.lit(None).cast("double")
    for bound in reversed(LATENCY_BUCKETS_MS):
        out = F.when(ms <= bound, bound).otherwise(out)
    return out


def role_rank(role: Column) -> Column:
    return F.when(role == "fee_payer", 2).when(role == "signer", 1).when(role == "account_key", 0)
