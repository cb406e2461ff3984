"""Declarations of a collection job and their admission checks; durations, labels, retry arithmetic."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

from tickloom.functions.scalars import CODECS

# Datatypes and market types that a job may declare.
DATATYPES = ("orderbooks", "trades", "liquidations", "funding_rates", "funding_settlements", "open_interests", "transactions")
MARKETS = ("spot", "linear", "inverse", "chain")
#: What each venue offers beyond books and trades.
EXTRAS = {"bybit": ("liquidations", "funding_rates", "open_interests"), "hyperliquid": ("funding_rates", "funding_settlements", "open_interests"), "solana": ("transactions",)}
UNITS_NS = {"ns": 1, "us": 1_000, "µs": 1_000, "ms": 1_000_000, "s": 1_000_000_000, "m": 60_000_000_000, "h": 3_600_000_000_000}


def duration_us(text: str) -> int:
    """A duration such as 100ms or 1h in microseconds, rounded down."""
    found = re.fullmatch(r"(\d+)\s*(ns|us|µs|ms|s|m|h)", text.strip())
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return int(found[1]) * UNITS_NS[found[2]] // 1000


def mode_label(kind: str, detail: str | None = None) -> str:
    """The label of a worker's mode: ON_CLOCK(100MS), ON_EVENT(TRADE), ON_SLOT."""
    name = f"ON_{kind.upper()}"
    return f"{name}({detail.upper()})" if detail else name


@dataclass
class Job:
    exchange: str
    market: str
    symbols: tuple[str, ...]
    datatypes: tuple[str, ...]
    clock: str = "external"
    period: str = "100ms"
    depth: int | None = None
    hold: str = "0s"
    cadences: dict[str, str] = field(default_factory=dict)

    def offered(self) -> tuple[str, ...]:
        base = () if self.exchange == "solana" else ("orderbooks", "trades")
        return base + EXTRAS.get(self.exchange, ())

    def problems(self) -> list[str]:
        """Everything that keeps the job from being admitted."""
        out = []
        if self.exchange not in CODECS:
            out.append(f"unknown venue {self.exchange}")
        if self.market not in MARKETS:
            out.append(f"unknown market type {self.market}")
        if (self.market == "chain") != (self.exchange == "solana"):
            out.append(f"{self.exchange} has no {self.market} market")
        out += [f"unknown datatype {d}" for d in self.datatypes if d not in DATATYPES]
        out += [f"{self.exchange} has no {d}" for d in self.datatypes if d in DATATYPES and d not in self.offered()]
        if self.depth is not None and self.depth <= 0:
            out.append("depth must be positive")
        if self.exchange == "kraken" and self.depth not in (None, 10):
            out.append("kraken's checksum needs a depth of 10")
        if not self.symbols:
            out.append("no symbols")
        if self.clock not in ("orderbook", "trade", "liquidation", "external", "slot"):
            out.append(f"unknown clock {self.clock}")
        for text in (self.period, self.hold, *self.cadences.values()):
            try:
                duration_us(text)
            except ValueError as wrong:
                out.append(str(wrong))
        return out


def delay_ceiling(attempt: int, base: float = 0.25, most: float = 30.0) -> float:
    """Seconds that a retry waits at most: doubling, cut at ``most``."""
    return min(most, base * 2 ** min(attempt, 62))


def delay(attempt: int, seed: int, base: float = 0.25, most: float = 30.0) -> float:
    """Half of the ceiling, plus a random part of the other half."""
    top = delay_ceiling(attempt, base, most)
    return top / 2 + random.Random(seed * 1_000_003 + attempt).random() * top / 2
