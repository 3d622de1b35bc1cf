"""Arguments of the jobs. Every "today" is explicit, so a run can be repeated."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RemunerationParams:
    """Date range and terms of the purchase remuneration."""

    start: dt.date
    end: dt.date
    as_of: dt.date
    issuer: str | None = None
    exclude_issuer: str | None = None
    purpose: str = "purchase"
    currency: str = "BRL"
    due_days: int = 25
    settlement_days: int = 27
    share: float = 0.6

    @property
    def log_start(self) -> dt.date:
        return self.start - dt.timedelta(days=self.settlement_days)


@dataclass(frozen=True)
class ReceivablesParams:
    """Window, exclusions and acquirer terms of the receive/pay table."""

    start: dt.date
    end: dt.date
    excluded_companies: tuple[str, ...] = ()
    factoring_marker: str = "contract-chunk"
    # Days from creation until the acquirer pays, per funding type.
    acquirer_days: tuple[tuple[str, int], ...] = (("credit", 31), ("debit", 2), ("prepaid", 2))
    default_acquirer_days: int = 31
    tz: str = "America/Sao_Paulo"


@dataclass(frozen=True)
class WeeklyRates:
    """Revenue rate and fixed fee, national and international."""

    national_rate: float = 0.005
    international_rate: float = 0.014
    national_fee: float = 0.25
    international_fee: float = 0.50
