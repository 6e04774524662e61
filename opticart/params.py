"""Parameters of the data products. No date is read from the clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


# Fixed values that must equal the reference's for the same results:
# allowed e-mail suffixes and the rejection codes and messages of the
# customer intake procedure, in the order the procedure checks them.
ALLOWED_EMAIL_SUFFIXES = ("com", "net", "org", "co.il", "gov", "edu")
EMAIL_RULES = (
    (51001, "Invalid email address: missing @ symbol."),
    (51002, "Invalid email address: missing dot (.) symbol."),
    (51003, "Invalid email domain suffix. Allowed: com, net, org, co.il, gov, edu."),
)


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2001, 8, 1)          # replaces GETDATE()
    year: int = 2000                               # top products year
    years: tuple[int, ...] = (1999, 2000, 2001)    # annual grid / pivot years
    review_as_of: dt.date = dt.date(2000, 12, 31)  # rating-gap "today"
    min_spend: float = 2000.0                      # custom buyer threshold
    top_n: int = 10
    rating_gap: float = -2.0
    idle_days: int = 150
    growth: str = "1.3"                            # revenue target factor (exact decimal)
    spend_lookback_years: int = 3
    revenue_lookback_years: int = 5
    lower_discount: float = 0.1
    upper_discount: float = 0.5
    quartiles: int = 4
    allowed_suffixes: tuple[str, ...] = field(default=ALLOWED_EMAIL_SUFFIXES)
    email_collation: str = ""                      # e.g. UTF8_LCASE_RTRIM; empty: byte by byte

    def __post_init__(self):
        problems = []
        if not self.years:
            problems.append("years must list at least one year")
        if self.top_n < 1 or self.quartiles < 1:
            problems.append("top_n and quartiles must be positive")
        if self.lower_discount > self.upper_discount:
            problems.append("lower_discount must not exceed upper_discount")
        if self.idle_days < 0 or self.spend_lookback_years < 0 or self.revenue_lookback_years < 0:
            problems.append("day and year windows must not be negative")
        if problems:
            raise ValueError("; ".join(problems))


DEFAULT = Params()
