"""Small dimension tables written out as values, shared by the Spark queries and their SQL."""

from __future__ import annotations

CURRENCIES = ("USD", "GBP", "EUR", "JPY", "KWD")

# (currency, decimals); the second table does not know KWD.
DECIMALS = (("USD", 2), ("GBP", 2), ("EUR", 2), ("JPY", 0), ("KWD", 3))
DECIMALS_WITHOUT_KWD = tuple(row for row in DECIMALS if row[0] != "KWD")

# (rate type, snapshot day, currency, value in EUR). The 1997 snapshot has no KWD,
# and type R has two snapshots only.
FX = (
    ("M", "1995-03-01", "EUR", 1.0),
    ("M", "1995-03-01", "USD", 0.76),
    ("M", "1995-03-01", "GBP", 1.20),
    ("M", "1995-03-01", "JPY", 0.0080),
    ("M", "1995-03-01", "KWD", 2.55),
    ("M", "1996-01-01", "EUR", 1.0),
    ("M", "1996-01-01", "USD", 0.78),
    ("M", "1996-01-01", "GBP", 1.22),
    ("M", "1996-01-01", "JPY", 0.0075),
    ("M", "1996-01-01", "KWD", 2.60),
    ("M", "1997-06-15", "EUR", 1.0),
    ("M", "1997-06-15", "USD", 0.88),
    ("M", "1997-06-15", "GBP", 1.45),
    ("M", "1997-06-15", "JPY", 0.0077),
    ("M", "1999-01-01", "EUR", 1.0),
    ("M", "1999-01-01", "USD", 0.85),
    ("M", "1999-01-01", "GBP", 1.42),
    ("M", "1999-01-01", "JPY", 0.0075),
    ("M", "1999-01-01", "KWD", 2.80),
    ("M", "2000-07-01", "EUR", 1.0),
    ("M", "2000-07-01", "USD", 1.05),
    ("M", "2000-07-01", "GBP", 1.58),
    ("M", "2000-07-01", "JPY", 0.0098),
    ("M", "2000-07-01", "KWD", 3.45),
    ("R", "1996-01-01", "EUR", 1.0),
    ("R", "1996-01-01", "USD", 0.79),
    ("R", "1999-01-01", "EUR", 1.0),
    ("R", "1999-01-01", "USD", 0.86),
)

# (tax type, tax code, class, scheme, company, percent); code 4 exists under two types.
TAX = (
    ("I", "0", "C", "S", "E", 0.0),
    ("I", "1", "C", "S", "E", 4.0),
    ("I", "2", "C", "S", "E", 5.0),
    ("I", "3", "C", "S", "E", 7.0),
    ("I", "4", "C", "S", "E", 10.0),
    ("I", "5", "C", "S", "E", 16.0),
    ("I", "6", "C", "S", "E", 18.0),
    ("I", "7", "C", "S", "E", 21.0),
    ("I", "8", "C", "S", "E", 25.0),
    ("J", "4", "C", "S", "E", 11.0),
)

# (campaign, interface, profitable)
CAMPAIGNS = tuple(
    (kind, interface, "N" if kind in ("PROMO", "SMALL") else "S")
    for kind in ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")
    for interface in ("I0", "I1")
)

# (company, applies from, codes for R, C, L and A)
COMPANY_RATE_TYPES = tuple(
    (f"E{company}", day, f"X{company}{n}", f"C{company}{n}", f"L{company}{n}", f"A{company}{n}")
    for company in range(6)
    for n, day in enumerate(("1995-06-30", "1997-01-01", "1998-12-31", "2000-12-31"))
)

# (rate type, from, to, applies from, sell, buy and fixing percent)
SPREADS = tuple(
    ("M", currency, "EUR", day, 1.5 + n, 0.5 + n, 0.25)
    for currency in ("USD", "GBP", "JPY")
    for n, day in enumerate(("1995-01-01", "1998-01-01", "2000-01-01"))
)
