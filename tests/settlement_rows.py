"""Trades and instruments that several tests use."""

import datetime as dt

TRADES_DDL = ("TradeID string, InstrumentID string, Counterparty string, Notional double, Currency string, "
              "TradeDate timestamp, SettlementDate timestamp, Status string, ingestion_timestamp timestamp")
INSTRUMENTS_DDL = ("InstrumentID string, InstrumentType string, InstrumentName string, Ticker string, "
                   "Exchange string")

INGESTED = dt.datetime(2024, 4, 5, 7, 30, 0)


def at(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if s else None


# A corrected copy under the same stamp (LN-7), no counterparty (LN-8), no
# notional (LN-9), an instrument nobody lists and a fraction of a cent (LN-10), a
# negative amount (LN-11), a currency that is none (LN-12).
TRADE_ROWS = [
    ("LN-7", "XS-88", "Harbour Trust", 812.375, " chf", "2024-03-28 08:05:00", "2024-04-02 08:05:00", "PENDING"),
    ("LN-8", "XS-12", None, 40000.0, "usd", "2024-03-28 16:00:00", "2024-03-30 16:00:00", "SETTLED"),
    ("LN-9", "XS-12", "Ostrava Bank", None, "USD", "2024-04-01 10:00:00", None, "PENDING"),
    ("LN-10", "ZZ-01", "Ostrava Bank", 3250000.125, "usd", "2024-04-01 11:30:00", "2024-04-03 11:30:00", "SETTLED"),
    ("LN-7", "XS-88", "Harbour Trust", 812.5, "CHF", "2024-03-28 08:05:00", "2024-04-02 08:05:00", "SETTLED"),
    ("LN-11", "XS-88", "Ostrava Bank", -1000.0, "jpy", "2024-04-02 09:00:00", "2024-04-04 09:00:00", "SETTLED"),
    ("LN-12", "XS-31", "Harbour Trust", 812.5, "CH", "2024-03-28 12:00:00", "2024-03-28 12:00:00", "SETTLED"),
]

# XS-88 is listed twice.
INSTRUMENT_ROWS = [
    ("XS-88", "Note", "Harbour 2031", "HB31", "SIX"),
    ("XS-12", "Swap", "Three-month swap", "SW3M", "OTC"),
    ("XS-88", "Note", "Harbour 2031 (tap)", "HB31", "SIX"),
    ("XS-31", "Share", "Vltava Energy", "VLTA", "PSE"),
    ("XS-40", "Future", "Wheat May", "WHT5", "MATIF"),
]
