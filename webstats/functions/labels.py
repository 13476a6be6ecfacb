"""Bucketing and labelling expressions (content bands, health, speed classes,
scroll and duration buckets, severity, channel rates, display formats)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webstats.functions.numeric import _c

# Synthetic conversion rate per channel (the reference's table).
CHANNEL_RATES = {
    "Email": "0.065",
    "Paid Search": "0.048",
    "Organic Search": "0.032",
    "Direct": "0.028",
    "Referral": "0.022",
    "Social": "0.018",
}
DEFAULT_CHANNEL_RATE = "0.025"
REVENUE_PER_CONVERSION = "52.0"


def content_length_band(words) -> Column:
    """F-14; NULL falls to the ELSE branch ('long (1500+)')."""
    w = _c(words)
    return (F.when(w < 300, "thin (<300)").when(w < 700, "short (300-699)")
            .when(w < 1500, "medium (700-1499)").otherwise("long (1500+)"))


def missing_meta(meta) -> Column:
    """F-15."""
    return F.coalesce(_c(meta), F.lit("")) == ""


def health_issues(meta, words, load_ms) -> Column:
    n = (missing_meta(meta).cast("int")
         + (F.coalesce(_c(words), F.lit(0)) < 300).cast("int")
         + F.coalesce(_c(load_ms) > 2000, F.lit(False)).cast("int"))
    return n


def health_score(meta, words, load_ms) -> Column:
    """F-16: 0 issues healthy, 1 needs work, 2+ has issues."""
    n = health_issues(meta, words, load_ms)
    return F.when(n == 0, "healthy").when(n == 1, "needs work").otherwise("issues")


def load_time_bucket(ms) -> Column:
    """F-17."""
    m = _c(ms)
    return (F.when(m <= 500, LOAD_BUCKETS[0]).when(m <= 1000, LOAD_BUCKETS[1])
            .when(m <= 2000, LOAD_BUCKETS[2]).otherwise(LOAD_BUCKETS[3]))


# Load-time bucket labels in display order.
LOAD_BUCKETS = ["Fast (≤500ms)", "OK (501–1000ms)", "Slow (1001–2000ms)", "Very Slow (>2000ms)"]


def response_class(ms) -> Column:
    """F-18: fast < 200, normal 200..1000, slow > 1000."""
    m = _c(ms)
    return F.when(m < 200, "fast").when(m <= 1000, "normal").when(m > 1000, "slow")


def duration_bucket(sec) -> Column:
    """F-19."""
    s = _c(sec)
    return (F.when(s < 30, DURATION_BUCKETS[0]).when(s < 120, DURATION_BUCKETS[1])
            .when(s < 300, DURATION_BUCKETS[2]).when(s < 600, DURATION_BUCKETS[3])
            .when(s >= 600, DURATION_BUCKETS[4]))


# Session-duration bucket labels in display order.
DURATION_BUCKETS = ["0–30s", "30s–2m", "2m–5m", "5m–10m", "10m+"]


def scroll_bucket(pct) -> Column:
    """F-20."""
    p = _c(pct)
    return F.when(p <= 25, "0-25").when(p <= 50, "25-50").when(p <= 75, "50-75").otherwise("75-100")


def severity(score) -> Column:
    """F-21."""
    s = _c(score)
    return F.when(s >= 0.15, "high").when(s >= 0.05, "medium").otherwise("low")


def channel_rate(channel) -> Column:
    """F-22 as decimal(4,3)."""
    c = _c(channel)
    out = None
    for name, rate in CHANNEL_RATES.items():
        lit = F.lit(rate).cast("decimal(4,3)")
        out = F.when(c == name, lit) if out is None else out.when(c == name, lit)
    return out.otherwise(F.lit(DEFAULT_CHANNEL_RATE).cast("decimal(4,3)"))


def format_number(n) -> Column:
    """F-23: 1.2M / 12.3K / 999 (thousands separators below 1000 never occur)."""
    x = F.coalesce(_c(n).cast("double"), F.lit(0.0))
    return (F.when(x >= 1_000_000, F.concat(F.format_string("%.1f", x / 1_000_000), F.lit("M")))
            .when(x >= 1_000, F.concat(F.format_string("%.1f", x / 1_000), F.lit("K")))
            .otherwise(F.format_string("%,d", x.cast("long"))))


def format_percentage(p) -> Column:
    """F-23: fractions in [0,1] are scaled by 100; one digit; NULL -> '—'."""
    x = _c(p).cast("double")
    scaled = F.when((x <= 1.0) & (x >= 0.0), x * 100).otherwise(x)
    return F.when(x.isNull(), F.lit("—")).otherwise(F.concat(F.format_string("%.1f", scaled), F.lit("%")))


def format_duration(sec) -> Column:
    """F-23: '1h 2m', '2m 5s', '45s'; NULL -> '—'."""
    s = _c(sec).cast("double").cast("long")
    return (F.when(_c(sec).isNull(), F.lit("—"))
            .when(s >= 3600, F.format_string("%dh %dm", (s / 3600).cast("long"), ((s % 3600) / 60).cast("long")))
            .when(s >= 60, F.format_string("%dm %ds", (s / 60).cast("long"), s % 60))
            .otherwise(F.format_string("%ds", s)))


def pct_delta(curr, prev) -> Column:
    """F-24: signed '+x.y%' change, NULL when the previous value is 0."""
    c, p = _c(curr).cast("double"), _c(prev).cast("double")
    return F.when(p != 0, F.concat(F.format_string("%+.1f", (c - p) / p * 100), F.lit("%")))
