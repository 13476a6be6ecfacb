"""pg_round / py_round agree with exact decimal rounding (NUMERIC half-up / Python half-even)."""

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webstats import functions as W

# decimal texts with up to 6 fraction digits, many of them exact ties at 1-4 digits
dec_text = st.builds(lambda i, f, neg: f"{'-' if neg else ''}{i}.{f}", st.integers(0, 99999),
                     st.text(alphabet="0123456789", min_size=1, max_size=6).filter(lambda s: s[-1] != "0") |
                     st.sampled_from(["5", "05", "005", "125", "0005", "995", "245"]), st.booleans())


@settings(max_examples=1, deadline=None)
@given(st.lists(dec_text, min_size=300, max_size=300), st.integers(0, 4))
def test_rounding_matches_exact_decimal(spark, texts, digits):
    df = spark.createDataFrame([(i, float(t)) for i, t in enumerate(texts)], "i int, v double")
    rows = df.orderBy("i").select(W.pg_round(F.col("v"), digits).alias("pg"),
                                  W.py_round(F.col("v"), digits).alias("py")).collect()
    q = Decimal(1).scaleb(-digits)
    for t, r in zip(texts, rows):
        assert r["pg"] == float(Decimal(t).quantize(q, rounding=ROUND_HALF_UP)), t
        assert r["py"] == float(Decimal(t).quantize(q, rounding=ROUND_HALF_EVEN)), t


def test_pct_matches_exact_ratio(spark):
    pairs = [(a, b) for a in range(0, 60, 7) for b in range(1, 400, 37)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(W.pct("a", "b", 2)).collect()]
    want = [float((Decimal(100 * a) / Decimal(b)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for a, b in pairs]
    assert got == want
