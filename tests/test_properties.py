from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwright.functions import half_up_ratio

ints = st.integers(min_value=-10**15, max_value=10**15)


def reference(n, d, scale):
    if d == 0:
        return None
    q = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    return float(q)


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ints, ints), min_size=50, max_size=200), st.integers(0, 6))
def test_half_up_ratio_matches_decimal_half_up(spark, pairs, scale):
    # include exact ties: n / d ending in 5 at the first dropped digit
    pairs = pairs + [(5 * 10 ** (6 - scale) + 10 ** (7 - scale) * k, 10 ** 7) for k in range(-3, 4)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(half_up_ratio("n", "d", scale)).collect()]
    want = [reference(n, d, scale) for n, d in pairs]
    assert got == want
