"""The lattice of types, and columns whose values no longer fit theirs."""

import datetime as dt
import os
import tempfile
from decimal import Decimal, InvalidOperation

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators import profile as P
from cartwright.operators.widening import text_fits, widens_to
from cartwright.plans import pipeline as PL

B, S, I, L, F4, F8 = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
D, TS, NTZ, BO, ST, V = T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.StringType(), T.NullType()
ALL = [B, S, I, L, T.DecimalType(4, 2), T.DecimalType(10, 0), T.DecimalType(18, 2), T.DecimalType(38, 10), F4, F8, D, TS, NTZ,
       BO, ST, V]


def test_the_lattice():
    wider = {(B, S), (I, L), (L, F8), (I, T.DecimalType(10, 0)), (T.DecimalType(4, 2), T.DecimalType(18, 2)),
             (T.DecimalType(18, 2), F8), (F4, F8), (S, F4), (D, NTZ), (TS, ST), (BO, ST), (V, B), (L, T.DecimalType(38, 10))}
    never = {(L, I), (F8, L), (I, F4), (L, T.DecimalType(18, 2)), (T.DecimalType(18, 2), T.DecimalType(18, 4)),
             (T.DecimalType(4, 2), I), (NTZ, D), (ST, L), (BO, I), (I, BO), (D, L), (F8, T.DecimalType(38, 10))}
    assert all(widens_to(a, b) for a, b in wider) and not any(widens_to(a, b) for a, b in never)
    for a in ALL:       # an order: reflexive, transitive, both ways only where equal
        assert widens_to(a, a) and widens_to(V, a) and widens_to(a, ST)
        for b in ALL:
            assert a == b or not (widens_to(a, b) and widens_to(b, a)), (a, b)
            for c in ALL:
                assert not (widens_to(a, b) and widens_to(b, c)) or widens_to(a, c), (a, b, c)


TEXTS = ["0", "-7", "+12", " 5 ", "2147483647", "2147483648", "9223372036854775808", "1.5", "1.", ".5", ".", "1e3", "007", "1.500",
         "1.505", "12345678901234567.25", "2018-01-02", "2018-01-02 03:04:05", "2018-02-30", "2018-01-02T03:04", "true", "FALSE",
         "yes", "", "abc", "1,5", "NaN"]


def _plain(text: str, kind: T.DataType) -> bool:
    t = text.strip()
    if kind in (I, L):
        try:
            return t.lstrip("+-").isdigit() and abs(int(t)) < 2 ** (31 if kind == I else 63)
        except ValueError:
            return False
    if isinstance(kind, T.DecimalType):
        try:
            d = Decimal(t)
        except InvalidOperation:
            return False
        return d.is_finite() and "e" not in t and d == d.quantize(Decimal(1).scaleb(-kind.scale)) and abs(d) < 10 ** (
            kind.precision - kind.scale)
    if kind == F8:
        try:
            return float(t) == float(t) and t != ""
        except ValueError:
            return False
    if kind == NTZ:
        try:
            return len(t) >= 10 and bool(dt.datetime.fromisoformat(t))
        except ValueError:
            return False
    return kind == ST or t.lower() in ("true", "false")


def test_text_fits_a_type_exactly_if_it_is_a_value_of_it(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for kind in (I, L, T.DecimalType(18, 2), F8, NTZ, BO, ST):
        got = {r[0]: r[1] for r in df.select("t", text_fits(F.col("t"), kind)).collect()}
        assert got == {t: _plain(t, kind) for t in TEXTS}, kind


def test_schema_check_fails_on_type_alone(spark):
    types = T.StructType([T.StructField("a", L), T.StructField("b", T.DecimalType(18, 2)), T.StructField("c", NTZ),
                          T.StructField("d", I), T.StructField("e", ST)])
    df = spark.createDataFrame([("1", 1.5, "2018-01-02", 1, 1), ("x", None, "soon", 2, None), (None, 2.0, None, 3, 3)],
                               "a string, b double, c string, d int, e bigint")
    r = P.schema_check(df, "t", types.names, types=types).first()
    assert r["schema_valid"] and not r["types_valid"] and r["row_count"] == 3
    assert r["type_mismatches"] == ["a: bigint, 1 values need string", "b: decimal(18,2), values need double",
                                    "c: timestamp_ntz, 1 values need string"]
    good = df.select(F.lit("7").alias("a"), F.lit(None).cast("string").alias("b"), F.lit("2018-01-02 10:00:00").alias("c"),
                     F.col("d").cast("smallint").alias("d"), "e")
    r = P.schema_check(good, "t", types.names, types=types).first()
    assert r["types_valid"] and r["type_mismatches"] == []
    assert P.schema_check(df.limit(0), "t", types.names, types=types).first()["type_mismatches"] == [
        "b: decimal(18,2), values need double"]


def test_a_raw_drop_reports_values_that_lost_their_type(spark):
    raw = tempfile.mkdtemp(prefix="cartwright-raw-")
    with open(os.path.join(raw, "payments.csv"), "w", encoding="utf-8") as fh:
        fh.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                 "o1,1,card,2,10.50\no2,first,card,NA,11.255\no3,3,boleto,1,n/a\n")
    prof = {r["table_name"]: r for r in PL.profile_job(PL.open_inputs(spark, raw_dir=raw), f"{raw}/profile").collect()}
    p = prof["payments"]
    assert p["schema_valid"] and p["misfits"] == {"payment_sequential": 1, "payment_value": 1}
    assert p["inferred_types"] == {"order_id": "string", "payment_sequential": "string", "payment_type": "string",
                                   "payment_installments": "bigint", "payment_value": "double"}
    assert p["data_types"]["payment_sequential"] == "int" and p["null_counts"]["payment_sequential"] == 1
