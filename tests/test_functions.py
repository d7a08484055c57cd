import datetime as dt

from pyspark.sql import functions as F

from ordertide.functions.clean import (
    clean_all,
    clean_string,
    epoch_to_timestamp,
    month_key,
    ssn_to_long_in_pandas,
    ssn_format_error,
    ssn_to_long,
)


def test_clean_string_rules(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("null",), (" null ",), ("  x ",), ("NULL",)], "v string")
    out = [r[0] for r in df.select(clean_string("v")).collect()]
    # blank and literal "null" become NULL; other values are trimmed
    assert out == [None, None, None, None, None, "x", "NULL"]


def test_clean_all_one_projection_keeps_order_and_types(spark):
    df = spark.createDataFrame([(" a ", 1, "null")], "a string, n int, b string")
    out = clean_all(df)
    assert out.columns == ["a", "n", "b"]
    assert out.collect()[0] == ("a", 1, None)
    assert dict(out.dtypes)["n"] == "int"


def test_ssn_helpers(spark):
    df = spark.createDataFrame([("123-45-6789",), ("123456789",), (None,), ("12x",)], "s string")
    rows = df.select(ssn_format_error("s"), ssn_to_long("s"), ssn_to_long_in_pandas("s")).collect()
    assert [tuple(r) for r in rows] == [
        (True, 123456789, 123456789),
        (False, 123456789, 123456789),
        (None, None, None),
        (False, None, None),
    ]


def test_epoch_to_timestamp_is_64_bit_and_tolerant(spark):
    df = spark.createDataFrame([("0",), ("2147483648",), ("bad",), (None,)], "s string")
    rows = df.select(epoch_to_timestamp("s").alias("t")).collect()
    assert rows[0].t == dt.datetime(1970, 1, 1)
    assert rows[1].t == dt.datetime(2038, 1, 19, 3, 14, 8)  # past the 32-bit limit
    assert rows[2].t is None and rows[3].t is None


def test_month_key(spark):
    df = spark.createDataFrame([("978652800",)], "s string")
    assert df.select(month_key(epoch_to_timestamp("s"))).first()[0] == "2001-01"


def test_vectorized_and_native_ssn_agree_on_raw(spark, sf_dir):
    from ordertide.plans.workspace import Workspace

    raw = Workspace.get(spark, sf_dir).raw_batched()
    diff = raw.select(
        F.count_if(~ssn_to_long("sales_rep_ssn").eqNullSafe(ssn_to_long_in_pandas("sales_rep_ssn")))
    ).first()[0]
    assert diff == 0


def test_ssn_default_is_native_and_the_pandas_form_agrees(spark):
    import inspect

    from ordertide.functions.clean import ssn_to_long, ssn_to_long_in_pandas
    from ordertide.plans import normalize

    df = spark.createDataFrame([("123-45-6789",), ("000000012",), ("x-1",), ("",), (None,)], "s string")
    out = df.select(ssn_to_long("s").alias("a"), ssn_to_long_in_pandas("s").alias("b")).collect()
    assert [r.a for r in out] == [r.b for r in out] == [123456789, 12, None, None, None]
    assert inspect.signature(normalize.sales_reps).parameters["vectorized"].default is False
    native = df.select(ssn_to_long("s"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in native


def test_pandas_ssn_is_the_native_one(spark):
    texts = ["9223372036854775807", "9223372036854775808", "9" * 20, "0" * 30 + "7", "-", "", "+12", " 34 ", "1-2-3", "٣", "1.5", None, "x1"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", ssn_to_long("s").alias("native"), ssn_to_long_in_pandas("s").alias("pandas")).collect()
    assert [(r.s, r.pandas) for r in rows] == [(r.s, r.native) for r in rows]
