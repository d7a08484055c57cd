import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordertide.plans.fixtures import camel, fixed_width_lines
from ordertide.schemas import FIXED_WIDTH_LAYOUT, RAW_ORDER_COLUMNS
from ordertide.sources.files import read_delimited, read_fixed_width

TEXT = st.text(alphabet=string.ascii_letters + string.digits + "#-", min_size=1, max_size=5)
# One value per column, never wider than its fixed-width field.
ROW = st.tuples(*[
    st.text(alphabet=string.ascii_letters + string.digits + "#-", min_size=1, max_size=min(5, length))
    for _, _, length in FIXED_WIDTH_LAYOUT
])


def _cleaned(values):
    """What the readers must return: the literal ``null`` is NULL by spec."""
    return sorted((tuple(None if v == "null" else v for v in row) for row in values), key=repr)


def _rows(spark, values):
    return spark.createDataFrame([tuple(v) for v in values], ", ".join(f"{c} string" for c in RAW_ORDER_COLUMNS))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=6))
def test_fixed_width_round_trip(spark, tmp_path_factory, values):
    path = str(tmp_path_factory.mktemp("fw"))
    df = _rows(spark, values)
    fixed_width_lines(df).coalesce(1).write.mode("overwrite").text(path)
    back = read_fixed_width(spark, path).select(RAW_ORDER_COLUMNS)
    assert sorted(map(tuple, back.collect()), key=repr) == _cleaned(values)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(TEXT, min_size=19, max_size=19), min_size=1, max_size=6), st.sampled_from(["\t", ","]))
def test_delimited_round_trip_with_positional_names(spark, tmp_path_factory, values, sep):
    path = str(tmp_path_factory.mktemp("csv"))
    df = _rows(spark, values)
    df.select([df[c].alias(camel(c)) for c in RAW_ORDER_COLUMNS]).write.mode("overwrite").option(
        "header", True).option("sep", sep).csv(path)
    back = read_delimited(spark, path, sep=sep, positional=True).select(RAW_ORDER_COLUMNS)
    assert sorted(map(tuple, back.collect()), key=repr) == _cleaned(values)


def test_delimited_width_mismatch_is_refused(spark, tmp_path):
    path = str(tmp_path / "narrow")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).csv(path)
    with pytest.raises(ValueError):
        read_delimited(spark, path, positional=True)


def test_fixed_width_slices_and_cleans(spark, tmp_path):
    line = "".join(
        ("null" if name == "sales_rep_city" else ("" if name == "product_id" else name[:min(3, length)])).ljust(length)
        for name, _, length in FIXED_WIDTH_LAYOUT
    )
    assert len(line) == 409
    path = tmp_path / "one.txt"
    path.write_text(line + "\n")
    row = read_fixed_width(spark, str(path)).first()
    assert row.submitted_at == "sub" and row.product_sold_price == "pro"
    assert row.sales_rep_city is None and row.product_id is None
    assert row.ingest_file_name.endswith("one.txt") and row.ingested_at is not None


def test_swapped_headers_fail_the_read(spark, tmp_path):
    """Columns of files with different headers are never mixed up."""
    from ordertide.sources.files import read_delimited

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.tsv").write_text("x\ty\n1\t2\n")
    same = read_delimited(spark, str(tmp_path / "t"), sep="\t", names=None)
    assert [(r.x, r.y) for r in same.collect()] == [("1", "2")]
    (tmp_path / "t" / "b.tsv").write_text("y\tx\n3\t4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "t"), sep="\t", names=None).collect()


def test_values_wider_than_their_field_fail(spark):
    from pyspark.sql import functions as F

    from ordertide.plans.fixtures import _zeros, fixed_width_lines
    from ordertide.schemas import FIXED_WIDTH_LAYOUT

    fit = spark.range(1).select(*[F.lit("7").alias(n) for n, _, _ in FIXED_WIDTH_LAYOUT])
    assert len(fixed_width_lines(fit).first().value) == sum(w for _, _, w in FIXED_WIDTH_LAYOUT)
    with pytest.raises(Exception, match="wider than"):
        fixed_width_lines(fit.withColumn(FIXED_WIDTH_LAYOUT[0][0], F.lit("7" * 500))).collect()
    long = spark.range(1).select(_zeros(F.lit(1234567890), 9).alias("a"), _zeros(F.lit(12), 5).alias("b")).first()
    assert tuple(long) == ("1234567890", "00012")


def test_fields_are_cut_from_blocks_of_a_line(spark, tmp_path):
    """No field is looked for from the start of its line; fields may overlap,
    cross a block's edge or hold characters of several bytes."""
    line = "".join(chr(0x4E00 + i) if i % 3 else chr(97 + i % 26) for i in range(400))
    (tmp_path / "a.txt").write_text(line + "\n" + line[:250] + "\n", encoding="utf-8")
    layout = [("all", 1, 400), ("last", 391, 10), ("edge", 79, 4), ("mid", 155, 90), ("one", 81, 1), ("two", 82, 1), ("three", 83, 2)]
    df = read_fixed_width(spark, str(tmp_path), layout, clean=False, lineage=False, keep_rejects=True)
    for row in df.collect():
        whole = row["_corrupt_record"] or line
        assert all(row[n] == whole[s - 1 : s - 1 + k] for n, s, k in layout)
    plan = read_fixed_width(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring(value#") <= 6
