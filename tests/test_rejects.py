"""Records that can't be read, headers of many files, XML in splits."""

import pytest
from pyspark.sql import functions as F

from ordertide.schemas import FIXED_WIDTH_LAYOUT, PRODUCTS_XML_SCHEMA
from ordertide.sources.files import (
    CORRUPT,
    HeaderMismatch,
    accepted,
    file_headers,
    read_delimited,
    read_fixed_width,
    read_orders_json,
    read_products_xml,
    rejected,
    xml_records,
)


def _files(tmp_path, **texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.txt").write_text(text)
    return str(folder)


def test_fixed_width_lines_of_another_width(spark, tmp_path):
    width = max(s + n - 1 for _, s, n in FIXED_WIDTH_LAYOUT)
    path = _files(tmp_path, a="1" * width + "\n" + "2" * (width - 1) + "\n" + "3" * (width + 1) + "\n")
    assert read_fixed_width(spark, path).count() == 1
    bad = rejected(read_fixed_width(spark, path, keep_rejects=True)).collect()
    assert sorted(r.text for r in bad) == ["2" * (width - 1), "3" * (width + 1)]
    assert all(r.ingest_file_name.endswith("a.txt") and r.ingested_at for r in bad)


def test_delimited_lines_with_other_field_counts(spark, tmp_path):
    path = _files(tmp_path, a="a,b,c\n1,2,3\nx,y\n,,\n", b="a,b,c\n4,5,6,7\n7,8,9\n")
    df = read_delimited(spark, path, names=["a", "b", "c"], keep_rejects=True)
    assert sorted(r.a or "" for r in accepted(df).collect()) == ["", "1", "7"]
    assert sorted(r.text for r in rejected(df).collect()) == ["4,5,6,7", "x,y"]
    assert df.filter(F.col(CORRUPT).isNotNull()).count() == 2


@pytest.mark.parametrize("header", ["a,c,b", "a,b", "a,b,c,d", "a,b,x"])
@pytest.mark.parametrize("positional", [False, True])
def test_a_file_with_another_header_is_named(spark, tmp_path, header, positional):
    """Also when only one column of the result is used."""
    path = _files(tmp_path, a="a,b,c\n1,2,3\n", other=f"{header}\n1,2,3\n")
    names = ["x", "y", "z"] if positional else ["a", "b", "c"]
    df = read_delimited(spark, path, names=names, positional=positional, header=["a", "b", "c"])
    with pytest.raises(Exception, match="other.txt"):
        df.select(df.columns[1]).collect()
    if positional:  # no header given: all files are looked at, none is the model
        with pytest.raises(HeaderMismatch, match="other.txt"):
            read_delimited(spark, path, names=names, positional=True)


def test_the_common_header_is_read_from_every_file(spark, tmp_path):
    path = _files(tmp_path, a='a,"b, too",c\n1,2,3\n', b='a,"b, too",c\n4,5,6\n')
    assert sorted(tuple(r) for r in file_headers(spark, path).select(F.regexp_extract("file", "([^/]*)$", 1), "header").collect()) == [
        ("a.txt", 'a,"b, too",c'),
        ("b.txt", 'a,"b, too",c'),
    ]
    df = read_delimited(spark, path, names=["x", "y", "z"], positional=True)
    assert sorted(r.y for r in df.collect()) == ["2", "5"]


def test_json_lines_that_are_no_order(spark, tmp_path):
    good = '{"orderId":"1","customerId":"c","products":[{"productId":"p","quantity":2,"soldPrice":1.25}]}'
    wrong_type = '{"orderId":"2","products":[{"productId":"p","quantity":"two"}]}'
    bad = ["{broken", wrong_type, "[1]", "null", "{}", '{"customerId":"no id"}']
    path = _files(tmp_path, a="\n".join([good, "", "  ", *bad]) + "\n")
    assert [r.orderId for r in read_orders_json(spark, path).collect()] == ["1"]
    df = read_orders_json(spark, path, keep_rejects=True)
    assert sorted(r.text for r in rejected(df).collect()) == sorted(bad)


def _product(i):
    return (
        f'<product _id="x" product_id="p{i}">\n  <color>c{i} &lt; &amp;</color>\n <model_name>m\n{i}</model_name>'
        f'\n <price base_price="{i}.5" color_adj="1.0" size_adj="1.0"><usd>{i}</usd></price></product>'
    )


@pytest.mark.parametrize("split", ["300", "1009", "20000"])
def test_xml_of_any_size_is_split(spark, tmp_path, split):
    """Records over lines, closing tags at split edges, empty elements."""
    n = 400
    body = "\n".join(_product(i) + ('<product/>\n<product product_id="e" note="a/b>c" />' if i % 50 == 0 else "") for i in range(n))
    path = _files(tmp_path, big=f'<?xml version="1.0"?>\n<products>\n{body}\n</products>\n', none="<products>\n</products>\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert xml_records(spark, path, "product").rdd.getNumPartitions() > (1 if split == "20000" else 40)
        rows = read_products_xml(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    named = [r for r in rows if r.color is not None]
    assert sorted(r["_product_id"] for r in named) == sorted(f"p{i}" for i in range(n))
    assert all(r.color == f"c{r['_product_id'][1:]} < &" and r.price.usd == float(r["_product_id"][1:]) for r in named)
    empty = [r["_product_id"] for r in rows if r.color is None]
    assert sorted(empty, key=str) == sorted(["e"] * 8 + [None] * 8, key=str)


def test_xml_record_that_does_not_fit(spark, tmp_path):
    path = _files(tmp_path, a='<products><product product_id="1"><color>a</b></product><product product_id="2"><price><usd>x</usd></price></product></products>')
    df = read_products_xml(spark, path, keep_rejects=True)
    assert accepted(df).count() == 0
    assert sorted(r.text[:23] for r in rejected(df).collect()) == ['<product product_id="1"', '<product product_id="2"']
    assert accepted(df).columns == PRODUCTS_XML_SCHEMA.names
