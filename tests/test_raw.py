"""Raw scan, id/date cleaning, text canonicalisation."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart.config import SourceConfig
from salesmart.functions.text import canonical_category, clean_id, title_case
from salesmart.sources.raw import clean_raw, load_raw_data, profile


def test_scan_with_own_delimiter_headers_and_text_ids(spark, tmp_path):
    path = tmp_path / "tills.txt"
    path.write_text(
        "when|receipt|who|what\n5/1/2021|R 0871|cust7|sku-301\n28/12/2020|44|cust19|sku-5\n"
    )
    cfg = SourceConfig(
        path=str(path), delimiter="|", date_format="d/M/yyyy",
        column_map={"date": "when", "transaction_id": "receipt",
                    "buyer_id": "who", "item_id": "what"},
    )
    df = load_raw_data(spark, cfg)
    assert dict(df.dtypes)["date"] == "date"
    assert dict(df.dtypes)["transaction_id"] == "bigint"
    rows = df.orderBy("transaction_id").collect()
    assert [r["date"] for r in rows] == [dt.date(2020, 12, 28), dt.date(2021, 1, 5)]
    assert [r["transaction_id"] for r in rows] == [44, 871]
    assert [r["buyer_id"] for r in rows] == [19, 7]
    assert [r["item_id"] for r in rows] == [5, 301]


def test_id_cleaning_edge_cases(spark):
    df = spark.createDataFrame(
        [("12.0",), ("-7",), ("007",), ("",), ("x",), (None,), ("99999999999999999999",)], "v string"
    )
    out = [r[0] for r in df.select(clean_id("v")).collect()]
    assert out == [120, 7, 7, None, None, None, None]


def test_date_parsing_rules(spark):
    df = spark.createDataFrame(
        [("2/1/2019",), (" 02/01/2019",), ("02/01/2019 ",), ("02/01/19",), ("31/02/2019",)],
        "Date string",
    )
    out = [r[0] for r in clean_raw(df, SourceConfig(column_map={"date": "Date"})).collect()]
    assert out == [dt.date(2019, 1, 2), dt.date(2019, 1, 2), None, None, None]


def test_title_case_matches_python(spark):
    samples = ["men's t-shirt a/b 3d", "  home   APPLIANCES ", "électronique  du-sud", "x", ""]
    df = spark.createDataFrame([(s,) for s in samples] + [(None,)], "v string")
    got = [r[0] for r in df.select(canonical_category("v")).collect()]
    want = [" ".join(s.split()).title() for s in samples] + [None]
    assert got == want
    assert df.select(title_case(F.lit("men's t-shirt"))).first()[0] == "Men'S T-Shirt"


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([("N/A", "NA", "null", "ok")], "a string, b string, c string, d string")
    out = clean_raw(df, SourceConfig(column_map={"item_name": "a", "category": "b",
                                                 "version": "c", "item_code": "d"})).first()
    assert (out.item_name, out.category, out.version, out.item_code) == (None, None, None, "ok")


def test_profile_counts_nulls_in_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, "b"), (3, "c")], "a int, b string")
    rows = {r.column_name: r for r in profile(df).collect()}
    assert rows["a"].n_rows == 3 and rows["a"].n_nulls == 1 and rows["a"].data_type == "int"
    assert rows["b"].n_nulls == 1 and rows["b"].data_type == "string"


def test_scale_conf_sizes_partitions():
    from salesmart.session import scale_conf

    conf = scale_conf(100 * (1 << 40))  # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert int(scale_conf(1 << 30)["spark.sql.shuffle.partitions"]) == 200
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
