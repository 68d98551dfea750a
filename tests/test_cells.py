"""Typing of single cells, sizes, names."""

import pytest

from pyspark.sql import functions as F

from starfold.functions import cells
from starfold.operators import profile

TOKENS = {
    "int": ["5", "-5", " 5 ", "0", "-0", "2147483647", "-2147483648", "  12", "\t7"],
    "bigint": ["2147483648", "-2147483649", "9223372036854775807", "-9223372036854775808"],
    "double": [
        "9223372036854775808", "-9223372036854775809", "1e5", ".5", "5.", "1.0", "nan", "inf",
        "-inf", "Infinity", "NaN", "1E-3", "123456789012345678901234567890",
    ],
    "string": [
        "+5", "05", "00", "007.5", "-05", "0x10", "1,000", "5%", "<0.1", "1d", "1f", "t", "true",
        "2001-2003", "210400TSUB", "1685.01.01", "  ", "none", "/5", "'004", "-", ".", "e5", "infinite",
    ],
}


def test_every_token_gets_its_type(spark):
    rows = [(kind, token) for kind, tokens in TOKENS.items() for token in tokens]
    df = spark.createDataFrame(rows, "kind string, cell string")
    typed = df.select("kind", "cell", cells.rank_type(cells.cell_rank("cell")).alias("found"))
    wrong = [(r["cell"], r["kind"], r["found"]) for r in typed.collect() if r["kind"] != r["found"]]
    assert wrong == []


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([None, "", None], "string"),
        (["1", None, "3000000000"], "bigint"),
        (["1", "2.5", ""], "double"),
        (["9223372036854775808", "1"], "double"),
        (["1", "2", "<0.1"], "string"),
        (["007", "010"], "string"),
    ],
)
def test_a_column_takes_its_widest_cell(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert profile.infer_types(df).first()["type_name"] == expected


def test_sizes(spark):
    sizes = {
        "77KB": 77 * 1024, "1.2GB": int(1.2 * 1024**3), "500": 500, "not-a-size": None, None: None,
        "3 mb": 3 * 1024**2, "1.9B": 1, "KB": None, "2TB": 2 * 1024**4, "": None, "-1.5KB": -1536,
    }
    df = spark.createDataFrame([(s,) for s in sizes], "s string")
    found = df.select("s", cells.size_in_bytes(F.col("s")).alias("n")).collect()
    assert {r["s"]: r["n"] for r in found} == sizes


def test_archive_names(spark):
    urls = {
        "https://example.org/a/AE.zip": "AE.zip", "https://example.org/AE.ZIP/": "AE.ZIP",
        "https://example.org/data": "X.zip", None: "X.zip", "": "X.zip", "/": "X.zip",
    }
    df = spark.createDataFrame([(u, "X") for u in urls], "u string, c string")
    found = df.select("u", cells.archive_name(F.col("u"), F.col("c")).alias("n")).collect()
    assert {r["u"]: r["n"] for r in found} == urls


def test_safe_numbers(spark):
    df = spark.createDataFrame([("1d",), ("<0.1",), ("2.5",), (None,)], "v string")
    assert [r[0] for r in df.select(cells.as_number(F.col("v"))).collect()] == [None, None, 2.5, None]
