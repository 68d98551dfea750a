"""CSV files in splits: records over lines and blocks, and UTF-16 by code unit."""

import csv
import io
import random

import pytest

from starfold.plans import importer
from starfold.sources import csv_files
from starfold.sources.utf16 import utf16_counts

CELLS = ["x", 'say "hi"', "two\nlines", "a\rb", "crlf\r\nin", "", "\n\n", "ĊĢ ਊ਀ Ā", "côté"]


def write(path, rows, encoding="utf-8", end="\n", last=True):
    text = end.join(",".join('"' + c.replace('"', '""') + '"' for c in r) for r in rows)
    path.write_bytes((text + (end if last else "")).encode(encoding))
    return str(path)


def table(n, cells, seed=3, width=3):
    rng = random.Random(seed)
    return [["a", "b", "c"], *[[rng.choice(cells) if j else f"r{i}" for j in range(width)] for i in range(n)]]


@pytest.fixture(params=[150, 1000, None])
def block(spark, request):
    """Blocks so small that records and even cells run over several of them."""
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_over_lines_are_read_in_splits(spark, tmp_path, block):
    rows = table(150, CELLS + ["long\n" * 60])
    for i, (end, last) in enumerate([("\n", True), ("\r\n", False)]):
        write(tmp_path / f"f{i}.csv", rows, end=end, last=last)
    df = csv_files.scan_csv(spark, str(tmp_path), rows[0])
    plan = df._jdf.queryExecution().toString()
    assert "multiLine" not in plan and "FileScan csv" not in plan
    found = sorted(tuple(r) for r in df.collect())
    expected = sorted(tuple(c if c.strip() else c or None for c in r) for r in rows[1:] * 2)
    assert [tuple(c or None for c in r) for r in found] == [tuple(c or None for c in r) for r in expected]


def test_an_open_cell_is_the_rest_of_its_file(spark, tmp_path, block):
    (tmp_path / "f.csv").write_text('"a","b"\n"1","plain"\n"2","open\n' + "more\n" * 50 + "end")
    found = csv_files.scan_csv(spark, str(tmp_path), ["a", "b"]).collect()
    assert sorted(r["a"] for r in found) == ["1", "2"]


def test_one_odd_line_moves_one_record(spark, tmp_path):
    rows = table(500, ["x", "y"])
    rows[250][1] = "two\nlines"
    write(tmp_path / "f.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = csv_files.scan_csv(spark, str(tmp_path), rows[0])
        assert df.rdd.getNumPartitions() > 4 and df.count() == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("encoding", ["utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("last", [True, False])
def test_utf16_is_counted_by_code_unit(spark, tmp_path, block, encoding, last):
    mark = "\ufeff"
    for name, cells in (("plain", ["x", "ĊĢ", "Ċ", "Ģ", "ਊ਀", "Ā"]), ("lines", CELLS)):
        rows = table(60, cells)
        rows[0][0] = "a"
        text = "\n".join(",".join('"' + c.replace('"', '""') + '"' for c in r) for r in rows) + ("\n" if last else "")
        (tmp_path / f"{name}.csv").write_bytes((mark + text).encode(encoding))
        expected = len(list(csv.reader(io.StringIO(text, newline="")))) - 1
        found = utf16_counts(spark, [str(tmp_path / f"{name}.csv")]).first()
        assert found["records"] == expected == 60
        assert found["lines"] == text.count("\n") + (not last) - 1
        facts = csv_files.source_facts(spark, str(tmp_path / f"{name}.csv"))
        assert facts.encoding == "utf-16" and facts.has_multi_line == (name == "lines")


@pytest.mark.parametrize("encoding", ["utf-16-le", "utf-16-be"])
def test_utf16_files_are_lossless(spark, store, tmp_path, encoding):
    """The usual export of office programs ends with a line feed."""
    text = "\ufeffArea Code,Area,Value\n1,Ċa,5\n2,Ģb,6\n3,c,7\n"
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "f.csv").write_bytes(text.encode(encoding))
    result = importer.import_csv(store, str(folder), "UT")
    assert (result.row_count, result.source_row_count, result.count_method, result.lossless) == (3, 3, "line-count", True)
    found = csv_files.audit_row_counts(spark, str(folder), spark.createDataFrame([("", 3)], "dataset_code string, imported long"))
    assert found.first()["source_rows"] == 3
