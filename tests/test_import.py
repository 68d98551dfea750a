"""Imports end to end, from archives and files written by the tests."""

from __future__ import annotations

import json
import random
import zipfile

import pytest

from starfold.operators.reduce import Years
from starfold.plans import build as builds
from starfold.plans import importer
from starfold.plans.store import Store
from starfold.session import delete_path
from starfold.sources import archives, csv_files, inventory, lookup

HEADER = "Domain Code,Domain,Area Code,Area Code (M49),Area,Item Code,Item,Element Code,Element,Year Code,Year,Unit,Value,Flag"


def line(area, item, element, year, value, flag, unit="t"):
    areas = {2: ("'012", "Norland"), 68: ("'340", "Sudland")}
    items = {15: "Oats", 27: "Rye", 44: "Beans", "F1": "Oats"}
    elements = {5510: "Output", 5312: "Area used"}
    cells = ["CR", "Crops", area, *areas[area], item, items[item], element, elements[element], year, year, unit, value, flag]
    return ",".join('"' + str(c).replace('"', '""') + '"' for c in cells)


CROPS = [
    line(2, 15, 5510, 2000, 3200, "A"),
    line(2, 15, 5510, 2001, 3300, "E"),
    line(2, 15, 5312, 2000, 1000, "A", "ha"),
    line(2, 27, 5510, 2000, 5200, "A"),
    line(68, 15, 5510, 2000, 37000, "A"),
    line(68, 15, 5312, 2002, 5000, ""),
    line(68, 44, 5510, 2002, 100, "E"),
]
FLAGS = "Flag,Description\nA,Official\nE,Estimated\n"


def pack(folder, code, rows=CROPS, flags=FLAGS, header=HEADER, encoding="utf-8"):
    path = folder / f"{code}.zip"
    text = "\n".join([header, *rows]) + "\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(f"{code}_All_Data.csv", text.encode(encoding))
        if flags:
            archive.writestr(f"{code}_Flags.csv", flags)
    return str(path)


def facts(store, code="CR"):
    df = store.read(importer.fact_table(code))
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_an_archive_becomes_a_star(store, tmp_path):
    result = importer.import_archive(store, pack(tmp_path, "CR"), "CR", keep_raw=True)
    assert (result.row_count, result.source_row_count, result.count_method) == (7, 7, "line-count")
    assert result.lossless and result.flag_rows == 2 and result.repeated_keys == ()
    kinds = dict(store.read("data_cr").dtypes)
    assert kinds == {"area_code": "int", "item_code": "int", "element_code": "int", "year": "int", "unit": "string", "value": "int", "flag_code": "string"}
    assert importer.recorded_constants(store, "CR") == {"domain_code": "CR"}
    areas = {tuple(r) for r in store.read("dim_area").select("area_code", "area_code_m49", "area_label").collect()}
    assert areas == {("2", "012", "Norland"), ("68", "340", "Sudland")}
    raw = store.read("raw_cr")
    assert "domain" in raw.columns and raw.where("area_code_m49 = \"'012\"").count() == 4
    view = importer.labelled(store, "CR")
    rows = view.where("area_label = 'Sudland' AND item_label = 'Oats' AND element_label = 'Output'").collect()
    assert [(r["year"], r["year_code"], r["value"], r["flag_description"]) for r in rows] == [(2000, "2000", 37000, "Official")]
    assert view.count() == 7


def test_the_wide_source_comes_back(spark, store, tmp_path):
    importer.import_archive(store, pack(tmp_path, "CR"), "CR", keep_raw=True)
    wide = importer.rebuild_source(store, "CR")
    raw = store.read("raw_cr").selectExpr(*[f"substring({c}, 2) AS {c}" if c == "area_code_m49" else c for c in wide.columns])
    assert wide.exceptAll(raw).count() == 0 and raw.exceptAll(wide).count() == 0


def test_year_slices_merge_to_the_full_import(spark, store, tmp_path):
    """Any order of slices, with repeats, must end where one full import ends."""
    path = pack(tmp_path, "CR")
    whole = Store(spark, str(tmp_path / "whole"))
    importer.import_archive(whole, path, "CR", years=Years.of(2000, 2001, 2002))
    for years in (Years.of(2002), Years.of(2000), Years.of(2002), Years.of(start=2001)):
        result = importer.import_archive(store, path, "CR", years=years)
        assert result.lossless
    merged, single = importer.rebuild_source(store, "CR"), importer.rebuild_source(whole, "CR")
    merged = merged.select(*single.columns)
    assert merged.exceptAll(single).count() == 0 and single.exceptAll(merged).count() == 0
    assert result.appended_rows == 3 and result.years == (2001, 2002) and result.row_count == 7
    labels = {r[0] for r in store.read("dim_item").select("item_label").collect()}
    assert labels == {"Oats", "Rye", "Beans"} and store.read("dim_item").count() == 3


def test_explicit_years_without_rows_clear_what_is_stored(store, tmp_path):
    importer.import_archive(store, pack(tmp_path, "CR"), "CR", years=Years.of(2000, 2002))
    later = pack(tmp_path, "CR", [r for r in CROPS if '"2000"' not in r])
    result = importer.import_archive(store, later, "CR", years=Years.of(2000, 2001))
    assert result.row_count == 3
    assert {r[0] for r in store.read("data_cr").select("year").distinct().collect()} == {2001, 2002}
    nothing = importer.import_archive(store, later, "CR", years=Years.of(start=2050))
    assert (nothing.row_count, nothing.appended_rows) == (3, 0)


def test_a_slice_with_censored_values_widens_the_fact(store, tmp_path):
    importer.import_archive(store, pack(tmp_path, "CR"), "CR", years=Years.of(2000))
    later = pack(tmp_path, "CR", [line(2, 15, 5510, 2001, "<0.1", "E")])
    importer.import_archive(store, later, "CR", years=Years.of(2001))
    assert dict(store.read("data_cr").dtypes)["value"] == "string"
    assert {r[0] for r in store.read("data_cr").where("year = 2001").collect()} != set()
    assert store.read("data_cr").where("value = '<0.1'").count() == 1
    assert store.read("data_cr").where("value = '3200'").count() == 1


def test_full_import_replaces_and_other_datasets_stay(store, tmp_path):
    importer.import_archive(store, pack(tmp_path, "CR"), "CR", years=Years.of(2000))
    alpha = [r.replace('"15"', '"F1"') for r in CROPS]
    importer.import_archive(store, pack(tmp_path, "FX", alpha), "FX")
    result = importer.import_archive(store, pack(tmp_path, "CR"), "CR")
    assert result.appended_rows is None and result.row_count == 7
    assert dict(store.read("data_fx").dtypes)["item_code"] == "string"
    assert {r[0] for r in store.read("dim_item").select("item_code").collect()} == {"15", "27", "44", "F1"}
    assert importer.labelled(store, "FX").where("item_code = 'F1'").first()["item_label"] == "Oats"
    assert facts(Store(store.spark, store.root)) == facts(store)


def test_no_year_column_means_no_filter(store, tmp_path):
    rows = ["2,Norland,15,Oats,3200,A", "68,Sudland,15,Oats,37000,A"]
    path = pack(tmp_path, "NY", rows, None, "Area Code,Area,Item Code,Item,Value,Flag")
    result = importer.import_archive(store, path, "NY", years=Years.of(2000))
    assert result.years is None and result.row_count == 2 and result.flag_rows == 0 and result.lossless


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16"])
def test_multi_line_cells_in_every_encoding(store, tmp_path, encoding):
    rows = [r.replace("Oats", 'Winter\noats "côté"'.replace('"', '""')) for r in CROPS]
    result = importer.import_archive(store, pack(tmp_path, "CR", rows, encoding=encoding), "CR")
    assert (result.row_count, result.source_row_count, result.count_method) == (7, 7, "quote-parity")
    labels = {r[0] for r in store.read("dim_item").select("item_label").collect()}
    assert labels == {'Winter\noats "côté"', "Rye", "Beans"}


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1", "utf-16"])
def test_plain_files_in_every_encoding(spark, store, tmp_path, encoding):
    path = tmp_path / "plain.csv"
    path.write_bytes("\n".join([HEADER, *[r.replace("Oats", "Blé") for r in CROPS]]).encode(encoding))
    found = csv_files.source_facts(spark, str(path))
    assert found.encoding == encoding.replace("-sig", "") and found.physical_rows == 7
    names = csv_files.csv_header(spark, str(path), found.encoding)
    rows = csv_files.scan_csv(spark, str(path), names, found.encoding, found.has_multi_line)
    assert names[0] == "Domain Code" and rows.count() == 7
    assert rows.where("Item = 'Blé' AND Flag IS NULL").count() == 1


def test_the_two_counters_disagree_only_on_multi_line_files(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('"a","b"\n"1","plain"\n"2","has\nnewline"\n"3","plain"\n')
    found = csv_files.source_facts(spark, str(path))
    assert found.physical_rows == 4 and found.has_multi_line
    assert csv_files.count_source_rows(spark, str(path), found) == (3, "quote-parity")
    path.write_text('"a","b"\n"1","plain"\n"2","open\nend')
    found = csv_files.source_facts(spark, str(path))
    assert csv_files.count_source_rows(spark, str(path), found) == (2, "quote-parity")


def test_parity_counts_across_blocks(spark, tmp_path):
    rng = random.Random(3)
    cells = ["x", 'say ""hi""', "two\nlines", "a\rb", "crlf\r\nin"]
    rows = [[rng.choice(cells) for _ in range(3)] for _ in range(400)]
    for folder, end in (("lf", "\n"), ("crlf", "\r\n")):
        (tmp_path / folder).mkdir()
        text = end.join(",".join(f'"{c}"' for c in r) for r in [["a", "b", "c"], *rows]) + end
        (tmp_path / folder / "m.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = csv_files.record_counts(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["records"] for r in found] == [400, 400]


def test_a_carriage_return_inside_a_cell_is_no_record_end(store, tmp_path):
    path = tmp_path / "cr.csv"
    path.write_bytes(b'"Name"\n"a\rb"\n"c"\n')
    result = importer.import_csv(store, str(path), "CRX")
    assert (result.row_count, result.source_row_count, result.lossless) == (2, 2, True)


def test_a_damaged_parse_is_not_lossless(store, tmp_path, monkeypatch):
    path = tmp_path / "plain.csv"
    path.write_text("\n".join([HEADER, *CROPS]) + "\n")
    whole = importer.scan_csv
    monkeypatch.setattr(importer, "scan_csv", lambda *a: whole(*a).where("year > 2000"))
    result = importer.import_csv(store, str(path), "CR")
    assert (result.row_count, result.source_row_count, result.lossless) == (3, 7, False)


def test_a_failed_batch_leaves_no_table(spark, store):
    store.replace("kept", spark.range(3).toDF("a"))
    with pytest.raises(RuntimeError), store.batch():
        store.replace("half", spark.range(1).toDF("a"))
        store.replace("kept", spark.range(9).toDF("a"))
        raise RuntimeError
    store.replace("next", spark.range(2).toDF("a"))
    again = Store(spark, store.root)
    assert again.tables() == ["kept", "next"] and again.read("kept").count() == 3
    assert store.tables() == again.tables() and store.read("kept").count() == 3


def test_codes_that_look_alike_keep_their_tables(store, tmp_path):
    for code, rows in (("QC-1", CROPS[:3]), ("QC_1", CROPS[:5]), ("qc 1", CROPS)):
        path = tmp_path / f"{len(rows)}.csv"
        path.write_text("\n".join([HEADER, *rows]) + "\n")
        importer.import_csv(store, str(path), code)
    assert [len(facts(store, c)) for c in ("QC-1", "QC_1", "qc 1")] == [3, 5, 7]
    assert importer.fact_table("CR") == "data_cr"


def test_a_damaged_log_is_an_error(spark, tmp_path):
    root = tmp_path / "bad"
    (root / "table_log").mkdir(parents=True)
    (root / "table_log" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        Store(spark, str(root)).tables()


def test_compaction_frees_disk_and_vacuum_waits(spark, store):
    store.replace("t", spark.range(2000).toDF("a").repartition(24))
    before, after = store.compact("t", grace=0)
    assert after < before and store.read("t").count() == 2000
    store.replace("t", spark.range(5).toDF("a"))
    assert store.vacuum() == [] and len(store.vacuum(older_than=0)) == 1
    assert store.read("t").count() == 5


def test_labelled_view_in_sql(spark, store, tmp_path):
    importer.import_archive(store, pack(tmp_path, "CR"), "CR")
    assert "view_cr_labelled" in importer.register_views(store)
    found = spark.sql("SELECT value FROM view_cr_labelled WHERE area_label = 'Sudland' AND year = 2000")
    assert [r["value"] for r in found.collect()] == [37000]
    assert not list((tmp_path / "store").glob("**/staged-*"))


def test_problems_name_unreadable_and_missing_facts(spark, store):
    assert [r["problem"] for r in builds.problems(store).collect()] == ["no fact table"]
    store.replace("data_e", spark.range(0).toDF("a"))
    store.replace("data_l", spark.range(1).toDF("a"))
    delete_path(spark, store.path("data_l"))
    found = {r["table_name"]: r["problem"].split(":")[0] for r in builds.problems(store).collect()}
    assert found == {"data_e": "empty", "data_l": "unreadable"}


def test_archive_audit(spark, tmp_path):
    good = pack(tmp_path, "GOOD")
    data = bytearray(open(good, "rb").read())
    (tmp_path / "CUT.zip").write_bytes(data[: len(data) // 2])
    with zipfile.ZipFile(tmp_path / "CRC.zip", "w") as archive:
        archive.writestr("a.csv", "a,b\n1,2\n")
    data = bytearray((tmp_path / "CRC.zip").read_bytes())
    data[data.index(b"a,b")] ^= 0xFF
    (tmp_path / "CRC.zip").write_bytes(data)
    paths = [(good,), *[(str(tmp_path / f"{n}.zip"),) for n in ("CUT", "CRC", "GONE")]]
    rows = archives.audit_archives(spark.createDataFrame(paths, "archive string")).collect()
    found = {r["archive"].rsplit("/", 1)[1]: (r["ok"], (r["reason"] or "").split(":")[0], r["bad_member"]) for r in rows}
    assert found == {"GOOD.zip": (True, "", None), "CUT.zip": (False, "bad zip", None), "CRC.zip": (False, "crc mismatch", "a.csv"), "GONE.zip": (False, "missing", None)}
    assert all((r["sha256"] is not None) == r["ok"] for r in rows)


def test_build_records_failures_and_goes_on(spark, store, tmp_path):
    pack(tmp_path, "CR")
    (tmp_path / "BAD.zip").write_bytes(b"no archive")
    entries = [{"DatasetCode": c, "DatasetName": c, "FileRows": "7", "FileSize": "1KB"} for c in ("CR", "BAD", "GONE")]
    (tmp_path / "inventory.json").write_text(json.dumps({"Datasets": {"Dataset": entries}}))
    areas = tmp_path / "areas.csv"
    areas.write_text("area_name,is_country,valid_from,valid_to\nnorland,true,,1991\n")
    listed = inventory.scan_inventory(inventory.read_documents(spark, str(tmp_path / "inventory.json")))
    result = builds.build(store, listed, str(tmp_path), lookup_path=str(areas))
    assert set(result.imported) == {"CR"} and set(result.failed) == {"BAD", "GONE"}
    status = {r["dataset_code"]: (r["import_status"], r["rows_imported"]) for r in store.read("meta_dataset").collect()}
    assert status == {"CR": ("imported", 7), "BAD": ("zip_invalid", None), "GONE": ("failed", None)}
    latest = {r["dataset_code"]: (r["state"], r["error"]) for r in builds.states(store).collect()}
    assert {c: s for c, (s, _) in latest.items()} == {"CR": "imported", "BAD": "zip_invalid", "GONE": "failed"}
    assert latest["GONE"][1] == "missing" and latest["BAD"][1].startswith("bad zip")
    log = store.read("meta_manifest").where("dataset_code = 'CR'").orderBy("updated_at").collect()
    assert [r["state"] for r in log] == ["zip_valid", "importing", "imported"]
    resumed = builds.build(store, listed.where("dataset_code = 'CR'"), str(tmp_path), resume=True)
    assert resumed.skipped == ("CR",) and not resumed.imported and not resumed.failed
    summary = builds.info(store).first()
    assert (summary["datasets_imported"], summary["datasets_failed"]) == (1, 2)
    assert builds.problems(store).count() == 0
    found = {r["area_label"]: (r["is_country"], r["valid_to"]) for r in store.read("area_classification").collect()}
    assert found == {"Norland": (True, 1991), "Sudland": (None, None)}
    pack(tmp_path, "BAD", CROPS[:3])
    again = builds.build(Store(spark, store.root), listed.where("dataset_code = 'BAD'"), str(tmp_path), strict=True)
    assert set(again.imported) == {"BAD"}
    reopened = Store(spark, store.root)
    assert reopened.read("meta_dataset").where("import_status = 'imported'").count() == 2
    assert reopened.read("meta_build").count() == 3
    before, after = reopened.compact("data_cr")
    assert 0 < after <= before and reopened.read("data_cr").count() == 7


def test_datasets_built_side_by_side_equal_single_imports(spark, store, tmp_path):
    """Shared tables take the partitions of all datasets; a failing one spoils no other."""
    codes = [f"D{i}" for i in range(6)]
    for i, code in enumerate(codes):
        pack(tmp_path, code, CROPS[: i + 2] if i != 4 else [r.replace('"15"', '"F1"') for r in CROPS])
    with zipfile.ZipFile(tmp_path / "NOCSV.zip", "w") as archive:
        archive.writestr("readme.txt", "nothing")
    entries = [{"DatasetCode": c, "DatasetName": c} for c in [*codes, "NOCSV"]]
    (tmp_path / "inventory.json").write_text(json.dumps({"Datasets": {"Dataset": entries}}))
    listed = inventory.scan_inventory(inventory.read_documents(spark, str(tmp_path / "inventory.json")))
    result = builds.build(store, listed, str(tmp_path), at_once=4)
    assert set(result.imported) == set(codes) and set(result.failed) == {"NOCSV"}
    assert "no CSV member" in result.failed["NOCSV"]
    single = Store(spark, str(tmp_path / "single"))
    for code in codes:
        importer.import_archive(single, str(tmp_path / f"{code}.zip"), code)
    assert set(single.tables()) < set(store.tables())
    for table in ("dim_area", "dim_item", "dim_flag", "meta_constant_column", "meta_column_mapping", "data_d4", "data_d5"):
        a, b = store.read(table), single.read(table)
        a = a.select(*b.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table
    states = {r["dataset_code"]: r["state"] for r in builds.states(store).collect()}
    assert states == {**{c: "imported" for c in codes}, "NOCSV": "failed"}


def test_members_are_audited_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CHUNK_MEMBERS", 3)
    with zipfile.ZipFile(tmp_path / "M.zip", "w") as archive:
        for i in range(10):
            archive.writestr(f"m{i}.csv", f"member {i}\n")
    assert [c for _, c in archives._chunked(zipfile.ZipFile(tmp_path / "M.zip"))] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    data = bytearray((tmp_path / "M.zip").read_bytes())
    for i in (4, 7):
        data[data.index(f"member {i}".encode())] ^= 0xFF
    (tmp_path / "M.zip").write_bytes(data)
    paths = spark.createDataFrame([(str(tmp_path / "M.zip"),)], "archive string")
    (row,) = archives.audit_archives(paths).collect()
    assert (row["ok"], row["reason"], row["bad_member"]) == (False, "crc mismatch", "m4.csv")


def test_archives_are_read_once_for_facts_and_rows_come_in_large_frames(spark, tmp_path):
    sizes = [len(f) for f in archives._gathered((((str(i), i), 1) for i in range(20000)), ["a", "n"])]
    assert sizes == [8192, 8192, 3616]
    # Members weigh in, so a frame of large directories stays small.
    assert [len(f) for f in archives._gathered((((i,), 5000) for i in range(5)), ["a"])] == [2, 2, 1]
    rows = [(f"{i}.zip", open(pack(tmp_path, "CR"), "rb").read() if i % 3 else b"no archive") for i in range(30)]
    audited = archives.audit_archives(spark.createDataFrame(rows, "archive string, content binary"))
    # What remains to be read are the members, by one step.
    assert audited._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    found = {r["archive"]: (r["ok"], (r["reason"] or "").split(":")[0]) for r in audited.collect()}
    assert found == {f"{i}.zip": (True, "") if i % 3 else (False, "bad zip") for i in range(30)}


def test_flag_legend_keeps_one_description(spark, tmp_path):
    path = tmp_path / "flags.csv"
    path.write_text("Description,Flag\nB text,E\nA text,E\nOfficial,A\nnone,\n")
    legend = lookup.read_flag_legend(spark, str(path), "CR")
    assert {tuple(r) for r in legend.collect()} == {("CR", "E", "A text"), ("CR", "A", "Official")}


def test_random_slices_equal_the_union(spark, store, tmp_path):
    """Merging random slices equals taking each year from its last delivery."""
    rng = random.Random(11)
    expected: dict[int, list] = {}
    for step in range(3):
        years = rng.sample(range(2000, 2005), 2)
        rows = [(2, 15, 5510, y, rng.choice([1, 2.5, 10**12]), rng.choice("AE")) for y in range(2000, 2005) for _ in range(rng.randint(0, 3))]
        rows.append((2, 15, 5510, 1999, 1, "A"))
        path = tmp_path / f"step{step}.csv"
        path.write_text("\n".join([HEADER, *[line(*r) for r in rows]]) + "\n")
        importer.import_csv(store, str(path), "CR", years=Years.of(*years))
        for y in years:
            expected[y] = [(r[3], float(r[4]), r[5]) for r in rows if r[3] == y]
    wide = importer.rebuild_source(store, "CR")
    found = sorted((r["year"], float(r["value"]), r["flag_code"]) for r in wide.collect())
    assert found == sorted(r for rows in expected.values() for r in rows)
