"""Edge rows of profile, reductions, merges, views, enrichment and audits."""

import random

import pytest

from starfold.operators import audit, enrich, merge, profile, reduce, views
from starfold.operators.reduce import Years
from starfold.plans import fixtures
from starfold.sources import manifest


def test_only_uniform_markers_are_stripped(spark):
    rows = [("'004", "'all", "some"), ("'250", "'all", "'one"), (None, "'all", "plain")]
    df = spark.createDataFrame(rows, "marker string, uniform string, mixed string")
    found = {tuple(r) for r in reduce.strip_markers(df).collect()}
    assert found == {("004", "all", "some"), ("250", "all", "'one"), (None, "all", "plain")}


def test_profile_equals_brute_force(spark, monkeypatch):
    """The head probe must never change an answer, however misleading the first rows."""
    monkeypatch.setattr(profile, "HEAD_ROWS", 5)
    rng = random.Random(3)
    makers = [
        lambda i: "7", lambda i: "7" if i < 90 else "8", lambda i: None, lambda i: None if i < 50 else "x",
        lambda i: "1" if i % 2 else "1.0", lambda i: "'a" if i < 99 else "b", lambda i: "'a",
        lambda i: str(i) if i < 95 else "z", lambda i: str(rng.choice([1, 2.5, 3000000000])), lambda i: "" if i % 3 else "q",
    ]
    rows = [(str(1990 + i % 4), *[m(i) for m in makers]) for i in range(100)]
    names = ["year", *[f"c{i}" for i in range(len(makers))]]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)
    for keep, kept in ((None, rows), (Years.of(1991).predicate(df["year"]), [r for r in rows if r[0] == "1991"])):
        found = profile.profile_columns(df, keep)
        for at, name in enumerate(names):
            cells = [r[at] or None for r in kept]
            filled = [c for c in cells if c is not None]
            text = found[name].type_name == "string"
            assert found[name].row_count == len(kept)
            assert found[name].is_stripped == (text and bool(filled) and all(c.startswith("'") for c in filled))
            if name != "year":
                values = set(filled) if text else {float(c) for c in filled}
                constant = not filled or (len(filled) == len(cells) and len(values) == 1)
                assert (found[name].is_constant or found[name].is_doubtful) == constant, name
    layout = reduce.plan_layout(df, "X")
    assert layout.constants["c4"] in ("1.0", "1") and layout.constants["c2"] is None
    assert "c1" not in layout.constants and layout.profiles["c7"].type_name == "string"


def test_year_predicate_keeps_only_whole_numbers(spark):
    df = spark.createDataFrame([("2000",), ("2001",), ("1999-2001",), (None,), (" 2003 ",)], "year string")
    years = lambda y: sorted(r[0] for r in reduce.filter_years(df, y).collect())
    assert years(Years.of(2000)) == ["2000"]
    assert years(Years.of(2000, start=2002)) == [" 2003 ", "2000"]
    assert reduce.filter_years(df.toDF("period"), Years.of(1)).count() == 5


def test_merge_keeps_rows_without_year_and_is_idempotent(spark):
    stored = spark.createDataFrame([(2000, "a"), (2001, "b"), (None, "c")], "year int, v string")
    fresh = spark.createDataFrame([(2001, "B", "n")], "year int, v string, note string")
    once = merge.merge_years(stored, fresh, [2001])
    expected = {(2000, "a", None), (None, "c", None), (2001, "B", "n")}
    assert {tuple(r) for r in once.collect()} == expected
    twice = merge.merge_years(once, fresh, [2001])
    assert {tuple(r) for r in twice.collect()} == expected and twice.count() == 3
    assert merge.merge_years(stored, fresh, []).count() == 3


def test_null_members_are_added_once(spark):
    dim = spark.createDataFrame([("X", "1", "one"), ("X", None, "none")], "dataset_code string, k string, l string")
    more = spark.createDataFrame([("X", None, "none"), ("X", "1", "uno"), ("X", "2", "two")], dim.schema)
    assert merge.append_members(dim, more, "k").count() == 3


def test_labelled_view_fans_out_by_variants_and_keeps_misses(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "item_code int, value int")
    rows = [("X", "1", "one"), ("X", "1", "uno"), ("Y", "2", "two")]
    dim = spark.createDataFrame(rows, "dataset_code string, item_code string, item_label string")
    view = views.labelled_view(fact, "X", {"item": dim})
    assert sorted((r["value"], r["item_label"]) for r in view.collect() if r["item_label"]) == [(10, "one"), (10, "uno")]
    assert view.count() == 4
    assert [tuple(r) for r in reduce.repeated_keys(dim, "item_code").select("item_code").collect()] == [("1",)]
    assert views.labelled_view(fact, "X", {}) is None


def test_labelled_view_suffixes_equal_attribute_names(spark):
    fact = spark.createDataFrame([(1, 2)], "a_code int, b_code int")
    a = spark.createDataFrame([("X", "1", "l")], "dataset_code string, a_code string, note string")
    b = spark.createDataFrame([("X", "2", "r")], "dataset_code string, b_code string, note string")
    row = views.labelled_view(fact, "X", {"a": a, "b": b}).first()
    assert (row["note"], row["note_1"]) == ("l", "r")


LOOKUP = "area_name string, is_country string, valid_from string, valid_to string"


def test_any_label_variant_classifies_an_area(spark):
    rows = [("A", "5801", "Least"), ("B", "5801", "Least (LDCs)"), ("A", "68", "France"), ("A", "9", "Nowhere"), ("A", None, "x")]
    dim = spark.createDataFrame(rows, "dataset_code string, area_code string, area_label string")
    lookup = spark.createDataFrame([(" least (ldcs)", "false", "", ""), ("FRANCE", "true", None, "1991")], LOOKUP)
    areas = enrich.classify_areas(dim, lookup)
    assert {tuple(r)[:3] for r in areas.collect()} == {(5801, "Least (LDCs)", False), (68, "France", True), (9, "Nowhere", None)}
    filled = enrich.fill_validity(areas, lookup)
    assert {(r["area_code"], r["valid_from"], r["valid_to"]) for r in filled.collect()} == {(5801, None, None), (68, None, 1991), (9, None, None)}
    assert enrich.validity_coverage(filled).first()[0] == 1
    assert enrich.fill_validity(filled, lookup).exceptAll(filled).count() == 0
    unlabelled = enrich.classify_areas(dim.drop("area_label"), lookup)
    assert {(r["area_code"], r["is_country"]) for r in unlabelled.collect()} == {(5801, None), (68, None), (9, None)}


def test_hot_archive_still_gives_one_member(spark):
    rows = [("hot", i, f"m{i}.csv", i % 7) for i in range(500)] + [("x", 0, "a.txt", 9), ("x", 1, "Flags.CSV", 3)]
    members = spark.createDataFrame(rows, "archive string, member_index int, name string, size bigint")
    main = {r["archive"]: r["name"] for r in audit.pick_main_member(members, ["member_index"], ["member_index", "name"]).collect()}
    assert main == {"hot": "m6.csv", "x": "Flags.CSV"}
    flags = audit.pick_flag_member(members, ["member_index"], ["name"]).collect()
    assert [(r["archive"], r["name"]) for r in flags] == [("x", "Flags.CSV")]


@pytest.mark.parametrize(
    ("names", "expected"),
    [
        (["flag_code", "description"], ("flag_code", "description")),
        (["text", "my_flag"], ("my_flag", "text")),
        (["flag_code"], ("flag_code", None)),
        (["a", "b"], None),
    ],
)
def test_legend_columns(names, expected):
    assert merge.legend_columns(names) == expected


def test_manifest_log(spark, tmp_path):
    path = tmp_path / "manifest.jsonl"
    path.write_text(
        '{"dataset_code": "A", "state": "downloaded", "attempts": 2, "other": 1}\n\n'
        '{"dataset_code": "B", "state": "failed"}\n{"dataset_code": "A", "state": "imported", "attempts": 3}\n'
    )
    log = manifest.read_log(spark, str(path))
    states = {r["dataset_code"]: (r["state"], r["attempts"]) for r in manifest.current_states(log).collect()}
    assert states == {"A": ("imported", 3), "B": ("failed", None)}
    changes = spark.createDataFrame([("A", 1, "downloaded", "u"), ("A", 2, "imported", None)], "dataset_code string, n int, state string, url string")
    changes = changes.unionByName(log.drop("place", "state", "url", "dataset_code").limit(0), allowMissingColumns=True)
    row = manifest.carried_states(changes, "n").first()
    assert (row["state"], row["url"]) == ("imported", "u")


def test_wide_sources_are_profiled_in_slices(spark, monkeypatch):
    names = [f"c.{i}" for i in range(11)]
    rows = [tuple("7" if i % 3 == 0 else f"'{r}" if i % 3 == 1 else None for i in range(11)) for r in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    whole = [f(df).collect() for f in (profile.profile, profile.infer_types, profile.marker_profile)]
    constant = profile.constant_columns(df).collect()
    monkeypatch.setattr(profile, "SLICE", 4)
    assert [f(df).collect() for f in (profile.profile, profile.infer_types, profile.marker_profile)] == whole
    assert [r.column_name for r in whole[0]] == names
    assert profile.constant_columns(df).collect() == constant
    assert [r.column_name for r in constant] == [n for i, n in enumerate(names) if i % 3 != 1]


def test_only_unevenly_split_tables_are_moved_and_only_before_they_are_widened(spark, tmp_path):
    even = spark.range(0, 800, 1, 8)
    assert fixtures.evenly(even) is even
    for few in (spark.range(800).coalesce(1), spark.range(0, 800, 1, 8).where("id < 200")):
        assert fixtures.evenly(few).rdd.getNumPartitions() == 8 and fixtures.evenly(few).count() == few.count()
    assert fixtures.evenly(spark.range(0)).count() == 0

    nation = spark.range(2).selectExpr("id n_nationkey", "concat('N', id) n_name")
    supplier = spark.range(4).selectExpr("id s_suppkey", "id % 2 s_nationkey")
    part = spark.range(10).selectExpr("id p_partkey", "concat('P', id) p_name")
    lines = spark.range(0, 80, 1, 8).selectExpr(
        "id % 10 l_partkey", "id % 4 l_suppkey", "date'1995-01-01' l_shipdate", "'A' l_returnflag", "'F' l_linestatus",
        "id l_quantity", "repeat('x', 100) l_comment",
    )
    found = []
    for files in (8, 1):
        for name, table in (("nation", nation), ("supplier", supplier), ("part", part), ("lineitem", lines.coalesce(files))):
            table.write.parquet(f"{tmp_path}/{files}/{name}.parquet")
        wide = fixtures.wide_sales(fixtures.Tables(spark, f"{tmp_path}/{files}"))
        plan = wide._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Repartition") == (files == 1)
        # The move lies below every join.
        assert files == 8 or plan.index("Repartition") > plan.rindex("Join")
        assert "l_comment" not in plan.split("Relation")[0]
        found.append(sorted(tuple(r) for r in wide.collect()))
    assert found[0] == found[1] and len(found[0]) == 80
