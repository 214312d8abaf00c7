import csv
import io
import os
import random

import pytest

from formline.functions import columns as C
from formline.operators import assemble as A
from formline.operators.windows import close_gaps
from formline.sources import catalog, prepared

TYPES = {"minutes": "int", "total_points": "int", "was_home": "boolean"}


def put(path, text, encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def raw(tmp_path):
    """Two seasons: three header variants, an empty file, a stray file, a gap, a double week."""
    root = tmp_path / "raw data"
    old, new = root / "2018-19" / "gws", root / "2019-20" / "gws"
    put(old / "gw1.csv", "name,minutes,total_points\nAnn_Lee_1,90,5\nJosé_Río_2,,1\n")
    put(old / "merged_gw.csv", "name,minutes,total_points\nAnn_Lee_1,90,5\n")
    put(new / "gw1.csv", "name,element,total_points,minutes,was_home\nAnn Lee,1,3,80,True\n")
    put(new / "gw4.csv", "name,element,total_points,minutes,was_home\nAnn Lee,1,2,70,False\n"
        "Ann Lee,1,4,20,True\nNobody,9,1,1,True\n")
    put(new / "gw5.csv", "name,element,total_points,minutes,was_home\n")
    put(new / "gw6.csv", "")
    for season, ids in {"2018-19": "1,Ann,Lee\n2,José,Río\n", "2019-20": "1,Ann,Lee\n"}.items():
        put(root / season / "player_idlist.csv", "id,first_name,second_name\n" + ids, "utf-8")
        put(root / season / "players_raw.csv",
            "first_name,second_name,element_type,team,extra\nAnn,Lee,3,7,z\nJosé,Río,1,8,z\n", "utf-8")
    put(root / "master_team_list.csv",
        "season,team,team_name\n2018-19,7,Reds\n2018-19,8,Blues\n2019-20,7,Greens\n", "utf-8")
    return str(root)


def test_catalog_lists_numbered_weeks_only(spark, rows, raw):
    got = catalog.file_catalog(spark, raw)
    assert rows(got, "season", "step") == [
        ("2018-19", 1), ("2019-20", 1), ("2019-20", 4), ("2019-20", 5)
    ]


def test_weekly_rows_follow_their_own_header(spark, rows, raw):
    got = catalog.read_weekly(spark, raw, TYPES)
    assert rows(got, "season", "step", "player_id", "player_name", "minutes", "total_points") == [
        ("2018-19", 1, "1", "Ann_Lee_1", 90, 5),
        ("2018-19", 1, "2", "José_Río_2", None, 1),
        ("2019-20", 1, "1", "Ann Lee", 80, 3),
        ("2019-20", 4, "1", "Ann Lee", 20, 4),
        ("2019-20", 4, "1", "Ann Lee", 70, 2),
        ("2019-20", 4, "9", "Nobody", 1, 1),
    ]
    assert dict(got.dtypes)["was_home"] == "boolean"


def test_cells_and_headers_survive(spark, rows, tmp_path):
    """Whole numbers with decimals, ids as text, quotes, odd headers, cells that do not fit."""
    put(tmp_path / "2018-19" / "gws" / "gw1.csv",
        "\ufeffname,element,größe,total_points,note\r\nA,1.0,45.0,2,\"x, \"\"y\"\"\"\r\nB,2.0,,3.0,\r\nC,3.0,4.5,x\r\n", "utf-8")
    put(tmp_path / "2018-19" / "gws" / "gw2.csv", "total_points,größe,name\n7,nan,D_4.0\n", "utf-8")
    types = {"minutes": "bigint", "total_points": "int"}
    renames = {"größe": "minutes", "name": "player_name", "element": "player_id"}
    got = catalog.read_weekly(spark, str(tmp_path), types, renames=renames, encoding="UTF-8", corrupt="bad")
    assert rows(got, "step", "player_id", "player_name", "minutes", "total_points", "note", "bad") == [
        (1, "1", "A", 45, 2, 'x, "y"', 0),
        (1, "2", "B", None, 3, None, 0),
        (1, "3", "C", None, None, None, 2),
        (2, "4", "D_4.0", None, 7, None, 0),
    ]
    latin = tmp_path / "latin"
    put(latin / "2018-19" / "gws" / "gw1.csv", "name,größe\nJosé,5\n")
    assert rows(catalog.read_weekly(spark, str(latin), {"größe": "int"}), "player_name", "größe") == [("José", 5)]


def test_a_large_weekly_file_is_read_in_parts(spark, rows, tmp_path):
    lines = [f"Player_{i},{i},{i % 7}" for i in range(3000)]
    put(tmp_path / "2018-19" / "gws" / "gw1.csv", "name,minutes,total_points\n" + "\n".join(lines) + "\n")
    put(tmp_path / "2018-19" / "gws" / "gw2.csv", "minutes,name\r\n5,José_9\r\n")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        raw = catalog._raw_rows(spark, str(tmp_path), catalog.STEP_PATTERN, catalog.SEASON_PATTERN, "ISO-8859-1")
        assert len(raw.inputFiles()) > 4  # one stored file per task that read
        got = rows(catalog.read_weekly(spark, str(tmp_path), TYPES), "step", "player_id", "minutes", "total_points")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert got == sorted([(1, str(i), i, i % 7) for i in range(3000)]) + [(2, "9", 5, None)]


def odd_csv(seed, n):
    """CSV text with quoted line breaks, and its rows as another reader has them."""
    rng = random.Random(seed)
    cells = ["plain", "", 'say "x"', "two\nlines", "a,b", "\n\n", '"', "end\n", '5" pipe', "long " * 30 + "\n" + "x" * 50]
    rows = [[f"P_{i}", rng.choice(cells), str(i)] for i in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["name", "odd\nheader", "minutes"])
    writer.writerows(rows)
    text = out.getvalue()
    # a quote inside an unquoted cell is an ordinary character
    text += 'P_x,5" pipe,7\nP_y,6" pipe,8\n'
    return text, [*rows, ["P_x", '5" pipe', "7"], ["P_y", '6" pipe', "8"]]


@pytest.mark.parametrize("block", ["128m", "512", "150"])
def test_line_breaks_in_quotes_belong_to_their_cell(spark, tmp_path, block):
    """However a file is split, and whatever stands in the others."""
    want = []
    for week, seed in ((1, 1), (2, 2), (3, 3)):
        text, rows_ = odd_csv(seed, 120)
        put(tmp_path / "2018-19" / "gws" / f"gw{week}.csv", text)
        want += [(week, *r) for r in rows_]
    put(tmp_path / "2018-19" / "gws" / "gw4.csv", "name,minutes\nQ_1,5\n")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = catalog.read_weekly(spark, str(tmp_path), {})
        found = [(r["step"], r["player_name"], r["odd\nheader"] or "", r["minutes"]) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert sorted(found) == sorted([*want, (4, "Q_1", "", "5")])


def test_quotes_that_are_never_closed_are_an_error(spark, tmp_path, monkeypatch):
    put(tmp_path / "2018-19" / "gws" / "gw1.csv", 'name,minutes\nA_1,"5\n' + "B_2,6\n" * 50)
    lines = catalog._lines(spark, str(tmp_path), "UTF-8")
    with pytest.raises(ValueError, match="not closed"):
        catalog._records(lines, max_lines=20)


def read_files(df):
    return sorted(os.path.basename(f) for f in df.inputFiles())


def test_only_new_and_changed_weeks_are_read(spark, rows, tmp_path, monkeypatch):
    raw, store = tmp_path / "raw", str(tmp_path / "store")
    week = lambda k: raw / "2018-19" / "gws" / f"gw{k}.csv"
    for k in (1, 2):
        put(week(k), f"name,minutes\nA_1,{k}\nB_2,{k}\n")
    put(raw / "2018-19" / "merged_gw.csv", "name,minutes\nX_9,9\n")
    seen = []
    plain = catalog._lines
    monkeypatch.setattr(catalog, "_lines", lambda *a: seen.append(read_files(df := plain(*a))) or df)

    def stored():
        seen.clear()
        got = rows(catalog.read_weekly(spark, str(raw), {"minutes": "int"}, store=store), "step", "player_id", "minutes")
        read = [f for files in seen for f in files]
        assert got == rows(catalog.read_weekly(spark, str(raw), {"minutes": "int"}), "step", "player_id", "minutes")
        return read

    assert stored() == ["gw1.csv", "gw2.csv"]
    assert stored() == []
    put(week(3), "minutes,name\n7,C_3\n")
    assert stored() == ["gw3.csv"]
    put(week(1), "name,minutes\nA_1,100\n")
    assert stored() == ["gw1.csv"]
    week(2).unlink()
    assert stored() == []
    # a run that fails after writing its rows leaves nothing to be seen
    put(week(5), "name,minutes\nE_5,5\n")
    catalog._raw_rows(spark, [str(week(5))], catalog.STEP_PATTERN, catalog.SEASON_PATTERN, "UTF-8").write.parquet(f"{store}/records/batch=lost")
    assert stored() == ["gw5.csv"]
    monkeypatch.setattr(catalog, "MAX_LISTED", 0)
    put(week(6), "name,minutes\nF_6,6\n")
    stored()
    assert catalog.weekly_store(spark, str(tmp_path / "empty"), str(tmp_path / "none")).collect() == [] if (tmp_path / "empty").mkdir() is None else True


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1", "UTF-16"])
def test_encodings_of_weekly_files(spark, rows, tmp_path, encoding):
    put(tmp_path / "2018-19" / "gws" / "gw1.csv", "name,größe\nJosé_1,5\n", encoding)
    got = catalog.read_weekly(spark, str(tmp_path), {"größe": "int"}, encoding=encoding)
    assert rows(got, "player_name", "größe") == [("José_1", 5)]


def test_ids_written_as_decimals_meet_the_id_list(spark, rows):
    df = spark.createDataFrame([("1.0",), ("12",), ("a.0",), (None,)], "i string")
    assert rows(df.select(C.id_text(df, "i").alias("i"))) == [(None,), ("1",), ("12",), ("a.0",)]


def test_raw_files_to_clean_facts(spark, rows, raw):
    facts = catalog.read_weekly(spark, raw, TYPES)
    attributes = catalog.read_season_lists(
        spark, raw, "players_raw.csv",
        "first_name string, second_name string, element_type int, team int, extra string",
    )
    ids = catalog.read_season_lists(
        spark, raw, "player_idlist.csv", "id int, first_name string, second_name string",
        {"id": "player_id"},
    )
    teams = catalog.read_team_list(
        spark, f"{raw}/master_team_list.csv", "season string, team int, team_name string"
    )
    whole = A.assemble(facts, attributes, ids, teams)
    clean = close_gaps(A.clean_names(whole, "player_name", "player_id"), "season", "step")
    assert rows(clean, "season", "step", "player_name", "element_type", "team_name", "minutes") == [
        ("2018-19", 1, "ann_lee", 3, "Reds", 90),
        ("2018-19", 1, "josé_río", 1, "Blues", None),
        ("2019-20", 1, "ann_lee", 3, "Greens", 80),
        ("2019-20", 2, "ann_lee", 3, "Greens", 20),
        ("2019-20", 2, "ann_lee", 3, "Greens", 70),
    ]


def test_team_list_ids_are_renamed_if_present(spark, tmp_path):
    put(tmp_path / "t.csv", "season,team,team_name,id\n2018-19,7,Reds,3\n")
    assert "team_id" in catalog.read_team_list(spark, str(tmp_path / "t.csv")).columns


def test_homonyms_are_counted(spark, rows):
    ids = spark.createDataFrame(
        [("s", "A", "B", 1), ("s", "A", "B", 2), ("s", "A", "C", 3), ("r", "A", "B", 4)],
        "season string, first_name string, second_name string, player_id int",
    )
    assert rows(A.homonyms(ids)) == [("s", "A_B", 2)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_export_and_stages(spark, rows, tmp_path, fmt):
    df = spark.createDataFrame([(i, float(i), i % 2 == 0, i % 3) for i in range(10)], "k int, x double, b boolean, g int")
    paths = prepared.export_prepared(
        df.where("k < 6"), df.where("k >= 6"), df, str(tmp_path / "out"), fmt, ["g"]
    )
    master = prepared.read_table(spark, paths["master"], fmt)
    assert rows(master, "k", "x", "b", "g") == rows(df)
    halves = prepared.load_stage(
        spark, "fit", train_val_path=paths["train_val_data"], fmt=fmt,
        splitter=lambda d: (d.where("k < 3"), d.where("k >= 3")),
    )
    assert [h.count() for h in halves] == [3, 3]
    assert prepared.load_stage(spark, "test", test_path=paths["test_data"], fmt=fmt).count() == 4
    assert prepared.load_stage(spark, "predict", predict_path=paths["test_data"], fmt=fmt).count() == 4
    assert prepared.load_stage(spark, "validate") is None
    with pytest.raises(ValueError):
        prepared.load_stage(spark, "other")
    for stage in ("fit", "test", "predict"):
        with pytest.raises(AssertionError):
            prepared.load_stage(spark, stage)


def test_demo_table(spark):
    df = spark.range(50).selectExpr("id", "id * 2 as `blood pressure`", "id * 3 as y")
    got = prepared.demo_table(df, ["blood pressure"], "y", "id")
    assert got.columns == ["X_blood_pressure", "Y_target", "split"]
    assert got.where("split = 'test'").count() == 10


def test_names(spark):
    df = spark.createDataFrame([("Jo B_1_10", "1"), ("Jo B_1", "1"), ("Jo", "1")], "n string, i string")
    got = df.select(
        C.clean_name(df.n, df.i).alias("a"), C.clean_name(df.n, df.i, literal=True).alias("b")
    ).collect()
    assert [tuple(r) for r in got] == [("jo_b_1_10", "jo_b0"), ("jo_b", "jo_b"), ("jo", "jo")]


def test_columns(spark):
    df = spark.createDataFrame([(1.0, float("nan"), "2019-20")], "X_a double, `X_b.c` double, s string")
    assert C.columns_with_prefix(df, ["X_"]) == ["X_a", "X_b.c"]
    assert C.select_prefix(df, "X_b").columns == ["X_b.c"]
    assert C.rename_present(df, {"s": "t", "none": "u"}).columns == ["X_a", "X_b.c", "t"]
    assert C.add_prefix(df, ["s"], "P_").columns == ["X_a", "X_b.c", "P_s"]
    assert C.no_nan(df).first()["X_b.c"] is None
    assert df.select(C.season_start_year(df.s), C.id_text(df, "X_a")).first()[:] == (2019, "1")


def test_union_fills_absent_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 5)], "k int, b int")
    assert rows(A.union_all([a, b])) == [(1, "x", None), (2, None, 5)]
    with pytest.raises(ValueError):
        A.union_all([])


def test_records_are_put_together_once(spark, tmp_path):
    """Looking at the headers and reading the rows afterwards share what was put together."""
    put(tmp_path / "2018-19" / "gws" / "gw1.csv", 'name,minutes,note\nAnn_Lee_1,90,"a\nb"\nJo_Li_2,80,c\n')
    got = catalog.read_weekly(spark, str(tmp_path), TYPES)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    assert sorted((r["player_id"], r["note"]) for r in got.collect()) == [("1", "a\nb"), ("2", "c")]
