"""Raw files to a scored season."""

import random

import pandas as pd
import pytest

from formline.models.features import PRESETS, FeatureRoles
from formline.plans import pipeline as L
from formline.plans.prepare import FeaturePlan

STATS = ("minutes", "goals")
PLAN = FeaturePlan(
    entity="player_name",
    period="starting_year",
    step="game_week",
    stats=STATS,
    label="total_points",
    base=("value", "element_type", "game_week", "team_name", "was_home", "previous_total"),
    activity="gw_avg_minutes",
    tiebreak=("fixture",),
    first_input_period=2018,
    first_output_period=2019,
)
LAYOUT = L.RawLayout(
    weekly_types={
        "minutes": "int", "goals": "int", "total_points": "int", "value": "int",
        "was_home": "boolean", "fixture": "int",
    },
    attributes_schema="first_name string, second_name string, element_type int, team int",
    ids_schema="id int, first_name string, second_name string",
    teams_schema="season string, team int, team_name string",
)
ROLES = FeatureRoles(
    numerical=("X_value", "X_game_week", "X_previous_total"),
    categorical=("X_element_type", "X_team_name", "X_was_home"),
    feature_prefixes=("X_value", "X_element_type", "X_rolling_"),
    label="total_points",
)
# Weeks that exist in each season; a gap in one of them.
WEEKS = {"2017-18": [1, 2], "2018-19": [1, 2, 3, 4], "2019-20": [1, 2, 5, 6, 7], "2020-21": [1, 2, 3]}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Files of twelve players, one of whom never plays, and the rows they hold."""
    rng, root, rows = random.Random(5), tmp_path_factory.mktemp("raw"), []
    teams = ["season,team,team_name"]
    for season, weeks in WEEKS.items():
        teams += [f"{season},{t},Team{t}" for t in (1, 2, 3)]
        (root / season / "gws").mkdir(parents=True)
        ids, players = ["id,first_name,second_name"], ["first_name,second_name,element_type,team"]
        for i in range(12):
            ids.append(f"{i},Given{i},Family {i}")
            players.append(f"Given{i},Family {i},{i % 4 + 1},{i % 3 + 1}")
        (root / season / "player_idlist.csv").write_text("\n".join(ids) + "\n")
        (root / season / "players_raw.csv").write_text("\n".join(players) + "\n")
        for place, week in enumerate(weeks):
            lines = ["name,element,minutes,goals,total_points,value,was_home,fixture"]
            for i in range(12):
                if rng.random() < 0.1:
                    continue
                for fixture in range(2 if rng.random() < 0.2 else 1):
                    minutes = 0 if i == 11 else rng.choice([0, 45, 90])
                    goals = rng.randint(0, 2)
                    points = minutes // 45 + 3 * goals
                    home = rng.choice(["True", "False"])
                    lines.append(
                        f"Given{i}_Family {i}_{i},{i},{minutes},{goals},{points},{40 + i},{home},{fixture}"
                    )
                    rows.append((season, weeks[0] + place, f"given{i}_family_{i}", fixture,
                                 minutes, goals, points, 40 + i, i % 4 + 1))
            (root / season / "gws" / f"gw{week}.csv").write_text("\n".join(lines) + "\n")
    (root / "master_team_list.csv").write_text("\n".join(teams) + "\n")
    names = ["season", "week", "name", "fixture", *STATS, "points", "value", "position"]
    return str(root), pd.DataFrame(rows, columns=names)


def restated(data: pd.DataFrame) -> pd.DataFrame:
    data = data.assign(year=data.season.str[:4].astype(int)).query("year >= 2018")
    out = []
    for _, player in data.sort_values(["year", "week", "fixture"]).groupby("name"):
        totals = player.groupby("year").points.sum().shift(1).fillna(0)
        for year, rows in player.groupby("year"):
            rows = rows.copy()
            for s in STATS:
                rows[f"gw_avg_{s}"] = (rows[s].cumsum() / rows.week).shift(1, fill_value=0.0)
                for w in (2, 4, 6):
                    mean = rows[s].rolling(w, min_periods=1).mean().shift(1).fillna(0.0)
                    rows[f"rolling_mean_{w}_{s}"] = mean
            rows["previous_total"] = float(totals[year])
            out.append(rows)
    whole = pd.concat(out).query("year >= 2019")
    active = whole.groupby("name").gw_avg_minutes.sum()
    return whole[whole.name.isin(active[active != 0].index)]


def test_raw_files_to_scored_season(spark, raw, tmp_path):
    root, data = raw
    paths = L.prepare(spark, root, str(tmp_path / "out"), LAYOUT, PLAN, [2019], [2020])
    want = restated(data)
    master = spark.read.parquet(paths["master"]).toPandas()
    keys = ["season", "week", "name", "fixture"]
    master = master.rename(columns={"game_week": "week", "player_name": "name"})
    both = want.merge(master, on=keys, suffixes=("", "_got"))
    assert len(both) == len(want) == len(master)
    computed = [c for c in want.columns if c.startswith(("gw_avg", "rolling"))] + ["previous_total"]
    for c in computed:
        assert both[c].to_numpy() == pytest.approx(both[f"{c}_got"].to_numpy()), c
    assert "given11_family_11" not in set(master.name)

    train = spark.read.parquet(paths["train_val_data"])
    assert train.columns[:2] == ["player_name", "row_key"] and train.columns[-1] == "total_points"
    assert all(c.startswith("X_") for c in train.columns[2:-1])
    assert train.select("row_key").distinct().count() == train.count()
    assert spark.read.parquet(paths["homonyms"]).isEmpty()
    assert master.corrupt_cells.sum() == 0
    assert train.count() == (want.year == 2019).sum()

    trials, models = str(tmp_path / "trials"), str(tmp_path / "models")
    found = L.search_models(
        spark, paths, PRESETS["encoded"](ROLES), "linear_svr", {"epsilon": [0.0, 50.0, 0.5]}, "svr",
        trials, models, fixed={"max_iter": 3},
    )
    assert found.count() == 3
    best = max(found.collect(), key=lambda r: r["metrics"]["val_spearman"] or -2.0)
    assert all("converged" in r["metrics"] for r in found.collect())
    chosen = L.best_trial(L.read_trials(spark, trials), "val_spearman").first()
    assert chosen["metrics"]["val_spearman"] == best["metrics"]["val_spearman"]
    model = L.best_model(spark, trials, models, "svr")
    scored = L.score_season(spark, paths["test_data"], model)
    assert scored.count() == (want.year == 2020).sum()
    assert scored.where("pred_total_points is null").isEmpty()
    assert "X_team_name" in scored.columns


def test_a_lost_period_is_an_error(spark):
    facts = spark.createDataFrame([("a", 2019), ("a", 2020), ("b", 2020), ("c", 2018)], "player_name string, starting_year int")
    L.check_periods(facts, facts.where("starting_year >= 2019"), PLAN)
    with pytest.raises(ValueError, match="lost"):
        L.check_periods(facts, facts.where("player_name = 'a' and starting_year = 2019"), PLAN)
