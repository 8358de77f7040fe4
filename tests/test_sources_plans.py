import pytest
from conftest import rows

from matchspark.functions import text
from matchspark.operators.rollup import roll_up
from matchspark.plans.merge import merge_matches
from matchspark.plans.notebook import exploratory_merge
from matchspark.plans.report import profile_matches, write_profile
from matchspark.session import INITIAL_PARTITIONS
from matchspark.sources import files
from matchspark.streaming.rollup import MomentState, latest_rollup, player_stream, stream_moments, stream_rollup


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_types_and_missing_texts(spark, tmp_path):
    path = write(
        tmp_path, "a.csv",
        "ID,n,x,t,b,gone,big\n1,5,1.5,abc,True,,9223372036854775808\n2,NA,NaN,null,False,,1\n3,,1e3,x y,,NaN,2\n",
    )
    df = files.read_csv(spark, path)
    assert dict(df.dtypes) == {
        "ID": "bigint", "n": "bigint", "x": "double", "t": "string", "b": "boolean", "gone": "double", "big": "double"
    }
    assert rows(df.drop("big")) == [
        (1, 5, 1.5, "abc", True, None), (2, None, None, None, False, None), (3, None, 1000.0, "x y", None, None)
    ]
    assert files.read_csv(spark, path, ["x", "ID"]).columns == ["ID", "x"]
    with pytest.raises(ValueError):
        files.read_csv(spark, path, ["absent"])


def test_late_misfits_become_null(spark, tmp_path):
    path = write(tmp_path, "p.csv", "ID,x,name\n1,1.0,a\n1,2.0,b\n2,oops,c\n")
    df = files.read_player_csv(spark, path, rows=2)
    assert df.dtypes == [("ID", "bigint"), ("x", "double")]
    assert rows(df) == [(1, 1.0), (1, 2.0), (2, None)]
    assert rows(files.misfits(spark, path, df.schema)) == [("ID", 0), ("x", 1)]
    # by default all rows decide: x is text
    assert files.read_player_csv(spark, path).columns == ["ID"]


def test_late_decimals_are_kept(spark, tmp_path):
    path = write(tmp_path, "l.csv", "ID,x\n" + "".join(f"{i},{i}\n" for i in range(30)) + "a1,1.5\n31,2.25\n")
    for sample in (None, 10):
        df = files.read_player_csv(spark, path, rows=sample)
        assert df.dtypes == [("ID", "string"), ("x", "double")]
        assert {(r.ID, r.x) for r in df.where("x <> floor(x)").collect()} == {("a1", 1.5), ("31", 2.25)}


def test_quoted_fields(spark, tmp_path):
    path = write(tmp_path, "q.csv", 'ID,t,x\n1,"say ""hi"", ok",3\n2," a ""b""\nc ",4\n')
    df = files.read_csv(spark, path, multiline=True)
    assert rows(df) == [(1, 'say "hi", ok', 3), (2, ' a "b"\nc ', 4)]
    again = files.read_csv(spark, files.write_table(df, str(tmp_path / "again"), "csv"), multiline=True)
    assert rows(again) == rows(df)
    with pytest.raises(ValueError):
        files.read_player_csv(spark, write(tmp_path, "q.csv", "k,x\n1,2\n"))


def test_discovery(spark, tmp_path):
    write(tmp_path, "b/z_home_team_1.csv", "ID\n1\n")
    write(tmp_path, "b/home_team.txt", "ID\n")
    write(tmp_path, "home_team_dir/x.csv", "ID\n")
    write(tmp_path, "a.home_team.csv/part-0.csv", "ID\n5\n")
    found = files.discover_file(spark, str(tmp_path), "home_team")
    assert found.endswith("/a.home_team.csv")
    assert files.discover_file(spark, str(tmp_path), "away_team") is None
    assert files.discover_file(spark, str(tmp_path / "absent"), "x") is None
    assert files.read_optional(spark, str(tmp_path), "away_team") is None
    assert rows(files.read_optional(spark, str(tmp_path), "z_home_team")) == [(1,)]
    inputs = files.discover_inputs(spark, str(tmp_path), None)
    assert len(inputs) == 8 and inputs["test_home_team"] is None
    with pytest.raises(FileNotFoundError):
        files.require_teams(inputs)


def test_label_sources(spark, tmp_path):
    good = write(tmp_path, "y.csv", "x,ID,HOME_WINS,DRAW,AWAY_WINS\n0,1,1,0,0\n")
    assert rows(files.read_labels(spark, good)) == [(1, 1, 0, 0)]
    assert files.read_labels(spark, None) is None and files.read_goal_differences(spark, None) is None
    with pytest.raises(ValueError):
        files.read_goal_differences(spark, good)


def test_parquet_nan_is_null(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "ID int, x double").write.parquet(path)
    assert rows(files.read_table(spark, path)) == [(1, None), (2, 1.0)]
    assert files.read_table(spark, path, ["ID"]).columns == ["ID"]


def test_sorted_sink(spark, tmp_path):
    df = spark.range(100).selectExpr("99 - id as ID")
    for partitions in (None, 3):
        path = files.write_table(df, str(tmp_path / f"s{partitions}"), "parquet", "ID", partitions)
        parts = sorted((tmp_path / f"s{partitions}").glob("*.parquet"))
        read = [r[0] for p in parts for r in spark.read.parquet(str(p)).collect()]
        assert read == list(range(100)) and path


@pytest.fixture
def raw(tmp_path):
    for split, ids in (("train", (1, 2, 3)), ("test", (4, 5))):
        folder = tmp_path / split
        for side in ("home", "away"):
            team = "".join(f"{i},{i * 1.5},L{i}\n" for i in reversed(ids))
            write(folder, f"{split}_{side}_team_statistics.csv", "ID,TEAM_SHOTS,LEAGUE\n" + team)
            players = "".join(f"{i},{i + p},N{p}\n" for i in ids for p in range(3))
            write(folder, f"{split}_{side}_player_statistics.csv", "ID,PLAYER_GOALS,NAME\n" + players)
    write(tmp_path, "y.csv", "ID,HOME_WINS,DRAW,AWAY_WINS\n1,1,0,0\n3,0,0,1\n")
    write(tmp_path, "supp.csv", "ID,GOAL_DIFF_HOME_AWAY\n1,2\n2,0\n3,-1\n")
    return tmp_path


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_merge(spark, raw, fmt):
    paths = merge_matches(
        spark, str(raw / "train"), str(raw / "test"), str(raw / "out"), str(raw / "y.csv"), str(raw / "supp.csv"), fmt=fmt
    )
    read = spark.read.option("header", True).option("inferSchema", True).format(fmt)
    train = read.load(paths["train"])
    assert rows(train, "ID") == [(1,), (2,), (3,)]
    assert {"home_teamTEAM_SHOTS", "away_player_PLAYER_GOALS_std", "home_player_player_count"} <= set(train.columns)
    assert rows(read.load(paths["y_train_aligned"])) == [(1, 1, 0, 0), (2, None, None, None), (3, 0, 0, 1)]
    missing = spark.read.json(paths["y_train_aligned_missing"]).first()
    assert (missing["missing"], missing["n_rows"]) == (1, 3)
    schema = {r["dataset"]: r for r in spark.read.json(paths["schema"]).collect()}
    assert schema["train"]["n_rows"] == 3 and schema["test"]["n_rows"] == 2
    assert schema["train"]["columns_sample"][0] == "ID" and len(schema["train"]["columns_sample"]) == 10


def test_merge_without_teams_stops(spark, raw):
    with pytest.raises(FileNotFoundError):
        merge_matches(spark, str(raw / "train"), str(raw / "absent"), str(raw / "out"))


def test_profile_reports(spark, raw):
    paths = merge_matches(
        spark, str(raw / "train"), str(raw / "test"), str(raw / "out"), str(raw / "y.csv"), str(raw / "supp.csv")
    )
    read = {k: spark.read.parquet(paths[k]) for k in ("train", "test", "y_train_aligned", "y_train_supp_aligned")}
    reports = profile_matches(*read.values())
    assert reports["missing_labels"].first()["missing_labels"] == 1
    assert reports["overlap"].first()["shared_ids"] == 0
    assert reports["goal_difference"].first()["p50"] == 0.0
    written = write_profile({k: reports[k] for k in ("shapes", "classes")}, str(raw / "profile"))
    assert spark.read.json(written["shapes"]).count() == 4


# -- streaming ------------------------------------------------------------------------------


@pytest.fixture
def player_files(spark, tmp_path):
    df = spark.range(60).selectExpr(
        "if(id % 10 = 0, null, id % 7) as ID", "cast(if(id % 5 = 0, null, id) as double) as x", "'t' as name"
    )
    folder = str(tmp_path / "players")
    for part in range(4):
        df.where(f"ID is null or cast(x as int) % 4 = {part} or (x is null and {part} = 0)").coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.read.parquet(folder)


def test_stream_equals_batch(spark, player_files, tmp_path):
    folder, batch = player_files
    stream = player_stream(spark, folder, batch.schema, files_per_batch=1)
    out = str(tmp_path / "out")
    running = stream_rollup(stream, out, str(tmp_path / "progress"))
    running.awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) > 1
    for a, b in zip(rows(latest_rollup(spark, out)), rows(roll_up(batch))):
        assert a == pytest.approx(b)


def test_moment_state_equals_batch_and_survives_replay(spark, player_files, tmp_path):
    folder, batch = player_files
    stream = player_stream(spark, folder, batch.schema, files_per_batch=1)
    running, state = stream_moments(stream, str(tmp_path / "state"), str(tmp_path / "progress2"))
    running.awaitTermination()
    expected = rows(roll_up(batch, moments="population_rows"))
    check = lambda df: all(a == pytest.approx(b) for a, b in zip(rows(df), expected, strict=True))
    assert check(state.rollup())
    # a compaction up to batch 1 plus the later batches says the same
    base = state.compact(1, str(tmp_path / "base"))
    assert check(state.rollup(after=1, base=base))


def test_replayed_batch_is_not_counted_twice(spark, tmp_path):
    rows_in = spark.createDataFrame([(1, 2.0), (1, 4.0)], "ID int, x double")
    state = MomentState(spark, str(tmp_path / "s"), ["x"])
    state.add_batch(rows_in, 0)
    state.add_batch(rows_in, 0)
    state.add_batch(rows_in, 1)
    assert rows(state.rollup("p_")) == [(1, 12.0, 3.0, 1.0, 4)]


ODD_TEXTS = [
    "1", "-1", "+7", " 12 ", "1.5", ".5", "5.", "-.5", "1e5", "1E-3", "1e", "1d", "1f", "0x1p3", "0X1P3", "x1", "1x1", "--5", "- 5", "5-", "+-3", "1,5", "1/2",
    ",5", "/5", ".", "..5", "1.2.3", "1 2", "inf", "Infinity", "-inf", "INF", "NaN", "naN", "true", "TRUE", "tRUE", "False", "truth", "t", "9223372036854775807",
    "9223372036854775808", "1e999", "99999999999", "\t3\t", "3\n", "\x013", "3\x00", "١٢", "1٢3", "é1", "1é", "12é3", "a", "", " ", "NA", "1.#IND", "-1.#IND", "U1", "G7", None,
]


def test_types_of_odd_texts_are_told_as_by_three_patterns(spark):
    known = [t for t in ODD_TEXTS if t is not None and t not in files.MISSING_TEXTS]
    texts = spark.createDataFrame([(t,) for t in known], "v string")
    whole = f"{text.matches('v', files.INTEGER_PATTERN)} AND try_cast(v AS bigint) IS NOT NULL"
    patterns = (whole, text.matches("v", text.NUMBER_PATTERN), text.matches("v", files.TRUTH_PATTERN))
    told = texts.selectExpr(files._shape("v"), *patterns).collect()
    for t, (shape, *flags) in zip(known, told):
        assert shape == next((kind for kind, is_it in enumerate(flags) if is_it), files.TEXT), t


def test_type_inference_has_one_piece_of_code_for_all_columns(spark, tmp_path, monkeypatch):
    """A pattern per column and kind made generated code that grew with the width."""
    path = write(tmp_path, "wide.csv", "\n".join([",".join(f"c {i}" for i in range(40)), ",".join(["1", "2.5", "true", "x"] * 10), "," * 39, ",".join(["-2", "1", "false", "3"] * 10)]))
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    kinds = [f.dataType.simpleString() for f in files.infer_types(files._as_texts(spark, path, None))]
    assert kinds == ["bigint", "double", "boolean", "string"] * 10
    assert len(plans) == 1 and plans[0].count("RLIKE") == 3
    assert files.infer_types(spark.createDataFrame([], "a string, b string")).simpleString() == "struct<a:double,b:double>"


def test_exploratory_merge_joins_each_split_once_in_small_tasks(spark):
    """The memory of a task followed the table: all joins of both splits met in one task per session partition."""
    ids = spark.range(4000).withColumnRenamed("id", "match_id")
    team = ids.selectExpr("match_id", "match_id * 1.0D AS rank", "match_id % 7 AS form")
    player = ids.selectExpr("match_id", "match_id * 2.0D AS goals").unionAll(ids.selectExpr("match_id", "match_id * 4.0D AS goals"))
    labels = ids.selectExpr("match_id AS ID", "1 AS HOME_WINS", "0 AS DRAW", "0 AS AWAY_WINS")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1024"}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = exploratory_merge([team, team, player, player], [team, team, player, player], labels)
        assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    finally:
        for name in (*small, "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
    for split in ("train", "test"):
        assert "Join" not in merged[split]._jdf.queryExecution().optimizedPlan().toString()
        assert len(merged[split].inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(merged["train"].where("match_id = 3"), "home_team_rank", "home_player_goals_sum", "away_player_goals_mean") == [(3.0, 18.0, 9.0)]
    assert merged["train"].count() == merged["test"].count() == 4000
