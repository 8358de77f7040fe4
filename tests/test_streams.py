import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspark.operators.rollup import roll_up
from matchspark.queries import catalog
from matchspark.sources.files import misfits, read_csv
from matchspark.streaming.rollup import (
    TieredState,
    csv_player_stream,
    latest_rollup,
    player_stream,
    read_through,
    stream_misfits,
    stream_rollup,
    stream_tiers,
)

TYPES = T.StructType([T.StructField("ID", T.LongType()), T.StructField("goals", T.DoubleType()), T.StructField("pass %", T.DoubleType())])
FILES = (
    'ID,name,goals,pass %\n1,"a, b",3,NA\n2,x,,12\n1,y,4,nan\n,z,1,1\n',
    "ID,name,goals,pass %\n1,a,2.5,17.25\n3,n/a,many,#N/A\n2,x, 7 ,0\n",
    "ID,name,goals,pass %\n3,a,1e2,-\n4,,NULL,none\n",
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i, text in enumerate(FILES):
        (tmp_path / "in" / f"part-{i}.csv").write_text(text)
    return str(tmp_path / "in")


def test_csv_stream_equals_the_batch_and_counts_misfits(spark, folder, tmp_path):
    stream = csv_player_stream(spark, folder, ["ID", "name", "goals", "pass %"], TYPES, files_per_batch=1)
    assert stream.columns == ["ID", "goals", "pass %"]
    running = stream_rollup(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    running.awaitTermination()
    batch = read_csv(spark, folder, TYPES.names, TYPES)
    got, want = latest_rollup(spark, str(tmp_path / "out")), roll_up(batch)
    assert rows(got, *sorted(map(lambda c: f"`{c}`", got.columns))) == rows(want, *sorted(map(lambda c: f"`{c}`", got.columns)))
    assert stream_misfits(running) == {"_rows": 9, "ID": 0, "goals": 1, "pass %": 2}
    assert {r.feature: r.n_misfits for r in misfits(spark, folder, TYPES).collect()} == {"ID": 0, "goals": 1, "pass %": 2}


def test_misfits_are_counted_without_state_or_output(spark, sf_dir, folder, tmp_path):
    stream = csv_player_stream(spark, folder, ["ID", "name", "goals", "pass %"], TYPES, files_per_batch=1)
    running = read_through(stream, str(tmp_path / "progress"))
    running.awaitTermination()
    assert stream_misfits(running) == {"_rows": 9, "ID": 0, "goals": 1, "pass %": 2}
    assert not any(p.stateOperators for p in running.recentProgress) and len(running.recentProgress) == 3


def test_the_misfit_query_keeps_no_state(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog, "stream_misfits", lambda running: seen.append(running) or stream_misfits(running))
    found = {r.feature: r.n_misfits for r in catalog.QUERIES["csv_stream_misfits"](spark, sf_dir).collect()}
    assert found["_rows"] == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() and found["l_tax"] > 0
    assert not any(p.stateOperators for p in seen[0].recentProgress)


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select((F.col("id") % 5).alias("ID"), (F.col("id") * 1.0).alias("v"))


def plain(df):
    return rows(df, "ID", "v_sum", "v_mean", "v_std", "player_count")


def test_tiers_are_the_digits_of_the_number_of_batches(spark, tmp_path):
    state = TieredState(spark, str(tmp_path), ["v"], fanout=3)
    name = lambda tier, upto: f"{tmp_path}/tier={tier}/upto={upto}"
    assert state.tables(1) == [name(0, 1)] and state.tables(3) == [name(1, 3)]
    assert state.tables(5) == [name(1, 3), name(0, 4), name(0, 5)]
    assert state.tables(50) == [name(3, 27), name(2, 36), name(2, 45), name(1, 48), name(0, 49), name(0, 50)]
    for n in range(1, 300):
        assert len(state.tables(n)) <= 2 * 6 and len(set(state.tables(n))) == len(state.tables(n))


def test_batches_and_folds_can_be_replayed(spark, tmp_path):
    state = TieredState(spark, str(tmp_path / "s"), ["v"], fanout=3)
    with pytest.raises(ValueError):
        state.rollup()
    whole = lambda n: plain(finish(spark, tmp_path, n))
    for batch in range(11):
        state.add_batch(numbers(spark, batch * 20, batch * 20 + 20), batch)
        if batch in (2, 4, 8):  # also the batch that folds a tier
            state.add_batch(numbers(spark, batch * 20, batch * 20 + 20), batch)
        if batch in (0, 2, 4, 8, 10):
            assert state.finished() == batch + 1
            assert plain(state.rollup()) == whole(batch + 1)
    with pytest.raises(ValueError):
        state.read(after=1)


def finish(spark, tmp_path, batches):
    """The roll-up of the same rows from one batch."""
    state = TieredState(spark, str(tmp_path / f"whole-{batches}"), ["v"])
    state.add_batch(numbers(spark, 0, batches * 20), 0)
    return state.rollup()


def test_a_torn_note_of_the_last_batch_leaves_the_one_before(spark, tmp_path):
    state = TieredState(spark, str(tmp_path), ["v"], fanout=2)
    for batch in range(3):
        state.add_batch(numbers(spark, batch, batch + 9), batch)
    for f in (tmp_path / "finished" / "place=1").iterdir():
        f.unlink()
    assert state.finished() == 2
    assert plain(state.rollup())[0][-1] == 3


def test_long_stream_is_read_from_few_tables(spark, tmp_path):
    numbers(spark, 0, 500).repartition(50).write.parquet(str(tmp_path / "in"))
    stream = player_stream(spark, str(tmp_path / "in"), numbers(spark, 0, 1).schema, files_per_batch=1)
    running, state = stream_tiers(stream, str(tmp_path / "s"), str(tmp_path / "p"), fanout=4)
    running.awaitTermination()
    assert state.finished() == 50 and len(state.tables(50)) == 3 + 0 + 2
    assert plain(state.rollup()) == plain(finish(spark, tmp_path, 25))
