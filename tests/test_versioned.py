"""Versioned tables: one switch, pruning by keys, changes, versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_root
from tidemark.sinks import files, incremental, versioned

D = [dt.date(2024, 1, n) for n in range(1, 10)]


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rows(spark, *r, schema="k int, v string, day date"):
    return spark.createDataFrame(list(r), schema)


def merge(spark, path, *r, **options):
    return versioned.merge(rows(spark, *r), path, ["k"], ["day"], **options)


def table(spark, path):
    return collect(versioned.read(spark, path))


def test_merge_moves_replaces_and_adds(spark, scratch):
    assert versioned.read(spark, scratch) is None
    merge(spark, scratch, (1, "a", D[0]), (2, "a", D[0]), (3, "a", D[1]), (4, "a", None), (None, "a", D[2]))
    merge(spark, scratch, (1, "b", D[0]), (3, "b", D[2]), (4, "b", D[0]), (9, "b", D[1]), (None, "b", None))
    assert table(spark, scratch) == sorted([(1, "b", D[0]), (2, "a", D[0]), (3, "b", D[2]), (4, "b", D[0]), (9, "b", D[1]), (None, "b", None)], key=repr)
    assert collect(versioned.read(spark, scratch, number=1)) == sorted([(1, "a", D[0]), (2, "a", D[0]), (3, "a", D[1]), (4, "a", None), (None, "a", D[2])], key=repr)
    before, after = ([tuple(r)[:2] for r in versioned.changes(spark, scratch, 1).where(F.col("_change") == c).collect()] for c in ("before", "after"))
    assert sorted(before, key=repr) == sorted([(1, "a"), (3, "a"), (4, "a"), (None, "a")], key=repr) and len(after) == 5
    assert collect(incremental.read_target(spark, scratch)) == table(spark, scratch)


@pytest.mark.parametrize("owner, step", [(versioned, "_write"), (versioned, "_publish"), (files, "rename")])
def test_a_run_that_stops_changes_nothing(spark, scratch, monkeypatch, owner, step):
    merge(spark, scratch, (1, "a", D[0]), (2, "a", D[1]))
    before = table(spark, scratch)

    def boom(*args):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(owner, step, boom)
        merge(spark, scratch, (1, "b", D[3]), (3, "b", D[1]))
    assert table(spark, scratch) == before
    merge(spark, scratch, (1, "c", D[3]))
    assert table(spark, scratch) == [(1, "c", D[3]), (2, "a", D[1])]
    assert versioned.current(spark, scratch).number == 2


def test_two_writers_of_one_version(spark, scratch, monkeypatch):
    merge(spark, scratch, (1, "a", D[0]))
    publish = versioned._publish

    def late(spark_, at):
        monkeypatch.setattr(versioned, "_publish", publish)
        publish(spark_, at)
        publish(spark_, at)
    monkeypatch.setattr(versioned, "_publish", late)
    with pytest.raises(FileExistsError):
        merge(spark, scratch, (1, "b", D[0]))


def test_only_pieces_that_may_hold_a_key_are_read(spark, scratch):
    many = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), F.date_add(F.lit(D[0]), (F.col("id") / 500).cast("int")).alias("day"))
    versioned.merge(many, scratch, ["k"], ["day"])
    at = versioned.current(spark, scratch)
    index, places = versioned._index(spark, at), ["_v", "_p_day"]

    def held(*keys):
        return [r["_p_day"] for r in versioned.may_hold(index, rows(spark, *[(k, "x", D[0]) for k in keys]), ["k"], places).collect()]
    assert held(3) == [D[0]] and sorted(held(3, 1200)) == [D[0], D[2]] and held(5000) == []
    pieces = versioned.may_hold(index, rows(spark, (3, "x", D[0])), ["k"], places).collect()
    scan = versioned._read_pieces(spark, at, pieces)
    assert len(scan.inputFiles()) < len(versioned.read(spark, scratch).inputFiles()) and all("day=2024-01-01" in f for f in scan.inputFiles())
    merge(spark, scratch, (3, "b", D[0]), (1200, "b", D[8]))
    now = versioned.read(spark, scratch)
    assert now.count() == 4000 and collect(now.where("v = 'b'").select("k", "day")) == [(1200, D[8]), (3, D[0])]


def test_hidden_collisions_change_nothing(spark, scratch, monkeypatch):
    monkeypatch.setattr(versioned, "_bit", lambda keys: F.lit(5).cast("long"))  # every key falls on every other
    merge(spark, scratch, *[(k, "a", D[k % 4]) for k in range(40)])
    merge(spark, scratch, (7, "b", D[0]), (100, "b", D[0]))
    got = table(spark, scratch)
    assert len(got) == 41 and [r for r in got if r[1] == "b"] == [(100, "b", D[0]), (7, "b", D[0])]


def test_random_batches(spark, scratch):
    chance, want = random.Random(4), {}
    for _ in range(6):
        batch = {k: (k, str(chance.random()), chance.choice([*D[:3], None])) for k in chance.sample(range(30), 8)}
        merge(spark, scratch, *batch.values())
        want |= batch
        assert table(spark, scratch) == sorted(want.values(), key=repr)


def test_pieces_are_joined(spark, scratch, monkeypatch):
    monkeypatch.setattr(versioned, "PIECES", 3)
    for n in range(5):
        merge(spark, scratch, (n, "a", D[0]))
    at = versioned.current(spark, scratch)
    assert len(versioned._places(versioned._index(spark, at), at)) <= 3
    assert [r[0] for r in table(spark, scratch)] == list(range(5))


def test_versions_of_rows(spark, scratch):
    schema = "k int, v string, n int"
    for batch in ([(1, "b", 2), (2, "x", 1), (3, "x", None)], [(1, "a", 1), (2, "y", 1), (3, "y", None)], [(1, "z", None), (3, "z", 0)], [(1, "c", 3)]):
        versioned.merge(rows(spark, *batch, schema=schema), scratch, ["k"], version="n")
    assert table(spark, scratch) == [(1, "c", 3), (2, "y", 1), (3, "z", 0)]


def test_plain_upsert_ranks_a_missing_version_lowest(spark, scratch):
    for batch in ([(1, "b", 2), (2, "x", None)], [(1, "z", None), (2, "y", None)]):
        incremental.upsert(rows(spark, *batch, schema="k int, v string, n int"), scratch, ["k"], version="n")
    assert collect(spark.read.parquet(scratch)) == [(1, "b", 2), (2, "y", None)]


def test_columns_follow_and_properties_move_with_the_rows(spark, scratch):
    versioned.merge(rows(spark, (1, "x", 5), schema="k int, gone string, n int"), scratch, ["k"], properties={"seen": 1})
    versioned.merge(rows(spark, (2, 7, True), schema="k long, n int, added boolean"), scratch, ["k"])
    out = versioned.read(spark, scratch)
    assert out.columns == ["k", "n", "added"] and collect(out) == [(1, 5, None), (2, 7, True)]
    assert versioned.current(spark, scratch).properties == {"seen": 1}
    assert versioned.merge(out.limit(0), scratch, ["k"]).number == 2
    versioned.merge(out.limit(0), scratch, ["k"], properties={"seen": 2})
    assert versioned.current(spark, scratch).properties == {"seen": 2} and versioned.read(spark, scratch).count() == 2


def test_replace_and_vacuum(spark, scratch):
    for n in range(4):
        merge(spark, scratch, (n, "a", D[0]), (0, str(n), D[1]))
    want = table(spark, scratch)
    versioned.vacuum(spark, scratch, keep=1)
    assert table(spark, scratch) == want and versioned.read(spark, scratch, number=2) is None
    assert versioned.changes(spark, scratch, 1) is None and versioned.changes(spark, scratch, 3).count() == 3
    versioned.replace(rows(spark, (5, "q", D[2])), scratch, ["k"], ["day"])
    assert table(spark, scratch) == [(5, "q", D[2])] and versioned.changes(spark, scratch, 4) is None
    versioned.vacuum(spark, scratch, keep=1)
    assert files.names(spark, f"{scratch}/_data") == ["_v=5"] and table(spark, scratch) == [(5, "q", D[2])]
    versioned.replace(rows(spark, (5, "q", D[2])).limit(0), scratch, ["k"], ["day"])
    assert table(spark, scratch) == []


def test_no_staged_copies_stay(spark, scratch):
    before = set(files.subfolders(spark, scratch_root(spark)))
    for n in range(2):
        merge(spark, scratch, (n, "a", D[0]), (0, str(n), D[1]))
    assert {x.split("-")[0] for x in set(files.subfolders(spark, scratch_root(spark))) - before} == {"test"}


def test_the_rows_of_a_first_version_are_written_once_and_are_its_changes(spark, scratch, monkeypatch):
    labels = []

    def told(df, label="stage", own=versioned.staged):
        labels.append(label)
        return own(df, label)
    monkeypatch.setattr(versioned, "staged", told)
    first = spark.createDataFrame([(1, "a"), (None, None)], "k long, v string")
    versioned.merge(first, scratch, ["k"], properties=lambda new: {"rows": new.count()})
    assert labels == [] and not versioned.files.exists(spark, f"{scratch}/_changes/_v=1")
    assert versioned.current(spark, scratch).properties == {"rows": 2}
    versioned.merge(spark.createDataFrame([(1, "b")], "k long, v string"), scratch, ["k"])
    found = sorted(tuple(r) for r in versioned.changes(spark, scratch, 0).where("k = 1").collect())
    assert found == [(1, "a", "after", 1), (1, "a", "before", 2), (1, "b", "after", 2)]
    assert versioned.changes(spark, scratch, 0).count() == 4
    versioned.vacuum(spark, scratch, keep=1)
    assert versioned.changes(spark, scratch, 0) is None and versioned.read(spark, scratch).count() == 2


def test_a_list_of_changes_holds_the_columns_its_readers_need(spark, scratch):
    merge(spark, scratch, (1, "a", D[0]), (2, "a", D[1]), listed=["v"])
    merge(spark, scratch, (1, "b", D[3]), (3, "b", D[1]), listed=["v"])
    assert spark.read.parquet(f"{scratch}/_changes/_v=2").columns == ["v", "_change"]
    assert collect(versioned.changes(spark, scratch, 0)) == [("a", "after", 1), ("a", "after", 1), ("a", "before", 2), ("b", "after", 2), ("b", "after", 2)]
    merge(spark, scratch, (3, "c", D[1]))
    assert versioned.changes(spark, scratch, 1) is None  # the second version does not tell keys
    assert collect(versioned.changes(spark, scratch, 2)) == [(3, "b", D[1], "before", 3), (3, "c", D[1], "after", 3)]
    assert table(spark, scratch) == [(1, "b", D[3]), (2, "a", D[1]), (3, "c", D[1])]


def test_merged_rows_are_written_once(spark, scratch, monkeypatch):
    labels = []

    def told(df, label="stage", own=versioned.staged):
        labels.append(label)
        return own(df, label)
    merge(spark, scratch, (1, "a", D[0]), (2, "a", D[0]), (3, "a", D[1]))
    monkeypatch.setattr(versioned, "staged", told)
    merge(spark, scratch, (1, "b", D[0]), (4, "b", None), properties=lambda new: {"rows": new.count()})
    assert "merge-new" not in labels
    assert table(spark, scratch) == sorted([(1, "b", D[0]), (2, "a", D[0]), (3, "a", D[1]), (4, "b", None)], key=repr)
    assert versioned.current(spark, scratch).properties == {"rows": 2}  # of the new ones, not of those written again beside them
    assert merge(spark, scratch).number == 2 and files.names(spark, f"{scratch}/_data") == ["_v=1", "_v=2"]  # nothing came, nothing stays
    with pytest.raises(ValueError):
        versioned.merge(rows(spark, (9, "c", D[0])), scratch, ["k", "v"], ["day"])
