"""Publication in place, partition by partition, and changes on top of a base:
crashes between steps, several writers, what is cleared and what stays."""

import datetime as dt

import pytest

from martlet.sources import io as sio
from martlet.sources import publish
from martlet.streaming import stream as st

KIND = "year int, name string, v long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def target(spark):
    return sio.scratch_path(spark, "published")


def test_partitions_are_replaced_together(spark, target):
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], KIND)
    assert rows(sio.refresh_partitions(first, target, "year")) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    again = spark.createDataFrame([(2, "B", 20), (2, "B", 21), (4, "d", 4)], KIND)
    got = sio.refresh_partitions(again, target, "year", drop=["3"])
    assert got.columns == first.columns and got.schema["year"].dataType == first.schema["year"].dataType
    assert rows(got) == [(1, "a", 1), (2, "B", 20), (2, "B", 21), (4, "d", 4)]
    # One list names both changes; the partition that stayed is still the first version's folder.
    parts = {r["part"]: r["folder"] for r in publish.listed(spark, target)}
    assert sorted(parts) == ["1", "2", "4"] and parts["1"].split("/")[1] != parts["2"].split("/")[1] == parts["4"].split("/")[1]


@pytest.mark.parametrize("kind,values", [("string", ["a b", "x/y", "1:2", "%25", "ü", None, "001"]), ("date", [dt.date(1999, 1, 2), None])])
def test_values_of_any_kind_part_a_table(spark, target, kind, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, v int")
    assert sio.refresh_partitions(df, target, "k").schema["k"].dataType == df.schema["k"].dataType
    last = spark.createDataFrame([(values[0], 99)], f"k {kind}, v int")
    got = {(r["k"], r["v"]) for r in sio.refresh_partitions(last, target, "k").collect()}
    assert got == {(values[0], 99), *((v, i) for i, v in enumerate(values) if i)}


def test_crash_between_data_and_list(spark, target, monkeypatch):
    """Staged and checked, but never listed: readers see the former state, and the
    stage goes once publications have passed it by."""
    sio.refresh_partitions(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KIND), target, "year")

    def stop(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(publish, "publish", stop)
        with pytest.raises(RuntimeError):
            publish.refresh_partitions(spark.createDataFrame([(2, "B", 20), (3, "c", 3)], KIND), target, "year")
    assert rows(sio.current(spark, target)) == [(1, "a", 1), (2, "b", 2)]
    stale = publish.children(spark, f"{target}/data")
    assert len(stale) == 2
    for i in range(4):
        sio.refresh_partitions(spark.createDataFrame([(1, "a", 10 + i)], KIND), target, "year", keep=2)
    assert rows(sio.current(spark, target)) == [(1, "a", 13), (2, "b", 2)]
    left = publish.children(spark, f"{target}/data")
    kept = {r["folder"].split("/")[1] for n in publish.publications(spark, target) for r in publish.listed(spark, target, n)}
    assert set(left) == kept and len(publish.publications(spark, target)) == 2
    # Of the first version only the partition that is still current is left.
    first = min(left)
    assert [p for p in publish.children(spark, f"{target}/data/{first}") if "=" in p] == ["year=2"]


def test_unfinished_list_is_no_publication(spark, target):
    sio.refresh(spark.range(3), target)
    fs, at = publish._located(spark, f"{target}/versions/number={99:012d}/_temporary")
    fs.mkdirs(at)  # a driver that died while it wrote its list
    assert sio.current(spark, target).count() == 3
    assert sio.refresh(spark.range(4), target).count() == 4
    assert publish._number(publish.publications(spark, target)[-1]) == 100


def test_two_writers_both_land(spark, target):
    """The second finds its number taken and changes the first one's list."""
    sio.refresh_partitions(spark.createDataFrame([(1, "a", 1)], KIND), target, "year")
    other, calls = spark.createDataFrame([(2, "b", 2)], KIND), []

    def change(listed):
        if not calls:  # meanwhile another run publishes
            calls.append(1)
            sio.refresh_partitions(other, target, "year")
        return [*[r for r in listed if r[0] != "1"], *one]

    folder = publish.stage(spark.createDataFrame([(1, "A", 10)], KIND), target, "year")
    layout = publish.listed(spark, target)[0]["layout"]
    one = [("1", f"{folder}/year=1", 1, None, layout)]
    publish.publish(spark, target, change)
    assert rows(sio.current(spark, target)) == [(1, "A", 10), (2, "b", 2)]


def test_a_reader_keeps_its_state(spark, target):
    """A frame made before a publication can still be read behind it."""
    before = sio.refresh(spark.range(3), target)
    sio.refresh(spark.range(5), target)
    assert before.count() == 3 and sio.current(spark, target).count() == 5


def test_stage_is_validated(spark, target):
    sio.refresh_partitions(spark.createDataFrame([(1, "a", 1)], KIND), target, "year")
    with pytest.raises(ValueError, match="failed validation"):
        sio.refresh_partitions(spark.createDataFrame([(1, None, 1)], KIND), target, "year", required=["name"])
    with pytest.raises(ValueError, match="failed validation"):
        sio.refresh_partitions(spark.createDataFrame([], KIND), target, "year")
    assert rows(sio.current(spark, target)) == [(1, "a", 1)]


# ---------------------------------------------------------------- base and changes


def test_changes_merge_and_files_stay_few(spark, target):
    """Forty batches: as many files at the end as after ten, and the same rows as without merging."""
    sink = st.upsert_sink(target, ["k"], every=4)
    want, folders = {}, []
    for batch in range(40):
        some = {batch % 7: batch, None: batch} if batch % 3 else {batch % 5: -batch}
        want.update(some)
        sink(spark.createDataFrame(list(some.items()), "k int, v int").coalesce(1), batch)
        if batch % 10 == 9:
            folders.append(sum(len(publish.children(spark, f"{target}/{x}")) for x in ("deltas", "data", "versions")))
            assert {r["k"]: r["v"] for r in st.latest_per_key(spark, target, ["k"]).collect()} == want
    assert max(folders) <= 4 * 4 + 6


def test_replayed_batches_change_nothing(spark, target):
    frames = [spark.createDataFrame([(1, n), (n, n)], "k int, v int") for n in range(6)]
    sink = st.upsert_sink(target, ["k"], every=3)
    for n in (0, 1, 2, 2, 3, 4, 5, 5):
        sink(frames[n], n)
    assert rows(st.latest_per_key(spark, target, ["k"])) == [(0, 0), (1, 5), (2, 2), (3, 3), (4, 4), (5, 5)]
    sink(frames[5], 5)  # a crash behind the merge: the batch comes again
    assert rows(st.latest_per_key(spark, target, ["k"])) == [(0, 0), (1, 5), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_crash_before_the_merge_is_published(spark, target, monkeypatch):
    sink = st.upsert_sink(target, ["k"], every=2)
    sink(spark.createDataFrame([(1, 1)], "k int, v int"), 0)

    def stop(*_, **__):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(publish, "publish", stop)
        with pytest.raises(RuntimeError):
            sink(spark.createDataFrame([(1, 2), (3, 3)], "k int, v int"), 1)
    assert rows(st.latest_per_key(spark, target, ["k"])) == [(1, 2), (3, 3)]
    sink(spark.createDataFrame([(1, 2), (3, 3)], "k int, v int"), 1)
    assert rows(st.latest_per_key(spark, target, ["k"])) == [(1, 2), (3, 3)] and publish.listed(spark, target)[0]["upto"] == 1


def test_sink_without_merging(spark, target):
    sink = st.upsert_sink(target)
    for n in range(3):
        sink(spark.createDataFrame([(1, n)], "k int, v int"), n)
    assert rows(st.latest_per_key(spark, target, ["k"])) == [(1, 2)] and publish.listed(spark, target) == []


# ---------------------------------------------------------------- runs that overlap


def shipments(spark, *numbers):
    return spark.createDataFrame([(n, i) for i, n in enumerate(numbers)], "shipment_number string, line int")


def test_interleaved_runs_report_once(spark, target):
    from martlet.plans import runs

    one = runs.begin(shipments(spark, "a", "b"), target, "p")
    two = runs.begin(shipments(spark, "b", "c"), target, "p")
    three = runs.begin(shipments(spark, "a", "c"), target, "p")
    other = runs.begin(shipments(spark, "a"), target, "q")  # another process has a ledger of its own
    sent = [sorted(r["shipment_number"] for r in runs.finish(x, target).collect()) for x in (two, other, one, three)]
    assert sent == [["b", "c"], ["a"], ["a"], []]
    assert sorted(r[0] for r in runs.ledger_keys(spark, target, "p").collect()) == ["a", "b", "c"]
    assert [len(runs.reports(spark, target, p)) for p in "pq"] == [2, 1]


def test_a_run_that_dies_has_reported_nothing(spark, target):
    from martlet.plans import runs

    runs.begin(shipments(spark, "a"), target, "p")  # never finished
    assert runs.ledger_keys(spark, target, "p") is None
    assert runs.report_once(shipments(spark, "a", "b"), target, "p").count() == 2


def test_old_runs_move_into_the_base(spark, target):
    """Keys of runs long ago still stop a second report; list and folders stay few."""
    from martlet.plans import runs

    for n in range(12):
        assert runs.report_once(shipments(spark, f"s{n}"), target, "p", runs=2).count() == 1
    assert runs.report_once(shipments(spark, *[f"s{n}" for n in range(12)], "new"), target, "p", runs=2).count() == 1
    assert len(publish.listed(spark, target)) <= 5 and len(runs.reports(spark, target, "p")) <= 4
    assert len(publish.children(spark, f"{target}/data")) <= 12
    assert runs.logged(spark, target, "p", "2000-01-07 09:00:00").count() == 13


# ---------------------------------------------------------------- CSV files with junk lines


@pytest.mark.parametrize("size", [40, 333, 1 << 20])
def test_csv_records_over_splits(spark, tmp_path, size):
    """Quoted breaks, quotes and separators, wherever a split ends; junk lines
    with an odd quote; Windows line ends; files of a few lines."""
    import csv
    import io as text_io
    import random

    from pyspark.sql import types as T

    rng, want = random.Random(2), []
    for name, n in (("a", 60), ("b", 1), ("c", 0)):
        out = text_io.StringIO()
        writer = csv.writer(out, lineterminator="\r\n" if name == "b" else "\n")
        writer.writerow(["id", "the\nnote", "v"])
        for i in range(n):
            note = "".join(rng.choice(['"', ",", "\n", "x", "é", " y", '""', "\n\n"]) for _ in range(rng.randint(1, 12))) + "."
            want.append((len(want), note, float(i)))
            writer.writerow([want[-1][0], note, want[-1][2]])
        (tmp_path / f"{name}.csv").write_bytes(('junk "line\nmore, junk\n' + out.getvalue()).encode())
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("v", T.DoubleType())])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = sio.read_csv_skip(spark, str(tmp_path), schema, skip_rows=2, quoted_breaks=True).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in got) == want
