"""History and vault loaded a day or a batch at a time, against builds from scratch."""

import datetime as dt
import random

import pytest

from martlet.plans import history

D0 = dt.date(2000, 1, 1)
HISTORY = "k string, value string, valid_from date, valid_to date, is_current boolean"


def day(n):
    return D0 + dt.timedelta(n)


def rows(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns or df.columns).collect())))


def replayed(days, deletions):
    """Brute force: the rows of each key, day by day."""
    out, open_ = [], {}
    for n, snap in sorted(days.items()):
        for k in list(open_):
            gone = k not in snap
            if gone and not deletions or not gone and snap[k] == open_[k][0]:
                continue
            v, start = open_.pop(k)
            out.append((k, v, start, day(n - 1), False))
        for k, v in snap.items():
            open_.setdefault(k, (v, day(n)))
    return out + [(k, v, start, None, True) for k, (v, start) in open_.items()]


@pytest.mark.parametrize("deletions", [False, True])
def test_merge_equals_brute_force_day_by_day(spark, deletions):
    rng = random.Random(3)
    keys = ["a", "b", "c", "d", None]
    days = {n: {k: rng.choice(["x", "y", None]) for k in keys if rng.random() < 0.7} for n in (1, 2, 3, 5, 9)}
    state = spark.createDataFrame([], HISTORY)
    for n, snap in days.items():
        frame = spark.createDataFrame([(k, v) for k, v in snap.items()], "k string, value string")
        state = spark.createDataFrame(history.scd2_merge(state, frame, "k", str(day(n)), deletions=deletions).collect(), HISTORY)
        want = replayed({m: s for m, s in days.items() if m <= n}, deletions)
        assert rows(state) == sorted(map(repr, want))
        again = history.scd2_merge(state, frame, "k", str(day(n)), deletions=deletions)
        assert rows(again) == rows(state)  # a second run of a day adds nothing


def test_merge_equals_build(spark):
    snaps = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("b", 2, None), ("b", 3, None), ("b", 5, "y"), ("a", 5, "x"), (None, 3, "z")]
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in snaps], "k string, snapshot_date date, value string")
    state = spark.createDataFrame([], HISTORY)
    for n in (1, 2, 3, 5):
        state = history.scd2_merge(state, df.where(df.snapshot_date == day(n)).drop("snapshot_date"), "k", str(day(n)))
    built = history.scd2(df, "k")
    assert rows(state, *built.columns) == rows(built)


def test_corrected_snapshot_replaces_the_day(spark):
    kind = "k string, value string"
    one = history.scd2_merge(spark.createDataFrame([], HISTORY), spark.createDataFrame([("a", "x"), ("b", "x")], kind), "k", "2000-01-01")
    wrong = history.scd2_merge(one, spark.createDataFrame([("a", "y"), ("c", "x")], kind), "k", "2000-01-02", deletions=True)
    mended = history.scd2_merge(wrong, spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "z")], kind), "k", "2000-01-02", deletions=True)
    assert rows(mended) == sorted(map(repr, [("a", "x", day(0), None, True), ("b", "x", day(0), day(0), False), ("b", "z", day(1), None, True)]))
    with pytest.raises(Exception, match="holds days after"):
        history.scd2_merge(mended, spark.createDataFrame([("a", "x")], kind), "k", "2000-01-01").collect()


def test_empty_snapshot_closes_all_or_nothing(spark):
    state = spark.createDataFrame([("a", "x", day(0), None, True)], HISTORY)
    none = spark.createDataFrame([], "k string, value string")
    assert rows(history.scd2_merge(state, none, "k", str(day(4)))) == rows(state)
    assert rows(history.scd2_merge(state, none, "k", str(day(4)), deletions=True)) == [repr(("a", "x", day(0), day(3), False))]


def test_vault_loads_add_what_is_new(spark):
    kind = "k long, snapshot_date date, value string"
    loads = [[(1, day(1), "x"), (1, day(2), "x"), (2, day(1), None)], [(1, day(3), "x"), (1, day(4), "y"), (3, day(3), "x"), (2, day(4), "q")],
             [(1, day(3), "x"), (1, day(4), "y"), (3, day(3), "x"), (2, day(4), "q")]]
    frames = [spark.createDataFrame(x, kind) for x in loads]
    hubs, sats = history.hub(frames[0].limit(0), "k", "s"), history.satellite(frames[0].limit(0), "k", ["value"], "snapshot_date", "s")
    sizes = []
    for f in frames:
        more = history.hub_load(hubs, f, "k", "s"), history.satellite_load(sats, f, "k", ["value"], "snapshot_date", "s")
        sizes.append((more[0].count(), more[1].count()))
        hubs, sats = hubs.unionByName(more[0]), sats.unionByName(more[1])
    assert sizes == [(2, 2), (1, 3), (0, 0)]
    whole = frames[0].unionByName(frames[1])
    assert rows(sats) == rows(history.satellite(whole, "k", ["value"], "snapshot_date", "s"))
    assert rows(hubs) == rows(history.hub(whole, "k", "s"))


def test_vault_keeps_sources_apart(spark):
    """A link and a satellite hold rows of several sources; a hub's key is there once."""
    pair = spark.createDataFrame([(1, 2)], "a long, b long")
    links = history.link(pair, ["a", "b"], "one")
    assert history.link_load(links, pair, ["a", "b"], "one").count() == 0
    assert history.link_load(links, pair, ["a", "b"], "two").count() == 1
    assert history.hub_load(history.hub(pair, "a", "one"), pair, "a", "two").count() == 0
    snap = spark.createDataFrame([(1, day(1), "x")], "k long, snapshot_date date, value string")
    sats = history.satellite(snap, "k", ["value"], "snapshot_date", "one")
    later = spark.createDataFrame([(1, day(2), "x")], "k long, snapshot_date date, value string")
    assert history.satellite_load(sats, later, "k", ["value"], "snapshot_date", "one").count() == 0
    assert history.satellite_load(sats, later, "k", ["value"], "snapshot_date", "two").count() == 1
