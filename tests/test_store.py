"""Stores over several runs, states folded from increments, names without collisions, running progress."""

import datetime as dt
import os
import random

import pytest

from pagesmith.operators import fetch
from pagesmith.operators.ordering import numbered
from pagesmith.sources import sinks, store

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, url string, fetched_at timestamp, status int, content_type string, content binary"


def objects(spark, rows):
    return spark.createDataFrame([(n, "u/" + n, "text/html", bytearray(c.encode())) for n, c in rows], sinks.OBJECT)


def contents(spark, path):
    return {r.object_name: bytes(r.content).decode() for r in sinks.scan_object_store(spark, path).collect()}


def files_of(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_objects_of_earlier_runs_stay_and_other_buckets_are_not_written(spark, tmp_path):
    path = str(tmp_path / "store")
    assert contents(spark, path) == {}
    first = [(f"n{i}", "one") for i in range(40)]
    assert len(sinks.sink_object_store(objects(spark, first), path, 8)) == 8
    before = files_of(path)
    second = [("n3", "two"), ("new", "two")]
    touched = sinks.sink_object_store(objects(spark, second), path, 8)
    assert contents(spark, path) == dict(first) | dict(second) and len(touched) <= 2
    other = {f for f in before if not any(f"{store.BUCKET}={b}/" in f for b in touched)}
    after = files_of(path)
    assert other and all(after.get(f) == before[f] for f in other)
    sinks.sink_object_store(objects(spark, second), path, 8)  # the same run again
    assert contents(spark, path) == dict(first) | dict(second)
    assert sinks.sink_object_store(objects(spark, []), path, 8) == []
    assert contents(spark, path) == dict(first) | dict(second)


def random_attempts(rng, n):
    return [(i, f"u{rng.randint(0, n // 4)}", T0 + dt.timedelta(seconds=rng.randint(0, 50)), rng.choice([200, 500, 500, 404]), "text/html",
             bytearray(b"body %d" % i)) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_any_split_of_attempts_folds_to_the_outcome_of_all(spark, tmp_path, parts):
    rng = random.Random(parts)
    rows = random_attempts(rng, 150)
    want = sorted(map(tuple, fetch.retry_outcome(spark.createDataFrame(rows, SCHEMA)).collect()))
    split = [[r for r in rows if r[0] % 7 % parts == k] for k in range(parts)]
    for part in split + split[:1]:  # the first increment comes twice
        out = fetch.fold_attempts(spark.createDataFrame(part, SCHEMA).drop("content"), str(tmp_path / "states"), buckets=4)
    assert sorted(map(tuple, out.collect())) == want


def test_store_plan_moves_no_failed_body(spark, monkeypatch):
    rows = random_attempts(random.Random(9), 200)
    df = spark.createDataFrame(rows, SCHEMA)
    plans = []
    for few in (100_000, 0):
        monkeypatch.setattr(fetch, "BROADCAST_WINNERS", few)
        plan = fetch.store_plan(df)
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "(status" in text and "= 200)" in text.split("Join")[1]
        plans.append(sorted((r.object_name, r.id, bytes(r.content)) for r in plan.collect()))
    assert plans[0] == plans[1] and all(c == b"body %d" % i for _, i, c in plans[0])
    repeated = fetch.store_plan(df.unionByName(df)).collect()  # repeated rows don't multiply the objects
    assert len(repeated) == len({r.object_name for r in repeated})


def brute_names(pairs):
    groups, taken, left = {}, {}, []
    for u, b in sorted(set(pairs), key=lambda p: p[0].encode()):
        groups.setdefault(b, []).append(u)
    for b, us in groups.items():
        taken[b] = us[0]
        left += [(u, b, k, len(us)) for k, u in enumerate(us[1:], 2)]
    while left:
        wishes = {}
        for u, b, k, n in left:
            stem, dot, ext = b.rpartition(".")
            name = f"{stem}-{k}.{ext}" if dot else f"{b}-{k}"
            wishes.setdefault(name, []).append(u)
        won = {min(us, key=str.encode): name for name, us in wishes.items() if name not in taken}
        taken |= {name: u for u, name in won.items()}
        left = [(u, b, k + n, n) for u, b, k, n in left if u not in won]
    return {u: name for name, u in taken.items()}


def test_names_become_unique_at_a_fixed_point(spark):
    pairs = [(f"a{i}", "a.html") for i in range(5)] + [("z", "a-2.html"), ("y", "a-2.html"), ("x", "a-3.html"), ("é", "a-2-2.html"),
             ("w", "a-7.html"), ("v", "plain"), ("u", "plain"), ("a0", "a.html")]
    rng = random.Random(4)
    pairs += [(f"r{i}", rng.choice(["b.pdf", "b-2.pdf", "b-3.pdf", "b-2-2.pdf"])) for i in range(40)]
    want = brute_names(pairs)
    assert len(set(want.values())) == len(want)
    for n in (1, 5):
        rng.shuffle(pairs)
        df = spark.createDataFrame(pairs + [(None, "a.html"), ("n", None)], "url string, object_name string").repartition(n)
        assert {r.url: r.object_name for r in fetch.unique_names(df).collect()} == want


def test_progress_after_every_download(spark):
    rows = [("a", 3, 200), ("b", 1, 500), ("c", 1, 200), ("d", 2, 200)]
    df = spark.createDataFrame([(i, u, T0 + dt.timedelta(seconds=s), st) for i, (u, s, st) in enumerate(rows)], "id long, url string, fetched_at timestamp, status int")
    got = {r.url: (r.done, r.percent) for r in fetch.progress_steps(fetch.retry_outcome(df)).collect()}
    assert got == {"c": (1, 25.0), "d": (2, 50.0), "a": (3, 75.0)}


def test_rows_are_numbered_over_ranges_even_if_all_tie(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("id", "id % 3 as k", "cast(null as string) as place")
    assert sorted((r.k, r.row_no) for r in numbered(df, ["k"], ranges=5).collect()) == [
        (k, i + 1) for i, k in enumerate(sorted(i % 3 for i in range(1000)))]
    same = numbered(df.selectExpr("1 as x"), ["x"], "row_no", 5)
    assert sorted(r.row_no for r in same.collect()) == list(range(1, 1001))
    assert numbered(df.where("false"), ["k"]).count() == 0
