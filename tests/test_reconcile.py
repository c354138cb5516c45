from pagesmith.operators import reconcile, records


def test_reconcile_partitions_local(spark):
    local = spark.createDataFrame([(n,) for n in ["a", "b", "c", "d"]], "name string")
    remote = spark.createDataFrame([(n,) for n in ["f/a", "g/a", "f/b", "f/", "top", "f/z", "f/sub/"]], "name string")
    up = {r.name: r.remote_copies for r in reconcile.reconcile_uploaded(local, remote).collect()}
    rem = {r.name for r in reconcile.reconcile_remaining(local, remote).collect()}
    miss = {r.name: r.remote_copies for r in reconcile.reconcile_missing(local, remote).collect()}
    assert up == {"a": 2, "b": 1}
    assert rem == {"c", "d"} and not (set(up) & rem) and set(up) | rem == {"a", "b", "c", "d"}
    assert miss == {"z": 1}


def test_filter_object_names(spark):
    df = spark.createDataFrame([("f/",), ("top",), ("f/x.pdf",)], "name string")
    assert [r.name for r in records.filter_object_names(df).collect()] == ["x.pdf"]
