"""Readers and writers on data derived from the test tables or tiny hand-made files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tarmac.session import scratch_path
from tarmac.sources import readers as R
from tarmac.sources import writers as W
from tarmac.sources.tables import materialize


def _write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _local(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def test_flight_csv_with_na_and_schema(spark):
    base = _local(scratch_path(spark, "flights"))
    header = ",".join(f.name for f in R.flight_schema().fields)
    row1 = ["2008", "1", "3", "4", "335", "0", "0"] + ["2003.0", "1955", "2211", "2225", "128", "150", "116",
                                                         "-14", "8", "810", "4", "8", "NA", "NA", "NA", "NA",
                                                         "NA"] + ["WN", "N712SW", "IAD", "TPA", "NA"]
    _write_text(f"{base}/a.csv", header + "\n" + ",".join(row1) + "\n")
    df = R.read_csv(spark, base, schema=R.flight_schema())
    r = df.first()
    assert r.DepDelay == 8.0 and r.CarrierDelay is None and r.CancellationCode is None
    assert dict(df.dtypes)["Year"] == "int"


def test_directory_union_matches_by_name(spark):
    base = _local(scratch_path(spark, "csvdir"))
    _write_text(f"{base}/one.csv", "a,b\n1,x\n2,y\n")
    _write_text(f"{base}/two.csv", "b,a,c\nz,3,9\n")
    _write_text(f"{base}/skip.txt", "not,a,csv\n")
    df = R.read_csv_directory(spark, base)          # no schema: every column read as text
    rows = sorted((int(r.a), r.b, r.c) for r in df.collect())
    assert rows == [(1, "x", None), (2, "y", None), (3, "z", "9")]


def test_headers_read_concurrently_keep_file_order(spark):
    base = _local(scratch_path(spark, "headers"))
    expected = []
    for i in range(40):
        header = ("a", "b") if i % 3 else ("b", "a", f"c{i}")
        _write_text(f"{base}/f{i:02d}.csv", ",".join(header) + "\n")
        expected.append(header)
    files = R.list_files(spark, base)
    assert R.read_headers(spark, files, threads=8) == expected


def test_type_override_after_inference(spark):
    from pyspark.sql import types as T
    base = _local(scratch_path(spark, "override"))
    _write_text(f"{base}/x.csv", "code,n\n007,1\nNA,2\n")
    df = R.read_csv(spark, base, infer=True, overrides={"code": T.StringType()})
    assert dict(df.dtypes)["n"] == "int"
    assert {r.n: r.code for r in df.collect()} == {1: "007", 2: None}


def test_compaction_picks_file_count(spark):
    # AQE sizes the partitions of the rebalance shuffle, so the input needs several map
    # tasks (a cached one-partition table would give one file whatever the target)
    many = spark.range(0, 100000, 1, 8).selectExpr("id", "cast(id * 7 as string) AS s")
    path = scratch_path(spark, "compact-many")
    n = W.write_compacted(many, path, target_file_bytes=16 * 1024)
    files = [f for f in os.listdir(_local(path)) if f.endswith(".parquet")]
    assert n > 1 and len(files) == n
    one = W.write_compacted(many, scratch_path(spark, "compact-one"), target_file_bytes=1 << 40)
    assert one == 1
    assert R.read_parquet(spark, path).count() == 100000


def test_convert_once_does_not_overwrite(spark):
    base = _local(scratch_path(spark, "convert"))
    _write_text(f"{base}/in.csv", "a\n1\n")
    out = f"{base}/out.parquet"
    assert R.convert_once(spark, f"{base}/in.csv", out).count() == 1
    _write_text(f"{base}/in.csv", "a\n1\n2\n")
    assert R.convert_once(spark, f"{base}/in.csv", out).count() == 1


def test_convert_once_after_failure_and_with_new_files(spark, monkeypatch):
    base = _local(scratch_path(spark, "convert"))
    _write_text(f"{base}/in/a.csv", "k,v\n1,x\n2,NA\n")
    out = f"{base}/out.parquet"
    commit = R._commit

    def fails(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(R, "_commit", fails)
    with pytest.raises(RuntimeError):
        R.convert_once(spark, f"{base}/in", out)
    monkeypatch.setattr(R, "_commit", commit)
    rows = lambda: sorted((r["k"], r["v"]) for r in R.convert_once(spark, f"{base}/in", out).collect())
    assert rows() == [(1, "x"), (2, None)] == rows()
    _write_text(f"{base}/in/b.csv", "k,v\n3,z\n")
    _write_text(f"{base}/in/_hidden.csv", "k,v\n9,q\n")
    assert rows() == [(1, "x"), (2, None), (3, "z")] == rows()
    listed = R._manifest(spark, out)
    assert [e["batch"] for e in listed] == ["batch-000000", "batch-000001"] and all(len(e["files"]) == 1 for e in listed)
    other = f"{base}/other.parquet"  # a finished folder of another writer
    spark.range(4).write.parquet(other)
    assert R.convert_once(spark, f"{base}/in", other).count() == 4
    with pytest.raises(FileNotFoundError):
        R.convert_once(spark, f"{base}/none*.csv", f"{base}/new")


def test_block_size_controls_splits(spark):
    base = _local(scratch_path(spark, "blocks"))
    _write_text(f"{base}/big.csv", "a\n" + "\n".join(str(i) for i in range(200_000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        small = R.read_csv(spark, f"{base}/big.csv", schema="a int", max_partition_bytes=256 * 1024)
        assert small.rdd.getNumPartitions() > 1
        assert small.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_roundtrips_and_compaction(spark, ship_small):
    p = scratch_path(spark, "pq")
    W.write_parquet(ship_small, p)
    assert R.read_parquet(spark, p).count() == ship_small.count()
    c = scratch_path(spark, "csv")
    W.write_csv(ship_small, c)
    back = R.read_csv(spark, c, schema=ship_small.schema, null_value="")
    assert back.exceptAll(ship_small).count() == 0 and ship_small.exceptAll(back).count() == 0


def test_materialize_spreads_single_task_input(spark, ship_small):
    m = materialize(ship_small.coalesce(1), "m")
    assert m.count() == ship_small.count()
    assert m.rdd.getNumPartitions() >= 1
    assert m.agg(F.sum("l_orderkey")).first()[0] == ship_small.agg(F.sum("l_orderkey")).first()[0]


def test_header_lines_are_read_by_tasks(spark):
    base = _local(scratch_path(spark, "headerfiles"))
    _write_text(f"{base}/one.csv", "a,b\n" + "1,x\n" * 50_000)
    _write_text(f"{base}/tw o.csv", "b,a,c\nz,3,9\n")
    _write_text(f"{base}/three.csv", "a,b\n2,y\n")
    _write_text(f"{base}/none.csv", "")
    _write_text(f"{base}/skip.txt", "no,table\n")
    _write_text(f"{base}/k=1/deep.csv", "b,a\nq,4\n")
    found = {os.path.basename(r.path): r.header for r in R.header_lines(spark, base).collect()}
    assert found == {"one.csv": "a,b", "tw%20o.csv": "b,a,c", "three.csv": "a,b"}
    assert R.header_lines(spark, base, recursive=True).count() == 4
    df = R.read_csv_directory(spark, base)
    assert df.count() == 50_002 and df.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in df.where("a <> '1'").collect()) == [("2", "y", None), ("3", "z", "9")]
    deep = R.read_csv_directory(spark, base, recursive=True)
    assert deep.where("a = '4' and b = 'q' and c is null").count() == 1 and deep.count() == 50_003
    with pytest.raises(FileNotFoundError):
        R.read_csv_directory(spark, base, suffix=".tsv")


def test_each_header_scans_only_its_files(spark):
    base = _local(scratch_path(spark, "headerscan"))
    for i in range(6):
        _write_text(f"{base}/f{i}.csv", "a,b\n1,2\n" if i % 3 else "b,a\n2,1\n")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))   # a partition for each file
    try:
        df = R.read_csv_directory(spark, base)
        assert df.rdd.getNumPartitions() == 6 and df.where("a = '1' and b = '2'").count() == 6
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
