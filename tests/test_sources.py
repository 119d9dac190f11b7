"""Sources, sinks and the streaming ingest."""

import glob
import hashlib
import os
import random
import tempfile
from contextlib import contextmanager

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavepanel.functions.digest import (BASE, PRIME, digest_in_order, mulmod, power_of_any,
                                        with_power_times)
from wavepanel.operators.panel import carry_forward, tile
from wavepanel.sources.files import (changed_files, file_hashes, load_extracts, open_bucketed_panel,
                                     read_panel, union_extracts, write_bucketed_panel,
                                     write_extracts, write_panel)
from wavepanel.streaming.ingest import ingest_available

SCHEMA = T.StructType([T.StructField("userid", T.LongType()), T.StructField("wid", T.IntegerType()),
                       T.StructField("x", T.DoubleType())])


def _write(path, rows, preamble="# license line, no redistribution"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(preamble + "\n" + "userid,wid,x\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_load_extracts_skips_preamble_and_header(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/a.csv", [(1, 201301, 2.5), (1, 201302, None)])
    _write(f"{d}/b.csv", [(2, 201301, 1.0)])
    df = load_extracts(spark, d, SCHEMA, preamble_prefix="#")
    rows = sorted((r.userid, r.wid, r.x) for r in df.collect())
    assert rows == [(1, 201301, 2.5), (1, 201302, None), (2, 201301, 1.0)]


def test_write_extracts_roundtrip(spark):
    d = tempfile.mkdtemp() + "/out"
    df = spark.createDataFrame([(1, 201301, 2.5), (2, 201302, 0.1)], SCHEMA).repartition(2)
    write_extracts(df, d, "# license")
    back = load_extracts(spark, d, SCHEMA, preamble_prefix="#").drop("_source_file")
    assert sorted(map(tuple, back.collect())) == [(1, 201301, 2.5), (2, 201302, 0.1)]
    first_lines = [open(os.path.join(p, f)).readline().strip()
                   for p, _, fs in os.walk(d) for f in fs if f.startswith("part-")]
    assert len(first_lines) == 8 and set(first_lines) == {"# license"}


def test_a_record_may_look_like_a_preamble_line(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.StringType())])
    d = tempfile.mkdtemp()
    open(f"{d}/a.csv", "w").write("# license\nid,x\n#2,bar\n1,foo\n")
    open(f"{d}/b.csv", "w").write("# license\n\"x\",id,more\r\nbaz,3,z\r\n")
    rows = load_extracts(spark, d, schema, preamble_prefix="#").drop("_source_file")
    assert sorted(map(tuple, rows.collect())) == [("#2", "bar"), ("1", "foo"), ("3", "baz")]


def test_bad_extracts_raise(spark):
    d = tempfile.mkdtemp()
    open(f"{d}/a.csv", "w").write("userid,wid,x\n1,201301,2.5\n")
    with pytest.raises(ValueError, match="does not start"):
        load_extracts(spark, d, SCHEMA, preamble_prefix="#")
    open(f"{d}/a.csv", "w").write("userid,x\n1,2.5\n")
    with pytest.raises(ValueError, match="lacks wid"):
        load_extracts(spark, d, SCHEMA)
    open(f"{d}/a.csv", "w").write("userid,wid,x\none,201301,2.5\n")
    with pytest.raises(Exception, match="MALFORMED"):
        load_extracts(spark, d, SCHEMA).collect()
    bad = load_extracts(spark, d, SCHEMA, malformed="null").first()
    assert (bad.userid, bad.wid, bad.x) == (None, 201301, 2.5)


def test_second_file_is_loaded_by_the_second_ingest(spark):
    src, out, ckpt = (tempfile.mkdtemp() for _ in range(3))
    for n, name in ((1, "a.csv"), (2, "b.csv")):
        _write(f"{src}/{name}", [(n, 201301, 1.0)])
        ingest_available(spark, src, SCHEMA, out, ckpt)
        got = sorted(r.userid for r in spark.read.parquet(out).collect())
        assert got == list(range(1, n + 1))
    with pytest.raises(ValueError):
        ingest_available(spark, src, SCHEMA, out, None)


def test_union_by_name_with_drift(spark):
    a = spark.createDataFrame([(1, 2.0, "x")], "userid long, q double, extra string")
    b = spark.createDataFrame([(2, 3.0)], "userid long, q float")
    u = union_extracts([a, b])
    assert u.schema["q"].dataType == T.DoubleType()
    assert sorted((r.userid, r.extra) for r in u.collect()) == [(1, "x"), (2, None)]


@contextmanager
def conf(spark, **values):
    old = {k: spark.conf.get(k.replace("_", "."), None) for k in values}
    for k, v in values.items():
        spark.conf.set(k.replace("_", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k.replace("_", "."), v) if v else spark.conf.unset(k.replace("_", "."))


def test_arithmetic_modulo_the_prime(spark):
    rng = random.Random(1)
    xs = [0, PRIME - 1, PRIME - 1, 1, *(rng.randrange(PRIME) for _ in range(300))]
    ys = [5, PRIME - 1, 1, 1, *(rng.randrange(PRIME) for _ in range(300))]
    df = spark.createDataFrame(list(zip(xs, ys)), "a long, b long")
    got = [r[0] for r in df.select(mulmod(F.col("a"), F.col("b"))).collect()]
    assert got == [x * y % PRIME for x, y in zip(xs, ys)]
    places = [0, 1, 511, 512, 2**36 - 1, 123456789, 2**27]
    df = spark.createDataFrame([(p, 7) for p in places], "p long, f long")
    got = [r.c for r in with_power_times(df, "p", "f", "c").collect()]
    assert got == [7 * pow(BASE, p, PRIME) % PRIME for p in places]
    places = [0, -1, -12345, 2**40, 7]
    df = spark.createDataFrame([(p,) for p in places], "p long")
    got = [r[0] for r in df.select(power_of_any(F.col("p"))).collect()]
    assert got == [pow(BASE, p % (PRIME - 1), PRIME) for p in places]


def _digest(lines):
    return digest_in_order([int(hashlib.md5(x.encode()).hexdigest()[:15], 16) + 1 for x in lines])


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_digest_does_not_depend_on_the_splits(spark, split):
    d = tempfile.mkdtemp()
    files = {"a": [f"line {i} " + "x" * (i % 50) for i in range(900)], "b": ["one"],
             "c": ["", "", "é", "", "z\r"], "d": ["same"] * 700}
    for name, lines in files.items():
        open(f"{d}/{name}.txt", "w", newline="").write("\n".join(lines) + "\n")
    open(f"{d}/empty.txt", "w").close()
    with conf(spark, spark_sql_files_maxPartitionBytes=split, spark_sql_files_openCostInBytes="1k"):
        df = file_hashes(spark, d)
        tasks = df.select("path").rdd.getNumPartitions() if split == "128m" else spark.read.text(
            f"{d}/a.txt").rdd.getNumPartitions()
        got = {os.path.basename(r.path)[0]: (r.lines, r.bytes, r.digest) for r in df.collect()}
    assert split == "128m" or tasks > 5                       # several tasks read one file
    assert got == {n: (len(x), sum(len(y.encode()) + 1 for y in x), _digest(x))
                   for n, x in files.items()}


def test_changed_files(spark):
    d = tempfile.mkdtemp()
    rows = [(i, 201301 + i % 3, i / 2) for i in range(400)]
    for name in ("kept", "swapped", "header", "cut", "break"):
        _write(f"{d}/{name}.csv", rows)
        rows = [(a + 1000, b, c) for a, b, c in rows]
    seen = file_hashes(spark, d)
    manifest = spark.createDataFrame(seen.collect(), seen.schema)
    assert changed_files(spark, d, manifest).count() == 0

    def change(name, f):
        lines = open(f"{d}/{name}.csv").read().split("\n")[:-1]
        open(f"{d}/{name}.csv", "w").write(f(lines))

    change("swapped", lambda x: "\n".join([*x[:7], x[300], *x[8:300], x[7], *x[301:]]) + "\n")
    change("header", lambda x: "\n".join([x[0], *x[2:], x[1]]) + "\n")
    change("cut", lambda x: "\n".join(x[:-1]) + "\n")
    change("break", lambda x: "\n".join(x))                  # no line break at the end
    _write(f"{d}/new.csv", [(1, 2, 3.0)])
    os.makedirs(f"{d}/sub")
    os.rename(f"{d}/kept.csv", f"{d}/sub/moved.csv")          # a name does not count
    with conf(spark, spark_sql_files_maxPartitionBytes="2k"):
        out = changed_files(spark, d, manifest).collect()
    assert sorted(os.path.basename(r.path)[:-4] for r in out) == [
        "break", "cut", "header", "new", "swapped"]


def test_many_headers_and_missing_columns(spark):
    d = tempfile.mkdtemp()
    want = []
    for i in range(101):
        names = ["userid", "wid", "x"][:2 + (i % 3 > 0)] + [f"other{i}"]
        random.Random(i).shuffle(names)
        values = {"userid": i, "wid": 201300 + i, "x": i / 4, f"other{i}": "é"}
        open(f"{d}/{i}.csv", "w").write("# license\n" + ",".join(names) + "\n"
                                        + ",".join(str(values[n]) for n in names) + "\n")
        want.append((i, 201300 + i, i / 4 if "x" in names else None))
    with pytest.raises(ValueError, match="lacks x"):
        load_extracts(spark, d, SCHEMA, preamble_prefix="#")
    df = load_extracts(spark, d, SCHEMA, preamble_prefix="#", missing="null")
    assert sorted(tuple(r)[:3] for r in df.collect()) == want


def test_first_lines_are_found_in_files_cut_into_blocks(spark):
    d = tempfile.mkdtemp()
    for name in "abcde":
        _write(f"{d}/{name}.csv", [(i, 201301, 0.5) for i in range(300 + ord(name))])
    with conf(spark, spark_sql_files_maxPartitionBytes="1k", spark_sql_files_openCostInBytes="100"):
        df = load_extracts(spark, d, SCHEMA, preamble_prefix="#")
        assert df.groupBy("_source_file").count().agg(F.sum("count")).first()[0] == sum(
            300 + ord(c) for c in "abcde")
        assert df.where("userid is null").count() == 0
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1                   # one scan of the rows


def _panel(spark, people=40):
    rows = [(p, 2013 * 100 + w, float(p * w) if w % 3 else None, 1.0 if w == 1 else None)
            for p in range(people) for w in range(1, 13)]
    return spark.createDataFrame(rows, "userid long, wid int, x double, once double")


def test_partitioned_panel_has_about_as_many_files_as_ranges(spark):
    d = tempfile.mkdtemp() + "/panel"
    df = _panel(spark).withColumn("wave_year", F.lit(2013) + F.col("wid") % 6)
    with conf(spark, spark_sql_shuffle_partitions="8", spark_sql_adaptive_enabled="false"):
        write_panel(df.repartition(5), d, partition_by=["wave_year"])
    files = glob.glob(f"{d}/wave_year=*/*.parquet")
    assert 6 <= len(files) <= 8 + 6
    for f in files:                                            # each sorted by person and wave
        rows = [(r.userid, r.wid) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows)
    assert read_panel(spark, d).count() == df.count()


def test_stored_panel_needs_no_exchange_by_person(spark):
    d = tempfile.mkdtemp() + "/bucketed"
    df = _panel(spark)
    hot = df.unionByName(df.where("userid = 3").select("userid", (F.col("wid") + 100).alias("wid"),
                                                       "x", F.lit(None).cast("double").alias("once")))
    stored = write_bucketed_panel(hot, "wp_test_panel", d, buckets=4)

    def clean(panel):
        tiled = tile(panel, ["once"], "userid")
        return carry_forward(tiled, ["x"], "userid", ["wid"])

    with conf(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_enabled="false"):
        got = clean(stored)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" in plan
        assert "Exchange hashpartitioning(userid" in clean(
            hot)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, clean(hot).collect()))
    spark.sql("DROP TABLE wp_test_panel")                      # external: the files stay
    again = open_bucketed_panel(spark, "wp_test_panel2", d, hot.schema, buckets=4)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, hot.collect()))
    with conf(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_enabled="false"):
        assert "Exchange" not in clean(again)._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE wp_test_panel2")


def test_write_and_read_panel(spark):
    d = tempfile.mkdtemp() + "/panel"
    df = spark.createDataFrame([(1, 201301, 2.5), (2, 201302, 0.1)], SCHEMA)
    write_panel(df.withColumn("wave_year", F.lit(2013)), d, partition_by=["wave_year"])
    assert read_panel(spark, d).count() == 2


def test_streaming_ingest_loads_each_file_once(spark):
    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp() + "/t", tempfile.mkdtemp() + "/c"
    _write(f"{src}/a.csv", [(1, 201301, 2.5), (1, 201302, 3.5)])
    ingest_available(spark, src, SCHEMA, out, ck)
    assert spark.read.parquet(out).count() == 2
    _write(f"{src}/b.csv", [(2, 201301, 1.0)])
    ingest_available(spark, src, SCHEMA, out, ck)
    rows = sorted((r.userid, r.wid) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 201301), (1, 201302), (2, 201301)]
