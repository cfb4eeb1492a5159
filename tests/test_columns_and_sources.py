import tempfile
import time

import pytest
from pyspark.sql import functions as F

from fitmesh.functions.vectors import assemble
from fitmesh.operators.columns import (align_xy, dataset_profile, first_column_target, interactions, select_by_type,
                                       split_target)
from fitmesh.sources.tables import load_pair, load_table


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_types_and_fractions_after_the_probe(spark, tmp_path):
    p = _write(tmp_path / "x.csv", "a,b\n" + "".join(f"{i},u\n" for i in range(2000)) + "0.5,v\n")
    df = load_table(spark, p)
    assert dict(df.dtypes) == {"a": "double", "b": "string"}
    assert df.count() == 2001 and df.filter("a = 0.5").count() == 1


def test_numeric_header_is_refused_unless_stated(spark, tmp_path):
    p = _write(tmp_path / "y.csv", "0.25\n0.5\n0.75\n")
    with pytest.raises(ValueError, match="header"):
        load_table(spark, p)
    assert load_table(spark, p, header=False).count() == 3


def test_missing_file_wrong_suffix_and_two_targets(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_table(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        load_table(spark, _write(tmp_path / "x.txt", "a\n1\n"))
    x, y = _write(tmp_path / "x.csv", "a\n1\n"), _write(tmp_path / "y.csv", "b,c\n1,2\n")
    with pytest.raises(ValueError, match="single target"):
        load_pair(spark, x, y)


def test_role_patterns_need_exactly_one_match(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="found 0"):
        load_table(spark, str(tmp_path), "predictors")
    _write(tmp_path / "Predictors_Full_1.csv", "a\n1\n2\n")
    _write(tmp_path / "targets_Hold 1 Full_1.csv", "y\n3\n4\n")
    pair = load_pair(spark, str(tmp_path), str(tmp_path))
    assert sorted((r["a"], r["label"]) for r in pair.collect()) == [(1.0, 3.0), (2.0, 4.0)]
    _write(tmp_path / "predictors_Full_2.csv", "a\n1\n")
    with pytest.raises(FileNotFoundError, match="found 2"):
        load_table(spark, str(tmp_path), "predictors")


def test_late_text_and_large_integers_are_kept(spark, tmp_path):
    p = _write(tmp_path / "x.csv", "a\n" + "1\n" * 1500 + "oops\n")
    df = load_table(spark, p)
    assert df.dtypes == [("a", "string")] and df.count() == 1501
    ids = load_table(spark, _write(tmp_path / "ids.csv", "k,v\n9007199254740992,1\n9007199254740993,2\n"))
    assert ids.dtypes == [("k", "bigint"), ("v", "bigint")]
    assert ids.select("k").distinct().count() == 2


def test_malformed_cells_are_errors_under_a_given_schema(spark, tmp_path):
    p = _write(tmp_path / "x.csv", "a\n" + "1\n" * 1500 + "oops\n")
    with pytest.raises(Exception):
        load_table(spark, p, schema="a double").agg(F.sum("a")).collect()


def test_pairing_refuses_repeated_and_unmatched_keys(spark):
    x = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 0.3)], "k int, a double")
    y = spark.createDataFrame([(1, 1.0), (2, 2.0), (5, 3.0)], "k int, label double")
    with pytest.raises(ValueError, match="keys"):
        align_xy(x, y, ["k"])
    good = align_xy(x.where("a <> 0.2"), y.where("k < 3"), ["k"])
    assert sorted(map(tuple, good.collect())) == [(1, 0.1, 1.0), (2, 0.3, 2.0)]


def test_wide_rows_assemble_in_seconds(spark):
    n = 4806
    began = time.monotonic()
    wide = spark.range(20).select("id", *[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(n)])
    path = f"{tempfile.mkdtemp()}/wide.parquet"
    wide.write.parquet(path)
    rows = assemble(spark.read.parquet(path), [f"c{i}" for i in range(n)]).select("id", "features").collect()
    assert all(r["features"][i] == r["id"] + i for r in rows for i in (0, 17, n - 1))
    assert time.monotonic() - began < 120


def test_kinds_follow_the_schema(spark):
    df = spark.sql("select 1 i, 1.5D d, cast(2 as decimal(9,2)) n, true b, date'2020-01-01' t, 's' s, array(1) a")
    assert select_by_type(df, "numeric") == ["i", "d", "n"]
    assert select_by_type(df, "categorical") == ["s"]
    assert select_by_type(df, "passthrough") == ["b", "t", "a"]
    assert interactions(df).columns[-3:] == ["i_x_d", "i_x_n", "d_x_n"]
    assert interactions(df.select("i", "s")).columns == ["i", "s"]


def test_alignment_checks_counts(spark):
    a, b = spark.range(5), spark.range(4).withColumn("y", F.lit(1.0))
    with pytest.raises(ValueError):
        align_xy(a, b, ["id"])
    with pytest.raises(ValueError):
        align_xy(a, b.select("y"))
    pos = align_xy(spark.range(50).repartition(3).sortWithinPartitions("id"), spark.range(50).select((F.col("id") * 2).alias("y")))
    assert pos.count() == 50


def test_targets(spark):
    df = spark.sql("select 3 y, 4 z")
    assert first_column_target(df).first()["label"] == 3.0
    with pytest.raises(ValueError):
        first_column_target(df, strict=True)
    assert split_target(df, "z").columns == ["y", "label"]
    with pytest.raises(ValueError):
        split_target(df, "none")


def test_assemble_modes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null or NaN"):
        assemble(df, ["a", "b"]).select("features").collect()
    assert assemble(df, ["a", "b"], invalid="skip").count() == 1
    assert assemble(df, ["a", "b"], invalid="keep").count() == 3


def test_profile_counts_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "v double, s string")
    rows = {r["column"]: r for r in dataset_profile(df, "v").collect()}
    assert (rows["v"]["n_null"], rows["v"]["n_nan"], rows["s"]["n_null"], rows["s"]["kind"]) == (1, 1, 1, "categorical")


def test_a_sweep_keeps_types_and_survives_odd_results(spark):
    from fitmesh.sources.tables import dataset_sweep

    one = spark.range(1).select(F.lit(7).cast("long").alias("n"), F.lit("text").alias("t"))
    found = dataset_sweep(spark, {"good": lambda: one, "two": lambda: one.unionAll(one), "other": lambda: one.select("n"), "none": lambda: one.limit(0),
                                  "broken": lambda: spark.read.parquet("/no/such/path")}, 2)
    rows = {r["dataset"]: r for r in found.collect()}
    assert dict(found.dtypes)["n"] == "bigint" and (rows["good"]["n"], rows["good"]["t"], rows["good"]["status"]) == (7, "text", "ok")
    assert {d: r["status"] for d, r in rows.items()} == {"good": "ok", "two": "failed", "other": "failed", "none": "ok", "broken": "failed"}


def test_distinct_counts_are_exact_for_every_type(spark):
    from decimal import Decimal

    n = 3000
    rows = [(i % 7, float(i % 5) if i % 11 else None, "x" * 100 + str(i % 500), bytes([i % 4]), [i % 2, i % 3], Decimal(i % 9), (i % 6, "q"), None)
            for i in range(n)]
    rows += [(0, -0.0, "=x", b"", [], Decimal("0.0"), None, None), (0, float("nan"), None, None, None, None, None, None),
             (0, float("nan"), "", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, b double, s string, `b.in` binary, l array<int>, d decimal(10,2), t struct<x:int,y:string>, z string")
    got = {r["column"]: r["n_distinct"] for r in dataset_profile(df, "a").collect()}
    assert got == {"a": 7, "b": 6, "s": 502, "b.in": 5, "l": 7, "d": 9, "t": 6, "z": 0}
    estimate = {r["column"]: r["n_distinct"] for r in dataset_profile(df, "a", exact=False).collect()}
    assert estimate["a"] == 7 and abs(estimate["s"] - 502) < 60
    empty = dataset_profile(df.limit(0), "a").collect()
    assert len(empty) == 8 and all(r["n_distinct"] == 0 and r["n_rows"] == 0 for r in empty)


def test_positions_of_a_computed_table_do_not_move(spark):
    """Another read of a shuffled table may deal its rows differently; the pairing is fixed by the first."""
    x = spark.range(500).select(F.col("id").alias("a")).repartition(5)
    y = spark.range(500).select((F.col("id") * 2).alias("b")).orderBy("b")
    paired = align_xy(x.withColumn("noise", F.rand()), y)
    first, again = ({tuple(r) for r in paired.collect()} for _ in range(2))
    assert first == again and len(first) == 500
    assert sorted(r[2] for r in first) == [2 * i for i in range(500)]


def test_a_wrong_column_is_reported_and_not_taken_for_a_table_without_files(spark, tmp_path):
    from fitmesh.operators.rank import from_files

    spark.range(3).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert from_files(scan) and from_files(scan.select("id").filter("id > 0"))
    assert not from_files(spark.range(3)) and not from_files(scan.groupBy("id").count())
