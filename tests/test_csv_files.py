import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tiffin.sources import csv_files, io


def folder(**files):
    path = tempfile.mkdtemp(prefix="tiffin-csv-")
    for name, text in files.items():
        with open(os.path.join(path, f"{name}.csv"), "w", newline="") as f:
            f.write(text)
    return path


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=str)


def test_each_file_has_its_own_header(spark):
    path = folder(a="order_id,amount\n1,5.0\n", b="amount,order_id\n7.5,2\n", empty="", c="order_id,amount\n",
                  d='﻿note,order_id,amount\n"x\ny",3,1\n', e="\n\namount,extra,order_id\r\n4,z,4\r\n")
    got = io.read_csv(spark, path, ["order_id", "amount"])
    assert rows(got, "order_id", "amount") == [("1", "5.0"), ("2", "7.5"), ("3", "1"), ("4", "4")]
    assert {r["file"].rpartition("/")[2] for r in got.select("seq.file").collect()} == {"a.csv", "b.csv", "d.csv", "e.csv"}


def test_a_file_that_lacks_a_column(spark):
    path = folder(a="order_id,amount\n1,5.0\n", b="order_id\n2\n")
    with pytest.raises(ValueError, match="b.csv has no column amount"):
        io.read_csv(spark, path, ["order_id", "amount"])
    got = io.read_csv(spark, path, ["order_id", "amount"], missing="null")
    assert rows(got, "order_id", "amount") == [("1", "5.0"), ("2", None)]


def test_folders_without_records(spark):
    for path in (folder(a="", b=""), folder(a="x,y\n")):
        assert io.read_csv(spark, path, ["x", "y"]).count() == 0


def test_repeated_and_blank_names():
    assert csv_files.header_names('a,,a,"b, c"\r') == ["a", ".1", "a.2", "b, c"]


def test_malformed_records_are_kept_with_their_reason(spark):
    path = folder(a='k,x,y\n1,2,3\n2,2\n3,2,3,4\n4,"p\nq",3\n5,"say ""hi""",3\n6,"a,b","c"\n7,"open,2\n8,2,3\n',
                  b='y,x,k\n1,2,"9\n3,2,10\n', c='k,x,y\n11,2,3\n12\n,,\n')
    good, bad, n = io.land_csv(spark, path, ["k", "x", "y"], tempfile.mkdtemp(prefix="tiffin-csv-"))
    assert rows(good, "k", "x", "y") == sorted([("1", "2", "3"), ("4", "p\nq", "3"), ("5", 'say "hi"', "3"), ("6", "a,b", "c"),
                                                ("11", "2", "3"), (None, None, None)], key=str)
    got = sorted((r.file.rpartition("/")[2], r.record, r.malformed, r.raw_record) for r in bad.collect())
    assert [g[:3] for g in got] == [("a.csv", 2, "too_few_fields"), ("a.csv", 3, "too_many_fields"), ("a.csv", 7, "unclosed_quote"),
                                    ("b.csv", 1, "unclosed_quote"), ("c.csv", 2, "too_few_fields")]
    assert got[0][3] == "2,2" and got[1][3] == "3,2,3,4" and "8,2,3" in got[2][3] and "3,2,10" in got[3][3]
    assert n == 5 == bad.count()


def test_files_of_plain_lines_are_split(spark):
    body = "k,x\n" + "".join(f"{i},{'v' * 50}\n" for i in range(20_000))
    path = folder(a=body, b='k,x\n1,"two\nlines"\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = csv_files.scan_csv(spark, path, ["k", "x"]).where(F.col("seq.file").endswith("a.csv"))
        assert df.rdd.getNumPartitions() > 4
        # the order of the file holds across its blocks
        assert [int(r.k) for r in df.orderBy("seq").select("k").collect()] == list(range(20_000))
        bad = csv_files.positions(df.where("k = 19999").withColumn("malformed", F.lit("m")).withColumn("raw_record", F.lit("r")), df)
        assert bad.first().record == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_na_tokens(spark):
    path = folder(a='k,x\n1,NA\n2,"n/a"\n3,nan\n4,Nancy\n5,\n')
    assert rows(io.read_csv(spark, path, ["k", "x"], na_tokens=csv_files.NA_TOKENS), "k", "x") == [
        ("1", None), ("2", None), ("3", None), ("4", "Nancy"), ("5", None)]
    assert rows(io.read_csv(spark, path, ["k", "x"]), "x")[0] == ("NA",)


def test_names_that_look_like_patterns(spark):
    path = folder(**{"a [1] {x}": "k\n1\n", "b é": "k\n2\n"})
    assert rows(io.read_csv(spark, path, ["k"]), "k") == [("1",), ("2",)]


def test_split_is_one_write_with_both_partitions(spark):
    path = tempfile.mkdtemp(prefix="tiffin-split-")
    tagged = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "k int, reject_reason string")
    good, bad, n_good, n_bad = io.write_split(tagged, path)
    assert (rows(good, "k"), rows(bad, "k", "reject_reason"), n_good, n_bad) == ([(1,), (3,)], [(2, "bad")], 2, 1)
    assert good.columns == ["k"] and {d for d in os.listdir(path) if "=" in d} == {"outcome=valid", "outcome=rejected"}
    # a second run with nothing to reject leaves no old quarantine behind
    good, bad, n_good, n_bad = io.write_split(tagged.where("k <> 2"), path)
    assert (good.count(), bad.count(), n_good, n_bad) == (2, 0, 2, 0)
    assert io.rejected_side(spark, path).columns == ["k", "reject_reason"]
