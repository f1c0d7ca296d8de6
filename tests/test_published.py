"""Datasets under a manifest."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.cohort import Cohort
from cohortloom.sinks import published as P
from cohortloom.sinks.tables import read_cohort, write_cohort


def expression(spark, factor=1.0, n=4000):
    table = spark.range(n).selectExpr("concat('S', id % 3) AS study", "concat('s', id % 40) AS sample_id", "concat('g', id % 500) AS gene", "id * 1.0D AS value")
    return table.withColumn("value", F.col("value") * factor)


def test_filters_skip_files(spark, tmp_path):
    path = str(tmp_path / "d")
    expr = expression(spark)
    P.publish({"expr": expr}, path, max_rows=100)
    whole = P.read_published(spark, path, "expr")
    assert whole.columns == expr.columns and rows(whole) == rows(expr)
    n_files = len(whole.inputFiles())
    assert n_files >= 40
    one = P.read_published(spark, path, "expr", genes=["g7", "absent"])
    assert rows(one) == rows(expr.filter("gene = 'g7'")) and len(one.inputFiles()) <= n_files // 4
    study = P.read_published(spark, path, "expr", studies=["S1"])
    assert rows(study) == rows(expr.filter("study = 'S1'")) and len(study.inputFiles()) <= n_files // 2
    both = P.read_published(spark, path, "expr", studies=["S2"], genes=["g8"])
    assert rows(both) == rows(expr.filter("study = 'S2' AND gene = 'g8'")) and len(both.inputFiles()) <= n_files // 8
    assert rows(P.read_published(spark, path, "expr", studies=["none"])) == rows(P.read_published(spark, path, "expr", genes=[])) == []


def test_a_run_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    cohort = Cohort(spark.createDataFrame([("S0", "s1")], "study string, sample_id string"), expression(spark, n=30))
    write_cohort(cohort, path)
    old = rows(read_cohort(spark, path).expr)
    broken = expression(spark, 2.0, 30).withColumn("value", F.when(F.col("gene") == "g9", F.raise_error(F.lit("dies"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="dies"):
        write_cohort(Cohort(cohort.samples, broken), path)
    assert rows(read_cohort(spark, path).expr) == old

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # all data is written, the manifest is not
        patch.setattr(P, "_described", dies)
        with pytest.raises(KeyboardInterrupt):
            write_cohort(Cohort(cohort.samples, expression(spark, 3.0, 30)), path)
    assert rows(read_cohort(spark, path).expr) == old
    # a manifest without its mark counts as none
    (tmp_path / "d" / "manifest" / "v99999999-half").mkdir()
    assert rows(read_cohort(spark, path).expr) == old
    (tmp_path / "d" / "manifest" / "v99999999-half").rmdir()

    reader = read_cohort(spark, path).expr
    write_cohort(Cohort(cohort.samples, expression(spark, 4.0, 30)), path)
    assert rows(reader) == old, "who has begun to read goes on with what was there"
    assert rows(read_cohort(spark, path).expr) == rows(expression(spark, 4.0, 30))


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "d")
    for n in range(4):
        P.publish({"t": spark.createDataFrame([(n,)], "n int")}, path)
    assert len(P._versions(spark, path)) == 2 and len(list((tmp_path / "d" / "data").iterdir())) == 2
    assert rows(P.read_published(spark, path, "t")) == [(3,)]
    with pytest.raises(ValueError, match="no study and gene"):
        P.read_published(spark, path, "t", genes=["g"])


def test_nulls_and_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(ValueError, match="no published dataset"):
        P.read_published(spark, path, "expr")
    schema = "study string, sample_id string, gene string, value double"
    odd = spark.createDataFrame([(None, "s", "g", 1.0), ("007", None, None, None), ("007", "s", "g", 2.0)], schema)
    P.publish({"expr": odd}, path)
    assert rows(P.read_published(spark, path, "expr")) == rows(odd)
    assert rows(P.read_published(spark, path, "expr", genes=["g"]), "value") == [(1.0,), (2.0,)]
    assert rows(P.read_published(spark, path, "expr", studies=["007"]), "sample_id") == sorted([("s",), (None,)], key=repr)
    P.publish({"expr": odd.limit(0)}, path)
    assert rows(P.read_published(spark, path, "expr")) == [] and P.read_published(spark, path, "expr", genes=["g"]).columns == odd.columns
