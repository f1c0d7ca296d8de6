"""Inspection of many files in one scan."""

import gzip

import pytest

from cohortloom.plans.inspection import inspect_files
from cohortloom.sources import many


@pytest.fixture
def genes(spark):
    return spark.createDataFrame([("TP53",), ("KRAS",)], "gene string")


def inspected(spark, genes, folder, names, **more):
    rows = inspect_files(spark, {"D": [str(folder / n) for n in names]}, genes, **more).collect()
    return {r["file"].rsplit("/", 1)[-1]: r.asDict() for r in rows}


def test_files_of_all_kinds(spark, genes, tmp_path):
    texts = {
        "data_mrna_tpm.txt": "Gene;a;b;a\nTP53;1;x;3\n;2;;\nTP53;NA;2\n\nKRAS;1;1;1;9\n",
        "data_expression_no_sample.txt": "Gene\nTP53\n",
        "data_expression_empty.txt": "\n\n",
        "data_expression_only_header.txt": "Gene|s1|s2\n",
        "data_clinical [1] {x}*.txt": "#note\tz\nPATIENT\tage\tnone\nP1\t3\t\nP2\t4.5\tNA\n",
        "notes.md": "anything",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "data_mrna_fpkm.txt").mkdir()
    (tmp_path / "data_mrna_fpkm.txt" / "one.txt").write_text("s1,Gene\n1,TP53\n")
    (tmp_path / "data_mrna_fpkm.txt" / "two.txt.gz").write_bytes(gzip.compress(b"Gene,s1\nXYZ,t\n"))
    (tmp_path / "data_mrna_rpkm.txt").mkdir()
    (tmp_path / "data_mrna_rpkm.txt" / "one.txt").write_text("s1,Gene\n1,TP53\n")
    (tmp_path / "data_mrna_rpkm.txt" / "two.txt").write_text("s2,Gene\n1,TP53\n")
    whole = gzip.compress(b"Gene,s1\n" + b"".join(b"G%d,%d\n" % (i, i * i) for i in range(9000)))
    for name, content in (("data_mrna_tpm_a", b"plain"), ("data_mrna_tpm_cut", whole[: len(whole) // 2])):
        (tmp_path / f"{name}.txt").mkdir()
        (tmp_path / f"{name}.txt" / "x.txt.gz").write_bytes(content)
    names = [*texts, "data_mrna_fpkm.txt", "data_mrna_rpkm.txt", "data_mrna_tpm_a.txt", "data_mrna_tpm_cut.txt", "data_mrna_gone.txt"]
    found = inspected(spark, genes, tmp_path, names, comment="#")
    assert set(found) == set(names)

    one = found["data_mrna_tpm.txt"]
    figures = ("separator", "n_rows", "n_unique_genes", "n_missing_genes", "n_samples", "n_missing_cells", "n_numeric_samples", "n_common_genes", "n_main_genes")
    # a.1 is short of one value, a of one, b of one
    assert tuple(one[f] for f in figures) == (";", 4, 2, 1, 3, 4, 2, 2, 2) and one["error"] is None
    assert (found["data_expression_no_sample.txt"]["error"], found["data_expression_empty.txt"]["error"]) == ("no sample column", "no line")
    bare = found["data_expression_only_header.txt"]
    assert (bare["separator"], bare["n_rows"], bare["n_samples"], bare["n_common_genes"], bare["error"]) == ("|", 0, 2, 0, None)
    clinic = found["data_clinical [1] {x}*.txt"]
    assert (clinic["n_rows"], clinic["n_cols"], clinic["n_missing"], clinic["n_numeric_cols"], clinic["relevant_columns"]) == (2, 3, 2, 1, "PATIENT; age")
    assert found["notes.md"]["file_type"] == "other" and found["notes.md"]["error"] is None
    folder = found["data_mrna_fpkm.txt"]
    assert (folder["n_rows"], folder["n_samples"], folder["n_unique_genes"], folder["n_numeric_samples"], folder["error"]) == (2, 1, 2, 0, None)
    assert found["data_mrna_rpkm.txt"]["error"] == "the files have different columns"
    for name in ("data_mrna_tpm_a.txt", "data_mrna_tpm_cut.txt"):
        assert found[name]["error"].startswith("cannot be read") and found[name]["n_rows"] is None
    assert found["data_mrna_gone.txt"]["error"] == "no such file"


def test_nothing_readable(spark, genes, tmp_path):
    (tmp_path / "data_tpm.txt").mkdir()
    (tmp_path / "data_tpm.txt" / "x.gz").write_bytes(b"plain")
    found = inspected(spark, genes, tmp_path, ["data_tpm.txt"])
    assert found["data_tpm.txt"]["error"].startswith("cannot be read")
    assert inspect_files(spark, {"D": ["/no/such/place/data_tpm.txt"]}, genes).first()["error"] == "no such file"


def test_jobs_do_not_grow_with_files(spark, genes, tmp_path):
    for i in range(24):
        (tmp_path / f"data_tpm_{i}.txt").write_text(f"Gene,s{i}\nTP53,{i}\n")
        (tmp_path / f"clinical_{i}.txt").write_text(f"a;b{i}\n1;2\n")
    counted = []
    for n in (2, 24):
        spark.sparkContext.setJobGroup(f"inspect-{n}", "")
        names = [f"{kind}_{i}.txt" for kind in ("data_tpm", "clinical") for i in range(n // 2)]
        assert len(inspected(spark, genes, tmp_path, names)) == n
        counted.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"inspect-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counted[0] > 0 and counted[1] <= counted[0] + 2, counted


def test_other_failures_are_raised():
    def work(names):
        raise RuntimeError("FAILED_READ_FILE of something else")

    with pytest.raises(RuntimeError):
        many.set_aside_unreadable({"file:/a": "/a"}, work)
