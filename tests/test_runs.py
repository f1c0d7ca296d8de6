"""Whole runs on tiny raw files."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.cohort import Cohort
from cohortloom.plans import runs
from cohortloom.plans.cells import mean_cell_file, sum_cell_file
from cohortloom.plans.cohorts import align_to_genes, merge_labelled_studies
from cohortloom.plans.inspection import inspect_files
from cohortloom.plans.profiling import profile_matrix_file
from cohortloom.sinks.features import to_features, to_sparse_features
from cohortloom.sinks.tables import read_cohort, write_cohort
from cohortloom.sources.matrix import scan_wide_dataset
from cohortloom.sources.tables import read_alias


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_scan_wide_dataset(spark, put):
    path = put("w.csv", 'sample_id,study,TP53,"A,B",response\ns1,X,1,NA,CR\ns2,,x,2,\n')
    cohort = scan_wide_dataset(spark, path, ["study", "sample_id", "response"])
    assert rows(cohort.samples) == [("s1", "X", "CR"), ("s2", None, None)]
    assert rows(cohort.expr) == sorted(
        [("X", "s1", "TP53", 1.0), ("X", "s1", "A,B", None), (None, "s2", "TP53", None), (None, "s2", "A,B", 2.0)], key=repr
    )
    with pytest.raises(ValueError, match="sample_id"):
        scan_wide_dataset(spark, path, ["study"])


ALIAS = "#string_protein_id\talias\tsource\np\t7\tEnsembl_HGNC_entrez_id\np\tTP53\tEnsembl_HGNC\np\tENSG1\tEnsembl_gene\n"


def test_main_visit_and_extra_datasets(spark, put, tmp_path):
    out = str(tmp_path / "out")
    alias = put("alias.txt", ALIAS)
    genes = runs.main_dataset(
        spark,
        {
            "clinical_table": put("c.csv", "patient_id,response\nPt1,PD\nPt1,CR\nPt2,SD\n"),
            "clinical_attributes": put(
                "c.txt", "!Sample_title\tPt1.baseline\tPt9\n!Sample_characteristics_ch1\tanti-PD-1 response: CR\tanti-PD-1 response: x\n"
            ),
            "numeric_matrix": put("n.csv", "patient_id,7,8\nPt1,1.5,2\nPt2,3,4\nPt3,5,6\n"),
            "symbol_matrix": put("s.csv", "Gene,Pt1.baseline,Pt9\nTP53,10,11\nTP53,20,\nKRAS,1,1\n"),
            "alias": alias,
            "score": put("score.txt", "id\tscore\nPt1\t0.5\n"),
        },
        out,
    )
    assert rows(genes) == [(0, "TP53")]
    main = read_cohort(spark, f"{out}/main")
    assert rows(main.samples, "study", "patient_id", "response", "survival_event", "cytolytic_score") == [
        ("GSE78220", "Pt1", "CR", 1, 0.5), ("GSE91061", "Pt1", "PD", 0, 0.5), ("GSE91061", "Pt2", "SD", 1, None),
    ]
    assert rows(main.expr, "study", "sample_id", "gene", "value") == [
        ("GSE78220", "Pt1.baseline", "TP53", 15.0), ("GSE91061", "Pt1", "TP53", 1.5), ("GSE91061", "Pt2", "TP53", 3.0),
    ]

    ready = spark.read.parquet(f"{out}/main_ml_ready")
    assert rows(ready, "sample_id", "survival_event", "features") == sorted(
        [("Pt1.baseline", 1, [15.0]), ("Pt1", 0, [1.5]), ("Pt2", 1, [3.0])], key=repr
    )

    sizes = runs.visit_dataset(
        spark, put("v.csv", "Ensembl,Gene Symbol,Patient 1 Pre-RAFi,Patient 1 Post-RAFi\ne,TP53,1,2\ne,,1,2\ne,X,3,4\n"), genes, out
    )
    assert rows(sizes, "treatment_phase", "n_samples") == [("Post", 1), ("Pre", 1)]
    assert rows(read_cohort(spark, f"{out}/visits_aligned").expr, "gene", "value") == [("TP53", 1.0), ("TP53", 2.0)]

    series = (
        '!Sample_title\t"EX99 [pt5]"\t"EY-00 [pt6]"\n!Sample_characteristics_ch1\t"sample class: PRE SR"\t"sample class: POST LR"\n'
    )
    metadata = runs.metadata_tables(spark, {"GSE196434": [put("m.txt", series)]}, out)
    assert rows(metadata, "sample_id", "patient_id", "response_binary") == [("EX99", "pt5", 0), ("EY-00", "pt6", 1)]
    summary = runs.extra_dataset(
        spark, put("e.txt", "GENE_ID\tEY_00_bam\tZZ\nENSG1.4\t2\t3\nENSG2\t5\t6\n"), "GSE196434", metadata, genes, out,
        read_alias(spark, alias),
    )
    row = summary.first().asDict()
    assert (row["n_metadata_samples"], row["n_clean_samples"], row["n_common_genes"], row["n_extra_genes"]) == (2, 1, 1, 2)
    assert (row["n_missing_samples_from_expression"], row["n_expression_samples_without_metadata"]) == (1, 1)
    assert (row["n_expression_rows_raw"], row["n_expression_cols_raw"]) == (2, 3)
    assert rows(spark.read.parquet(f"{out}/GSE196434_ml_ready"), "sample_id", "features") == [("EY-00", [2.0])]
    assert rows(read_cohort(spark, f"{out}/GSE196434_aligned").expr, "sample_id", "gene", "value") == [("EY-00", "TP53", 2.0)]


def test_portal_datasets(spark, put, tmp_path):
    out = str(tmp_path / "out")

    def study(name, gene):
        return {
            "expression": put(f"{name}_e.txt", f"#version\nHugo_Symbol\tEntrez_Gene_Id\ts1\ts2\n# note\tx\ty\tz\nTP53\t1\t1.0\tNA\n{gene}\t2\t3\t4\n"),
            "samples": put(f"{name}_s.txt", "#x\nSAMPLE_ID\tPATIENT_ID\tRESPONSE\ns1\tp1\tCR\ns2\tp2\tSD\ns3\tp3\tPD\n"),
            "patients": put(f"{name}_p.txt", "#x\nPATIENT_ID\tSEX\np1\tMale\n"),
        }

    paths = {"CBIO_GIDE_2019": study("g", "A"), "CBIO_LIU_2019": study("l", "B"), "CBIO_DFCI_2019": {}}
    summary = {r.dataset: r for r in runs.portal_datasets(spark, paths, out).collect()}
    assert summary["CBIO_GIDE_2019"].n_clean_samples == 2
    assert summary["CBIO_GIDE_2019"].n_missing_samples_from_expression == 1
    assert "expression" in summary["CBIO_DFCI_2019"].error
    merged = read_cohort(spark, f"{out}/CBIOPORTAL_BULK_RECIST_ML_READY")
    assert rows(merged.expr, "study", "sample_id", "gene", "value") == [
        ("CBIO_GIDE_2019", "s1", "TP53", 1.0), ("CBIO_LIU_2019", "s1", "TP53", 1.0),
    ]


def test_cell_datasets(spark, put, tmp_path):
    out = str(tmp_path / "out")
    samples = spark.createDataFrame(
        [("Pre x", "P1", "R", 1, "role", None, 1)],
        "sample_id string, patient_id string, response string, response_binary int, dataset_role string, notes string, row int",
    )
    summary = runs.cell_datasets(
        spark,
        {
            "counts": put("c.csv", "gene,c1,c2\nG,1,0\nH,3,0\n"),
            "cell_metadata": put("m.csv", "barcode,sample,RECIST\nc1,S1,PD\nc2,Doublet,CR\n"),
            "tpm": put("t.txt", "\tA_P1_x\tB_P1_y\nPre_P1\tPre\tPre\nG\t4\tx\nZ\t1\t1\n"),
        },
        samples,
        out,
    )
    assert rows(summary) == [("GSE120575", 1, 1), ("MENDELEY", 1, 1), ("TOTAL_FUSION", 2, 1)]
    assert rows(read_cohort(spark, f"{out}/MENDELEY_counts").samples, "study") == [("MENDELEY_MELANOMA_CITESEQ",)]
    assert rows(spark.read.parquet(f"{out}/GSE120575_summary"), "n_samples", "n_genes") == [(1, 2)]
    assert rows(spark.read.parquet(f"{out}/single_cell_ml_ready"), "study") == [("GSE120575",), ("MENDELEY",)]
    fused = read_cohort(spark, f"{out}/single_cell")
    got = {(r.study, r.sample_id, r.gene): round(r.value, 4) for r in fused.expr.collect()}
    assert got == {("MENDELEY", "S1", "G"): 17.9316, ("GSE120575", "Pre_x", "G"): 2.0}


def test_inspect_files(spark, put):
    genes = spark.createDataFrame([(0, "TP53")], "idx int, gene string")
    matrix = put("data_mrna_tpm.txt", "Gene\tz\ta\nTP53\t1\tx\nKRAS\t2\t3\n")
    files = {
        "ONE": [matrix, put("data_clinical_sample.txt", "SAMPLE_ID\tRESPONSE\ns1\tCR\n")],
        "TWO": [put("readme.md", "text"), "/no/such/data_expression.txt"],
    }
    found = {r["file"].rsplit("/", 1)[-1]: r.asDict() for r in inspect_files(spark, files, genes).collect()}
    assert len(found) == 4
    one = found["data_mrna_tpm.txt"]
    assert (one["dataset"], one["file_type"], one["format"], one["n_common_genes"], one["n_numeric_samples"]) == (
        "ONE", "expression", "TPM", 1, 1,
    )
    assert found["data_clinical_sample.txt"]["relevant_columns"] == "SAMPLE_ID; RESPONSE"
    assert found["readme.md"]["file_type"] == "other"
    assert found["data_expression.txt"]["error"]


def test_first_samples_stand_first_in_the_header(spark, put):
    header = "Gene," + ",".join(f"s{i:02}" for i in range(20, 0, -1)) + ",a\n"
    path = put("m.csv", header + "G," + ",".join(["1"] * 20) + ",text\n")
    genes = spark.createDataFrame([(0, "G")], "idx int, gene string")
    assert profile_matrix_file(spark, path, "S", genes).first()["n_numeric_samples"] == 20


def test_a_numeric_looking_study_is_text(spark, tmp_path):
    cohort = Cohort(
        spark.createDataFrame([("007", "s")], "study string, sample_id string"),
        spark.createDataFrame([("007", "s", "G", 1.0)], "study string, sample_id string, gene string, value double"),
    )
    write_cohort(cohort, str(tmp_path / "c"))
    assert rows(read_cohort(spark, str(tmp_path / "c")).expr) == [("007", "s", "G", 1.0)]


def test_merge_by_dataset_name(spark):
    """The study column names something else or is missing; a gene of an unlabelled sample counts."""
    def cohort(study, rows_):
        samples = spark.createDataFrame([("s1", 1), ("s2", None)], "sample_id string, response_binary int")
        expr = spark.createDataFrame(rows_, "sample_id string, gene string, value double")
        if study:
            samples, expr = samples.withColumn("study", F.lit(study)), expr.withColumn("study", F.lit(study))
        return Cohort(samples, expr)

    both = {"K": cohort("X", [("s1", "A", 1.0), ("s2", "B", 2.0)]), "L": cohort(None, [("s1", "A", 3.0), ("s1", "B", 4.0)])}
    merged, summary = merge_labelled_studies(both)
    assert rows(merged.expr, "study", "sample_id", "gene") == [("L", "s1", "A"), ("L", "s1", "B"), ("X", "s1", "A")]
    assert rows(summary, "source_dataset", "n_samples", "n_common_genes") == [("K", 1, 2), ("L", 1, 2)]


def test_guards(spark, put):
    expr = spark.createDataFrame([("S", "s", "G", 1.0)], "study string, sample_id string, gene string, value double")
    with pytest.raises(ValueError, match="no common gene"):
        align_to_genes(expr, spark.createDataFrame([(0, "H")], "idx int, gene string"))
    metadata = spark.createDataFrame([("c9", "S1", "PD", 1)], "barcode string, sample string, RECIST string, row int")
    with pytest.raises(ValueError, match="no cell"):
        sum_cell_file(spark, put("c.csv", "gene,c9\n"), metadata, "S")
    samples = spark.createDataFrame(
        [("x", "P1", "R", 1, "role", None, 1)],
        "sample_id string, patient_id string, response string, response_binary int, dataset_role string, notes string, row int",
    )
    with pytest.raises(ValueError, match="no cell"):
        mean_cell_file(spark, put("t.txt", "\tA_P9_x\nG\t1\n"), samples, "S")


def test_features_refuse_repeats_and_may_be_sparse(spark):
    expr = spark.createDataFrame(
        [("S", "a", "G", 1.0), ("S", "a", "H", None), ("S", "b", "H", 2.0)], "study string, sample_id string, gene string, value double"
    )
    index = spark.createDataFrame([(0, "G"), (1, "H")], "idx int, gene string")
    assert rows(to_sparse_features(expr, index)) == [("S", "a", 2, [0], [1.0]), ("S", "b", 2, [1], [2.0])]
    with pytest.raises(Exception, match="several values"):
        to_features(expr.unionByName(expr), index).collect()
