import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.operators.projection import conform, drop_missing, valid_sample
from cohortloom.operators.summaries import (
    column_types, distinct_texts, distinct_values, group_sizes, matrix_profile, table_shape, value_counts,
)
from cohortloom.plans import Cohort
from cohortloom.plans import cells as C
from cohortloom.plans.clinical import build_clinical, clinical_from_table
from cohortloom.plans.cohorts import (
    attach_metadata, matrix_to_samples, merge_cohorts, merge_labelled_studies, visit_cohort,
)
from cohortloom.plans.portal import PORTAL_SPECS, portal_metadata, prepare_portal_study
from cohortloom.plans.profiling import profile_matrix_file, profile_table
from cohortloom.sinks.features import to_features, to_wide
from cohortloom.sinks.tables import summary_rows

EXPR = "study string, sample_id string, gene string, value double"


def expr(spark, *values):
    return spark.createDataFrame(list(values), EXPR)


def test_clinical_union(spark):
    a = spark.createDataFrame(
        [(' "p1" ', "SD", 2), ("p1", "PD", 1), (None, "CR", 3)], "patient_id string, response string, row int"
    )
    b = spark.createDataFrame([("p1", "0", 1), ("p2", "x", 2)], "patient_id string, survival_event string, row int")
    got = build_clinical({"A": clinical_from_table(a, "A"), "B": clinical_from_table(b, "B")})
    assert rows(got, "study", "patient_id", "response", "response_binary") == [
        ("A", "p1", "PD", 0), ("B", "p1", None, 0), ("B", "p2", None, None),
    ]


def test_merge_cohorts_keeps_fan_out_and_score(spark):
    data = expr(
        spark,
        ("A", "p1.baseline", "G", 1.0), ("A", "p1.OnTx", "G", 2.0), ("A", "p2", "G", 3.0), ("A", "p2", "H", 3.0),
        ("B", "p1", "G", 4.0), ("B", "p9", "G", 4.0),
    )
    clinical = spark.createDataFrame(
        [("p1", "A", "PR", 1), ("p2", "A", "NE", None), ("p1", "B", "PD", 0)],
        "patient_id string, study string, response string, survival_event int",
    )
    score = spark.createDataFrame([("p1", 0.5)], "patient_id string, cytolytic_score double")
    merged = merge_cohorts(data, clinical, score, ["A", "B"])
    assert rows(merged.genes) == [("G",)]
    assert rows(merged.samples, "study", "sample_id", "survival_event", "cytolytic_score") == [
        ("A", "p1.OnTx", 1, 0.5), ("A", "p1.baseline", 1, 0.5), ("B", "p1", 0, 0.5),
    ]
    assert rows(merged.expr, "study", "sample_id", "value") == [
        ("A", "p1.OnTx", 2.0), ("A", "p1.baseline", 1.0), ("B", "p1", 4.0),
    ]
    assert merged.ml_ready().columns == ["sample_id", "patient_id", "study", "response", "survival_event"]


def test_matrix_to_samples(spark):
    cohort = matrix_to_samples(expr(spark, ("S", "Pt1.baseline", "G", 1.0), ("S", "Pt1.baseline", "G", 3.0)))
    assert rows(cohort.samples, "sample_id", "patient_id") == [("Pt1.baseline", "Pt1")]
    assert rows(cohort.expr, "gene", "value") == [("G", 2.0)]


def test_visit_cohort_drops_samples_with_text(spark):
    cells = spark.createDataFrame(
        [("S", "Patient 1 Pre-RAFi", "G", "1", 1.0), ("S", "Patient 2 Pre-RAFi", "G", "x", None),
         ("S", "Patient 2 Pre-RAFi", "H", "2", 2.0), ("S", "note", "G", "3", 3.0)],
        "study string, sample_id string, gene string, raw string, value double",
    )
    cohort = visit_cohort(cells, "S")
    assert rows(cohort.samples, "sample_id", "patient_id", "treatment_phase") == [
        ("Patient 1 Pre-RAFi", "S_Patient_1", "Pre")
    ]
    assert rows(cohort.expr, "sample_id", "value") == [("Patient 1 Pre-RAFi", 1.0)]


def test_attach_metadata_uses_metadata_id(spark):
    meta = spark.createDataFrame([("MGH-1_bam", 1), ("MGH-2", 0), (None, 0)], "sample_id string, response_binary int")
    cohort = attach_metadata(expr(spark, ("S", "MGH_1.bam", "G", 1.0), ("S", "MGH_3", "G", 1.0), ("S", None, "G", 2.0)), meta)
    assert rows(cohort.samples, "sample_id") == [("MGH-1_bam",)]
    assert rows(cohort.expr) == [("S", "MGH-1_bam", "G", 1.0)]


def portal_tables(spark):
    samples = spark.createDataFrame(
        [("s1", "p1", "nan", "CB", "anti-PD1", "F"), ("s2", "p2", "SD", None, "NA", "M"), ("s3", "p3", None, None, None, "M")],
        "SAMPLE_ID string, PATIENT_ID string, RESPONSE string, CLINICAL_BENEFIT string, SAMPLE_TREATMENT string, SEX string",
    )
    patients = spark.createDataFrame([("p1", "Male", "1:DECEASED")], "PATIENT_ID string, SEX string, OS_STATUS string")
    return samples, patients


def test_portal_study(spark):
    samples, patients = portal_tables(spark)
    spec = PORTAL_SPECS["CBIO_GIDE_2019"]
    meta = portal_metadata(spec, samples, patients)
    assert rows(meta, "sample_id", "response", "raw_response", "response_binary", "treatment", "sex", "os_status") == [
        ("s1", "CB", "nan", 1, "anti-PD1", "F", "1:DECEASED"), ("s2", "SD", "SD", None, None, "M", None),
        ("s3", None, None, None, None, "M", None),
    ]
    cells = expr(spark, (spec.study, "s1 ", "G", 1.0), (spec.study, "s2", "G", 1.0), (spec.study, "zz", "H", 1.0))
    cohort, summary = prepare_portal_study(spec, cells, samples, patients)
    assert rows(cohort.expr, "sample_id", "gene") == [("s1", "G"), ("s2", "G")]
    row = summary.first().asDict()
    assert (row["n_clean_samples"], row["n_clinical_samples"], row["n_expression_samples"], row["n_expression_genes"]) == (2, 3, 3, 2)
    assert (row["n_missing_samples_from_expression"], row["n_expression_samples_without_metadata"]) == (1, 1)
    assert (row["n_response_binary_0"], row["n_response_binary_1"], row["n_response_binary_missing"]) == (0, 1, 1)


def test_portal_without_patient_key(spark):
    samples, patients = portal_tables(spark)
    meta = portal_metadata(PORTAL_SPECS["CBIO_LIU_2019"], samples, patients.drop("PATIENT_ID"))
    assert "os_status" not in meta.columns
    with pytest.raises(ValueError, match="PATIENT_ID"):
        portal_metadata(PORTAL_SPECS["CBIO_LIU_2019"], samples.drop("PATIENT_ID"), patients)


def test_merge_labelled_uses_genes_of_all_samples(spark):
    # a gene that only a sample without label has is a gene of its dataset all the same
    schema = "study string, sample_id string, response_binary int, expression_format string"
    a = Cohort(
        spark.createDataFrame([("A", "1", 1, "TPM"), ("A", "2", None, "z")], schema),
        expr(spark, ("A", "1", "G", 1.0), ("A", "2", "H", 1.0)),
    )
    b = Cohort(
        spark.createDataFrame([(None, "1", 0, "TPM")], schema),
        expr(spark, (None, "1", "G", 2.0), (None, "1", "H", 2.0)),
    )
    merged, summary = merge_labelled_studies({"A": a, "B": b})
    assert rows(merged.expr, "study", "gene", "value") == [("A", "G", 1.0), ("B", "G", 2.0), ("B", "H", 2.0)]
    assert rows(summary, "source_dataset", "n_samples", "n_common_genes", "expression_formats") == [
        ("A", 1, 2, "TPM"), ("B", 1, 2, "TPM"),
    ]
    kept, _ = merge_labelled_studies({"A": a, "B": b}, drop_missing=False)
    assert rows(kept.expr, "study", "gene") == [("A", "G"), ("A", "H"), ("B", "G"), ("B", "H")]


def test_log_cpm(spark):
    counts = expr(spark, ("S", "a", "G", 1.0), ("S", "a", "H", 3.0), ("S", "b", "G", 0.0), ("S", "b", "H", None))
    got = {(r.sample_id, r.gene): r.value for r in C.log_cpm(counts).collect()}
    assert got[("a", "G")] == pytest.approx(math.log2(250001)) and got[("a", "H")] == pytest.approx(math.log2(750001))
    assert got[("b", "G")] is None and got[("b", "H")] is None


def test_pseudobulk_denominators(spark):
    cells = expr(spark, ("S", "a", "G", 4.0), ("S", "a", "G", None), ("S", "a", "H", None))
    assert rows(C.pseudobulk_mean(cells), "gene", "value") == [("G", 2.0), ("H", 0.0)]
    assert rows(C.pseudobulk_sum(cells), "gene", "value") == [("G", 4.0), ("H", 0.0)]


def test_valid_samples(evaluate):
    got = evaluate(valid_sample, "0/1", "Doublet", "nan", "S1/S2", "", " ", '"x"', None)
    assert got == [False, False, False, False, False, False, True, False]


def cell_metadata(spark, *values):
    return spark.createDataFrame(list(values), "barcode string, Sample string, RECIST string, row int")


def test_cells_matched_by_column(spark):
    meta = cell_metadata(
        spark, ("c1", "S1", "PD", 1), ("c1", "S2", None, 2), ("c2", " S2 ", "CR", 3), ("c3", "Doublet", "CR", 4), ("c9", "S1", "CR", 5)
    )
    cells = spark.createDataFrame(
        [("M", "c1", "G", 1.0), ("M", "c2", "G", 2.0), ("M", "c3", "G", 8.0)], "study string, cell_id string, gene string, value double"
    )
    cohort = C.sum_cells(cells, meta, "M")
    # The last row of c1 sends it to S2; S1 keeps its cell count but has no measurement left.
    assert rows(cohort.expr, "sample_id", "value") == [("S2", 3.0)]
    assert rows(cohort.samples, "sample_id", "n_cells", "response", "response_binary") == [("S2", 2, "CR", 1)]
    assert C.to_log_cpm(cohort).samples.first().expression_format.startswith("pseudobulk log2")
    assert C.cohort_summary(cohort, "M").first().n_response_1 == 1


def test_cells_matched_by_position(spark):
    meta = cell_metadata(spark, ("x", "S2", "PD", 20), ("y", "S1", "CR", 10))
    header = spark.createDataFrame([(0, "c1"), (1, "c2")], "idx int, cell_id string")
    assert rows(C.label_cells(meta, header), "cell_id", "sample_id") == [("c1", "S1"), ("c2", "S2")]


def test_column_choice():
    assert C.choose_sample_column(["x", "Patient", "sample_id"]) == "sample_id"
    assert C.choose_sample_column(["response_sample", "my_donor"]) == "my_donor"
    assert C.choose_response_column(["best_response", "Recist"]) == "Recist"
    with pytest.raises(ValueError):
        C.choose_sample_column(["a"])


def test_sum_cell_file(spark, tmp_path):
    path = tmp_path / "counts.csv"
    path.write_text("gene,c1,c2,c3\nG,1,x,5\nG,2,3,5\nH,0,0,5\n")
    meta = cell_metadata(spark, ("c1", "S1", "PD", 1), ("c2", "S1", "PD", 2))
    cohort = C.sum_cell_file(spark, str(path), meta, "M")
    assert rows(cohort.expr, "sample_id", "gene", "value") == [("S1", "G", 6.0), ("S1", "H", 0.0)]


SAMPLES = "sample_id string, patient_id string, response string, response_binary int, dataset_role string, notes string, row int"


def test_mean_cells_take_first_sample_of_patient(spark, tmp_path):
    samples = spark.createDataFrame(
        [("Post x", "P1", "NR", 0, "r", "b", 2), ("Pre x", "P1", "R", 1, "r", "a", 1), ("q", "P2", "R", 1, "r", "c", 3)], SAMPLES
    )
    path = tmp_path / "tpm.txt"
    path.write_text("\tA_P1_x\tB_P1_y\tC_P2_z\tD\nPre_P1\tPre\tPre\tPost\tPre\nG\t4\tx\t6\t1\n")
    cohort = C.mean_cell_file(spark, str(path), samples, "T")
    assert rows(cohort.expr, "sample_id", "gene", "value") == [("Pre_x", "G", 2.0), ("q", "G", 6.0)]
    assert rows(cohort.samples, "sample_id", "patient_id", "response_binary") == [("Pre_x", "P1", 1), ("q", "P2", 1)]


def test_fusing_mixed_formats_must_be_allowed(spark):
    schema = "sample_id string, response string, response_binary int, expression_format string"
    a = Cohort(spark.createDataFrame([("a 1", "R", 1, "log")], schema), expr(spark, ("x", "a 1", "G", 1.0), ("x", "a 1", "H", 1.0)))
    b = Cohort(spark.createDataFrame([("b", "R", 1, "TPM")], schema), expr(spark, ("y", "b", "G", 2.0)))
    with pytest.raises(ValueError, match="allow_mixed"):
        C.fuse_pseudobulk({"A": a, "B": b})
    fused, summary = C.fuse_pseudobulk({"A": a, "B": b}, allow_mixed=True)
    assert rows(fused.expr) == [("A", "a_1", "G", 1.0), ("B", "b", "G", 2.0)]
    assert rows(summary) == [("A", 1, 1), ("B", 1, 1), ("TOTAL_FUSION", 2, 1)]
    same, _ = C.fuse_pseudobulk({"A": a, "C": a})
    assert same.expr.count() == 4


def test_features(spark):
    data = expr(spark, ("S", "a", "G1", 1.0), ("S", "a", "G4", 4.0), ("S", "b", "G2", None), ("S", "b", "zz", 9.0))
    index = spark.createDataFrame([(i, f"G{i}") for i in range(6)], "idx bigint, gene string")
    assert rows(to_features(data, index)) == [
        ("S", "a", [None, 1.0, None, None, 4.0, None]), ("S", "b", [None] * 6),
    ]
    assert rows(to_wide(data, ["G4", "G1"])) == [("S", "a", 4.0, 1.0), ("S", "b", None, None)]


def test_summaries(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", None, "y"), (None, 2.0, "x")], "k string, v double, c string")
    assert rows(group_sizes(df, ["k"])) == [("a", 2)]
    assert [tuple(r) for r in value_counts(df, "k", with_nulls=True).collect()] == [("a", 2), (None, 1)]
    assert [tuple(r) for r in value_counts(df, "k").collect()] == [("a", 2)]
    assert rows(table_shape(df)) == [(3, 3, 2)]
    assert rows(profile_table(df, "d")) == [("d", 3, 3, 2, 1)]
    assert column_types(df)[1] == ("v", "double", True)
    assert df.agg(distinct_texts(F.col("c"))).first()[0] == "x; y"
    assert rows(distinct_values(df, ["k", "c"], first=1)) == [("c", 2, ["x"]), ("k", 1, ["a"])]
    assert conform(df.withColumnRenamed("k", "study")).columns[0] == "study"


def test_drop_missing_counts_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, v int")
    kept, seen = drop_missing(df, ["k", "v"])
    assert rows(kept) == [("a", 1)]
    assert seen.get == {"rows_before": 3, "rows_after": 1}


def test_matrix_profile_file(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Gene;s1;s2\nENSG1.2;1;x\nENSG1.3;;2\n;1;1\n")
    main = spark.createDataFrame([("ENSG1",), ("Z",)], "gene string")
    row = profile_matrix_file(spark, str(path), "D", main).first().asDict()
    assert (row["separator"], row["n_unique_genes"], row["n_samples"], row["n_missing_cells"]) == (";", 1, 2, 1)
    assert (row["n_numeric_samples"], row["n_common_genes"], row["n_main_genes"]) == (1, 1, 2)
    assert (row["n_rows"], row["n_missing_genes"]) == (3, 1)


def test_matrix_profile_counts_missing_genes(spark):
    cells = spark.createDataFrame(
        [("S", None, 1, "s", "1"), ("S", "G", 2, "s", None), ("S", "G", 3, "s", "2")],
        "study string, gene string, gene_row bigint, sample_id string, raw string",
    )
    assert rows(matrix_profile(cells), "n_rows", "n_unique_genes", "n_missing_genes", "n_missing_cells", "n_samples") == [
        (3, 1, 1, 1, 1)
    ]


def test_summary_rows_report_failures(spark):
    good = spark.createDataFrame([(1,)], "n int")
    bad = spark.createDataFrame([("x",)], "t string").select(F.raise_error(F.col("t")).alias("n"))
    table = summary_rows(spark, {"good": lambda: good, "bad": lambda: bad})
    got = {r.dataset: r for r in table.collect()}
    assert got["good"].n == 1 and got["good"].error is None
    assert got["bad"].n is None and "x" in got["bad"].error


def test_spellings_of_one_sample_stay_apart(spark):
    measured = expr(spark, ("S", "A_1", "G", 1.0), ("S", "A-1.bam", "G", 3.0), ("S", "B-2", "G", 5.0), ("S", "C", "G", 7.0), ("S", None, "G", 9.0))
    meta = spark.createDataFrame([("A-1", "x"), ("B_2", "y"), ("B-2_bam", "z"), ("D", "w"), (None, "v")], "sample_id string, treatment string")
    cohort = attach_metadata(measured, meta)
    assert rows(cohort.samples, "sample_id", "treatment") == [
        ("A-1 [A-1.bam]", "x"), ("A-1 [A_1]", "x"), ("B-2_bam", "z"), ("B_2", "y"),
    ]
    assert rows(cohort.expr, "study", "sample_id", "gene", "value") == [
        ("S", "A-1 [A-1.bam]", "G", 3.0), ("S", "A-1 [A_1]", "G", 1.0), ("S", "B-2_bam", "G", 5.0), ("S", "B_2", "G", 5.0),
    ]
    index = spark.createDataFrame([(0, "G")], "idx int, gene string")
    assert to_features(cohort.expr, index).count() == 4
