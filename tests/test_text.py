"""Scalar rules; expected values written by hand."""

from pyspark.sql import functions as F

from cohortloom.functions import text as T
from cohortloom.functions.numeric import missing_to_null, to_number


def test_clean_text(evaluate):
    assert evaluate(T.clean_text, ' "a b"\t', '""', " ", None) == ["a b", None, None, None]
    assert evaluate(lambda c: T.clean_text(c, keep_empty=True), '""', None) == ["", None]
    assert evaluate(T.clean_text, "  x ") == ["x"]


def test_gene_names(evaluate):
    assert evaluate(T.clean_gene_symbol, " TP53 ", "NaN", "", None) == ["TP53", None, None, None]
    assert evaluate(T.clean_gene_id, "ENSG00000141510.15", '"AC01.2"', "nan", "ENSG1") == [
        "ENSG00000141510", "AC01.2", None, "ENSG1",
    ]


def test_visit_suffix(evaluate):
    assert evaluate(T.drop_visit_suffix, "Pt1.baseline", " Pt2.OnTx ", "Pt3") == ["Pt1", "Pt2", "Pt3"]


def test_visit_column(evaluate):
    parse = lambda c: T.parse_visit_column(c, "GSE77940")
    assert evaluate(
        parse, "Patient 3 Post-RAF/MEKi", " Patient 1 Pre-RAFi", "Symbol", "Patient x Pre-RAFi", "Patient 2 Pre-", None
    ) == [
        ("GSE77940_Patient_3", "Post", "RAF_MEKi"), ("GSE77940_Patient_1", "Pre", "RAFi"), None, None, None, None,
    ]


def test_brackets(evaluate):
    assert evaluate(T.bracket_sample, "EX99 [pt5]", "EX99", None) == ["EX99", "EX99", None]
    assert evaluate(T.bracket_patient, "EX99 [ pt5 ] [x]", "EX99", "EX []") == ["pt5", None, ""]


def test_sample_class(evaluate):
    assert evaluate(T.split_sample_class, "PRE SR", "POST", " PRE  LR x", "", None) == [
        ("PRE", "SR"), ("POST", None), ("PRE", "LR"), (None, None), (None, None),
    ]


def test_visit_prefix(evaluate):
    assert evaluate(T.split_visit_prefix, "Pre_P1", "Post_P1_2", "P7", None) == [
        ("PRE", "P1"), ("POST", "P1_2"), (None, "P7"), (None, None),
    ]


def test_description(evaluate):
    assert evaluate(T.patient_from_description, "MGH Patient 200", "MGH Patient PDL 002", "MGH7", " 8", None) == [
        "MGH200", "MGHPDL002", "MGH7", "MGH8", None,
    ]


def test_sample_keys(evaluate):
    assert evaluate(T.sample_join_key, "MGH-1_bam", "MGH_1.bam", None) == ["MGH_1", "MGH_1", None]
    assert evaluate(T.normalise_sample_id, " a b c ", None) == ["a_b_c", None]


def test_cell_id(evaluate):
    assert evaluate(
        T.patient_from_cell_id, "A10_P3_M11", "A10_Px_1", "A10", "P1x_Q_P2_P3", "_P5", "A_b_c", "P4", None, "P12_P13"
    ) == ["P3", "Px", None, "P2", "P5", None, None, None, "P12"]


def test_attributes(evaluate):
    assert evaluate(T.after_first_colon, "a: b: c", "plain", "a:") == ["b: c", "plain", ""]
    assert evaluate(T.after_last_colon, "a: b: c", "plain", "a:") == ["c", "plain", ""]
    assert evaluate(T.attribute_slug, "Pt ID (a/b-c): 1", "none", None) == [
        "characteristics_pt_id_a_b_c", "characteristics_unknown", "characteristics_unknown",
    ]
    assert evaluate(T.attribute_key, "!Sample_Title") == ["title"]


def test_first_informative(spark):
    df = spark.createDataFrame(
        [(" nan", "x"), ('"R"', "x"), (None, "N/A"), ("", "unknown")], "a string, b string"
    )
    got = df.select(T.first_informative([F.col("a"), F.col("b")]).alias("v")).collect()
    assert [r.v for r in got] == ["x", "R", None, None]


def test_note(spark):
    df = spark.createDataFrame([("F", None)], "g string, s string")
    note = df.select(T.compose_note([("gender", F.col("g")), ("stage", F.col("s"))]).alias("n")).first().n
    assert note == "gender=F; stage=nan"


def test_numbers(evaluate):
    assert evaluate(to_number, "1d", "nan", " 5 ", "1e3", "x", "-.5", "+2.", "inf", "1e999", "0x1p3", "", None) == [
        None, None, 5.0, 1000.0, None, -0.5, 2.0, None, None, None, None, None,
    ]


def test_missing_tokens(evaluate):
    assert evaluate(missing_to_null, "", "NA", "n/a", "na", "<NA>", "0", None) == [None, None, None, "na", None, "0", None]
