import gzip

import random

import pytest
from conftest import rows
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from cohortloom.functions.text import strip
from cohortloom.plans.clinical import build_clinical, clinical_from_attributes
from cohortloom.plans.metadata import COHORT_SPECS, extract_metadata, standardise_metadata
from cohortloom.sinks.tables import write_table
from cohortloom.sources import attributes as A
from cohortloom.sources.catalog import classify_cell_tables, classify_files, pick_member
from cohortloom.sources.matrix import cell_columns, matrix_columns, scan_cell_matrix, scan_matrix_long
from cohortloom.sources.tables import detect_separator, first_lines, header_names, matrix_header, scan_table


def put(tmp_path, name, text):
    path = tmp_path / name
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def test_scan_table(spark, tmp_path):
    path = put(tmp_path, "t.csv", ' id ,v,v,\n1,"a,b",NA,x\n\n2,n/a,"c",\n')
    table = scan_table(spark, path)
    assert table.columns == ["id", "v", "v.1", "Unnamed: 3"]
    assert rows(table) == [("1", "a,b", None, "x"), ("2", None, "c", None)]


def test_scan_table_keeps_file_order(spark, tmp_path):
    path = put(tmp_path, "t.csv", "k,v\n" + "".join(f"k,{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        table = scan_table(spark, path, with_row=True)
        assert table.rdd.getNumPartitions() > 3
        assert [int(r.v) for r in table.orderBy("_row").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scan_gzip_and_comments(spark, tmp_path):
    alias = put(tmp_path, "a.txt.gz", "#string_protein_id\talias\tsource\np\t7\tE\n")
    assert rows(scan_table(spark, alias, sep="\t")) == [("p", "7", "E")]
    text = '#note\nA\tB\tC\n1\tx#y\tz\n# gone\n"#q"\t"a#b"\tc#d\n\n3\tNA\t5\n'
    portal = put(tmp_path, "p.txt", text)
    assert rows(scan_table(spark, portal, sep="\t", comment="#")) == [
        ("#q", "a#b", "c"), ("1", "x", None), ("3", None, "5"),
    ]


@pytest.mark.parametrize("line, sep", [("a,b\n1,2\n", ","), ("a\tb\n", "\t"), ("a;b\n", ";"), ("a|b|c\n1|2|3\n", "|")])
def test_detect_separator(spark, tmp_path, line, sep):
    assert detect_separator(spark, put(tmp_path, "t.txt", line)) == sep


def test_header_only(spark, tmp_path):
    assert matrix_header(spark, put(tmp_path, "t.csv", "g,s1,s1,s1\n")) == ["g", "s1", "s1.1", "s1.2"]
    assert header_names('"a,x" ,b', ",") == ["a,x", "b"]


MATRIX = 'Hugo_Symbol\tEntrez_Gene_Id\ts1\ts1\t"s 2"\nTP53\t1\t1\tNA\t2d\n"A\tB"\t2\t5\t\t6\n\t3\t1\t1\t1\nTP53\t4\t3\t4\t5\t99\nshort\n'


def test_scan_matrix(spark, tmp_path):
    cells = scan_matrix_long(spark, put(tmp_path, "m.txt", MATRIX), "S", sep="\t")
    assert rows(cells, "gene", "sample_id", "raw", "value") == sorted(
        [
            ("TP53", "s1", "1", 1.0), ("TP53", "s1.1", None, None), ("TP53", "s 2", "2d", None),
            ("A\tB", "s1", "5", 5.0), ("A\tB", "s1.1", None, None), ("A\tB", "s 2", "6", 6.0),
            ("TP53", "s1", "3", 3.0), ("TP53", "s1.1", "4", 4.0), ("TP53", "s 2", "5", 5.0),
        ],
        key=repr,
    )


def test_scan_matrix_selects_samples(spark, tmp_path):
    path = put(tmp_path, "m.csv", "Unnamed,Patient 1 Pre-RAFi,other\ng,1,2\n")
    cells = scan_matrix_long(spark, path, "S", sample_pattern="^Patient")
    assert rows(cells, "sample_id", "value") == [("Patient 1 Pre-RAFi", 1.0)]
    with pytest.raises(ValueError, match="no sample column"):
        scan_matrix_long(spark, path, "S", sample_pattern="^None")


def test_scan_cell_matrix(spark, tmp_path):
    path = put(tmp_path, "c.txt", "\tA_P1_x\tB_P2_y\tC_P1_z\nPre_P1\tPre_P1\tPost_P2\tPre_P1\n\nG1\t1\t2\t3\t9\n G1 \t4\tx\t\n")
    assert rows(cell_columns(spark, path, "\t")) == [(0, "A_P1_x"), (1, "B_P2_y"), (2, "C_P1_z")]
    samples = spark.createDataFrame([("A_P1_x", "S1"), ("C_P1_z", "S1")], "cell_id string, sample_id string")
    cells = scan_cell_matrix(spark, path, "S", samples, "\t", skip_gene_pattern="^(Pre|Post)_", min_fields=2)
    assert rows(cells, "sample_id", "gene", "raw", "value") == sorted(
        [("S1", "G1", "1", 1.0), ("S1", "G1", "3", 3.0), ("S1", "G1", "4", 4.0), ("S1", "G1", "", None)], key=repr
    )


SERIES = "\n".join(
    [
        '!Series_title\t"ignored"',
        '!Sample_title\t"Pt1.baseline"\t"Pt2.OnTx"\t"Pt2"',
        '!Sample_other\t"x"\t"y"\t"z"',
        '!Sample_characteristics_ch1\t"Pt ID (a/b-c): p1"\t"Pt ID (a/b-c): p:2"\tplain',
        '!Sample_characteristics_ch1\t"Pt ID (a/b-c): q1"\t""\t"Pt ID (a/b-c): q3"',
        '!Sample_characteristics_ch1\t"anti-PD-1 response: PD"\t"anti-pd-1 response: x: CR"\t"anti-pd-1 response: NE"',
        '!Sample_characteristics_ch1\t"gender: F"\t"gender: M"',
        '!Sample_characteristics_ch1\t"age (yrs): 1"\t"age (yrs): 2"\t"age (yrs): 3"',
        '!Sample_characteristics_ch1\t"Age (yrs): 4"\t"Age (yrs): 5"\t"Age (yrs): 6"',
        '!Sample_description\t"old"',
        '!Sample_description\t"d1"\t"d2"',
        "table",
    ]
)


def test_extract_metadata(spark, tmp_path):
    table = extract_metadata(spark, put(tmp_path, "s.txt.gz", SERIES)).orderBy("sample_idx")
    got = [r.asDict() for r in table.collect()]
    assert [r["title"] for r in got] == ["Pt1.baseline", "Pt2.OnTx", "Pt2"]
    assert [r["characteristics_pt_id_a_b_c"] for r in got] == ["p1", "p:2", "plain"]
    assert [r["characteristics_pt_id_a_b_c_2"] for r in got] == ["q1", None, "q3"]
    assert [r["characteristics_gender"] for r in got] == ["F", "M", None]
    assert [r["description"] for r in got] == ["d1", "d2", None]
    assert [r["characteristics_age_yrs_2"] for r in got] == ["4", "5", "6"]
    assert "other" not in table.columns


def attribute_rows(spark, labels):
    lines = [
        ("f", i, 0, A.CHARACTERISTICS_KEY, [f"{label}: {i}"]) for i, label in enumerate(labels)
    ]
    return spark.createDataFrame(
        lines, "file string, line_no int, block int, key string, fields array<string>"
    )


@pytest.mark.parametrize(
    "labels, expected",
    [
        (["x", "x", "x_2"], ["x", "x_2", "x_2_2"]),
        (["x", "x_2", "x"], ["x", "x_2", "x_3"]),
        (["x", "x", "x"], ["x", "x_2", "x_3"]),
        (["x_2", "x", "x", "x"], ["x_2", "x", "x_3", "x_4"]),
    ],
)
def test_repeated_labels(spark, labels, expected):
    named = A.named_attributes(attribute_rows(spark, labels))
    got = {int(r.value): r.name for r in named.collect()}
    assert [got[i] for i in range(len(labels))] == [f"characteristics_{name}" for name in expected]


def first_free(labels):
    """Names one line after the other, as a file is read."""
    names = []
    for label in labels:
        n, name = 1, label
        while name in names:
            n += 1
            name = f"{label}_{n}"
        names.append(name)
    return names


@pytest.mark.parametrize("seed", range(6))
def test_labels_that_are_numbers_of_others(spark, seed):
    draw = random.Random(seed)
    kinds = ["x", "x_2", "x_3", "x_2_2", "x_4", "y", "x_2_3"]
    files = [[draw.choice(kinds[: 2 + seed]) for _ in range(draw.randint(1, 30))] for _ in range(8)]
    if seed == 0:
        files = [["x"] * 40 + [f"x_{k}" for k in range(2, 30)] + ["x"] * 9, [f"x_{k}" for k in range(9, 1, -1)] + ["x"] * 20]
    table = spark.createDataFrame(
        [(str(f), i, label, labels[:i].count(label) + 1) for f, labels in enumerate(files) for i, label in enumerate(labels)],
        "file string, line_no int, slug string, n bigint",
    )
    got = {(r.file, r.line_no): r.name for r in A._settle_collisions(table).collect()}
    assert got == {(str(f), i): name for f, labels in enumerate(files) for i, name in enumerate(first_free(labels))}


def test_many_lines_of_one_label(spark):
    import time

    table = spark.range(100_000).selectExpr("'f' AS file", "id AS line_no", "IF(id = 70000, 'x_500', 'x') AS slug")
    table = table.selectExpr("*", "IF(id = 70000, 1, line_no + IF(line_no > 70000, 0, 1)) AS n".replace("id =", "line_no ="))
    began = time.perf_counter()
    named = A._settle_collisions(table)
    assert named.select("name").distinct().count() == 100_000
    # line 499 had the number 500 before the label x_500 came
    assert rows(named.filter("line_no IN (499, 70000)"), "name") == [("x_500",), ("x_500_2",)]
    assert time.perf_counter() - began < 60


def test_clinical_from_attributes(spark, tmp_path):
    lines = A.scan_attribute_lines(spark, put(tmp_path, "s.txt", SERIES))
    clinical = build_clinical({"S": clinical_from_attributes(lines, "S")})
    assert rows(clinical, "patient_id", "response", "response_binary", "age", "gender", "study") == [
        ("Pt1", "PD", 0, "4", None, "S"), ("Pt2", "CR", 1, "5", None, "S"),
    ]


def test_response_of_wrong_length_is_an_error(spark, tmp_path):
    text = '!Sample_title\ta\tb\n!Sample_characteristics_ch1\tanti-PD-1 response: PD\n'
    lines = A.scan_attribute_lines(spark, put(tmp_path, "s.txt", text))
    with pytest.raises(PySparkException, match="number of responses"):
        A.extract_labelled_attributes(lines).collect()


def test_standard_metadata_of_extracted_table(spark, tmp_path):
    text = '!Sample_title\t"EX99 [pt5]"\t"EY00"\n!Sample_characteristics_ch1\t"sample class: PRE SR"\t"sample class: POST LR"\n'
    table = extract_metadata(spark, put(tmp_path, "s.txt", text))
    got = standardise_metadata(table, COHORT_SPECS["GSE196434"])
    assert rows(got, "study", "sample_id", "patient_id", "timepoint", "response", "response_binary", "platform") == [
        ("GSE196434", "EX99", "pt5", "PRE", "SR", 0, None), ("GSE196434", "EY00", None, "POST", "LR", 1, None),
    ]


def test_catalog(spark):
    names = ["a/data_mrna_TPM.txt", "a/data_clinical_sample.txt", "a/rna_counts.csv", "b/RNA_counts.csv", "x.tsv"]
    catalog = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "path string, ord int")
    assert rows(classify_files(catalog), "path", "format", "is_expression", "is_clinical")[0] == (
        "a/data_clinical_sample.txt", "unknown", False, True,
    )
    assert rows(classify_cell_tables(catalog), "path", "kind", "preview_rows")[-1] == ("x.tsv", "unknown_tabular", 20)
    assert rows(pick_member(catalog, "RNA_counts")) == [("a/rna_counts.csv", 2)]


def test_write_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s", "a", 1.5), ("t", None, None)], "study string, g string, v double")
    write_table(df, str(tmp_path / "p"), partition_by=["study"])
    assert rows(spark.read.parquet(str(tmp_path / "p")), "study", "g", "v") == rows(df)
    write_table(df, str(tmp_path / "c"), "csv")
    assert rows(scan_table(spark, str(tmp_path / "c"))) == [("s", "a", "1.5"), ("t", None, None)]
    assert strip(F.lit(" x ")) is not None


def test_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'a,b,c\n1,"a ""b"" c",z\n3,"k\\",m\n4,"two\nlines",n\n')
    assert rows(scan_table(spark, path, multi_line=True)) == sorted(
        [("1", 'a "b" c', "z"), ("3", "k\\", "m"), ("4", "two\nlines", "n")], key=repr
    )
    commented = put(tmp_path, "qc.csv", '# x\na,b\n1,"a ""b"" c"\n')
    assert rows(scan_table(spark, commented, comment="#")) == [("1", 'a "b" c')]
    matrix = put(tmp_path, "qm.csv", 'Gene,s1\n"G ""1""",2\n')
    assert rows(scan_matrix_long(spark, matrix, "S", clean_gene=strip), "gene", "value") == [('G "1"', 2.0)]


def test_names_that_differ_in_case(spark, tmp_path):
    table = scan_table(spark, put(tmp_path, "c.csv", "RESPONSE,response\nPD,CR\n"))
    assert table.columns == ["RESPONSE", "response.1"] and rows(table) == [("PD", "CR")]


def test_only_the_first_line_is_a_header(spark, tmp_path):
    path = put(tmp_path, "h.csv", "Gene,s1\nA,1\nGene,s1\nB,2\n")
    assert rows(scan_matrix_long(spark, path, "S"), "gene", "raw") == [("A", "1"), ("B", "2"), ("Gene", "s1")]
    assert rows(scan_table(spark, path)) == [("A", "1"), ("B", "2"), ("Gene", "s1")]


def test_files_of_a_folder_are_matched_by_name(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    put(folder, "1.csv", "Gene,s1,s2\nA,1,2\n")
    put(folder, "2.csv", "Gene,s2,s1\nB,3,4\n")
    cells = scan_matrix_long(spark, str(folder), "S")
    assert rows(cells, "gene", "sample_id", "value") == [("A", "s1", 1.0), ("A", "s2", 2.0), ("B", "s1", 4.0), ("B", "s2", 3.0)]
    assert cells.select("gene_row").distinct().count() == 2
    assert rows(scan_table(spark, str(folder)), "Gene", "s1", "s2") == [("A", "1", "2"), ("B", "4", "3")]
    put(folder, "3.csv", "Gene,s1,other\nC,1,2\n")
    with pytest.raises(ValueError, match="different columns"):
        scan_table(spark, str(folder))


def test_missing_genes_and_short_lines(spark, tmp_path):
    path = put(tmp_path, "na.csv", "Gene,s1\nNA,1\nNone,2\nnull,3\nA,4\nlonely\n")
    assert rows(scan_matrix_long(spark, path, "S"), "gene", "raw") == [("A", "4")]
    kept = scan_matrix_long(spark, path, "S", keep_unnamed=True)
    assert kept.filter("gene is null").count() == 3


def test_gene_candidates_of_a_study(spark, tmp_path):
    path = put(tmp_path, "p.txt", "Hugo_Symbol\tgene_id\ts1\nTP53\t7157\t1\n")
    cells = scan_matrix_long(
        spark, path, "S", "\t", gene_candidates=("Hugo_Symbol", "Gene Symbol", "GENE_SYMBOL"), drop_columns=("gene_id",)
    )
    assert rows(cells, "sample_id", "gene") == [("s1", "TP53")]


def test_counts_keep_genes_called_pre(spark, tmp_path):
    path = put(tmp_path, "n.csv", ",A,B\nPre_B1,1,2\nG,3,4\n")
    samples = spark.createDataFrame([("A", "S1"), ("B", "S1")], "cell_id string, sample_id string")
    assert rows(scan_cell_matrix(spark, path, "S", samples).select("gene").distinct()) == [("G",), ("Pre_B1",)]


def test_broken_records_are_refused(spark, tmp_path):
    from cohortloom.sources.matrix import scan_matrix_long

    whole = put(tmp_path, "whole.csv", 'Gene,s\n"A,b",1\n"say ""x""",2\n5",3\n"c,",4\n')
    assert rows(scan_matrix_long(spark, whole, "S"), "gene", "raw") == [('5', "3"), ("A,b", "1"), ("c,", "4"), ("say x", "2")]
    broken = put(tmp_path, "broken.csv", 'Gene,s\n"A\nb",1\n')
    with pytest.raises(Exception, match="line break"):
        scan_matrix_long(spark, broken, "S").collect()


def test_folder_headers_stay_in_spark(spark, tmp_path, monkeypatch):
    """Only hashes of the headers of a folder reach the driver; names in another order are matched, other names refused."""
    from cohortloom.sources import tables
    from cohortloom.sources.matrix import scan_matrix_long

    folder = tmp_path / "m"
    folder.mkdir()
    put(folder, "a.csv", "Gene,s1,s2\nG,1,2\n")
    put(folder, "b.csv", 's2,"Gene",s1\n4,H,3\n')
    put(folder, "c.csv", "Gene,s1,s2\nI,5,6\n")
    groups = tables.header_groups(spark, str(folder))
    assert sorted(len(g) for g in groups) == [1, 2]
    monkeypatch.setattr(tables, "first_line", None)
    got = rows(scan_matrix_long(spark, str(folder), "S"), "gene", "sample_id", "value")
    assert got == [("G", "s1", 1.0), ("G", "s2", 2.0), ("H", "s1", 3.0), ("H", "s2", 4.0), ("I", "s1", 5.0), ("I", "s2", 6.0)]
    put(folder, "d.csv", "Gene,s1,s3\nI,5,6\n")
    with pytest.raises(ValueError, match="different columns"):
        scan_matrix_long(spark, str(folder), "S")


def test_header_stands_in_the_first_block(spark, tmp_path, monkeypatch):
    # a file of many blocks, which reach the driver's side in any order: here the last comes first
    lines = [f"G{i},{i}" for i in range(2000)]
    path = put(tmp_path, "blocks.csv", "\n".join(["", "Gene,s1", *lines]) + "\n")
    read = DataFrameReader.text
    place = F.col("_metadata.file_block_start")
    monkeypatch.setattr(DataFrameReader, "text", lambda self, *a, **k: read(self, *a, **k).orderBy(place.desc()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert rows(matrix_columns(spark, path)) == [(0, "Gene"), (1, "s1")]
        assert scan_matrix_long(spark, path, "S").agg(F.count("value"), F.sum("value")).first() == (2000, 1999000.0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_lines_are_found_without_sorting_all(spark, tmp_path):
    (tmp_path / "many").mkdir()
    put(tmp_path / "many", "a.csv", "\n#c\nid,v\n" + "id,v\nv,id\n" * 500)
    put(tmp_path / "many", "b.csv.gz", "v,id\n" + "id,v\n" * 500)
    put(tmp_path / "many", "blank.csv", " \n")
    found = first_lines(spark, str(tmp_path / "many"), "#")
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.file.rsplit("/", 1)[-1], r.header) for r in found.collect())
    assert got == [("a.csv", "id,v"), ("b.csv.gz", "v,id")]
