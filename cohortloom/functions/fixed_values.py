"""Word lists, tokens and patterns that results depend on.

Nothing here is logic. Changing an entry changes results, so every list is
kept in one place, in natural order.
"""

# Texts read as a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Characters removed from both ends of a text (Unicode blanks).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a finite decimal number, optionally signed, in plain or exponent form.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Texts that say nothing about a sample.
UNINFORMATIVE = ("", "nan", "na", "n/a", "unknown")

# Sample ids that mark an unassigned cell (upper case).
INVALID_SAMPLES = (
    "NAN",
    "NA",
    "NONE",
    "UNKNOWN",
    "UNASSIGNED",
    "NEGATIVE",
    "MULTIPLET",
    "DOUBLET",
    "0/1",
    "1/0",
)

# Columns of a matrix that describe the gene, not a sample.
TECHNICAL_COLUMNS = ("entrez_gene_id", "cytoband", "description", "gene_id")

# Suffixes of a patient id that name the visit.
VISIT_SUFFIXES = (".baseline", ".OnTx")

# The standard columns of a sample table, in order.
STANDARD_COLUMNS = (
    ("study", "string"),
    ("platform", "string"),
    ("sample_id", "string"),
    ("geo_accession", "string"),
    ("patient_id", "string"),
    ("treatment", "string"),
    ("timepoint", "string"),
    ("response", "string"),
    ("response_binary", "int"),
    ("dataset_role", "string"),
    ("notes", "string"),
)

# Columns of the clinical table.
CLINICAL_COLUMNS = (
    ("patient_id", "string"),
    ("response", "string"),
    ("survival_event", "int"),
    ("response_binary", "int"),
    ("study", "string"),
    ("age", "string"),
    ("gender", "string"),
    ("disease_status", "string"),
    ("overall_survival_days", "string"),
    ("vital_status", "string"),
    ("previous_mapki", "string"),
    ("biopsy_time", "string"),
    ("treatment", "string"),
)

# Clinical columns carried over, when a portal study has them.
PORTAL_OPTIONAL_COLUMNS = (
    "BIOPSY_SITE",
    "BIOPSY_TIME",
    "SAMPLE_TREATMENT",
    "TREATMENT",
    "IO_THERAPY",
    "CLINICAL_BENEFIT",
    "DURABLE_CLINICAL_BENEFIT",
    "RESPONSE",
    "TREATMENT_RESPONSE",
    "PROGRESSION",
    "PFS_STATUS",
    "PFS_MONTHS",
    "OS_STATUS",
    "OS_MONTHS",
    "SEX",
    "AGE_AT_DIAGNOSIS",
    "M_STAGE",
    "PRIOR_ICI_RX",
    "PRIOR_RX",
    "PRIOR_CTLA4",
    "PRIOR_MAPK_TX",
    "TMB_NONSYNONYMOUS",
    "MUTATION_LOAD",
)

# Names under which a gene column may appear, by preference.
GENE_COLUMN_CANDIDATES = (
    "Gene",
    "gene",
    "GENE",
    "Gene Name",
    "GENE_ID",
    "gene_id",
    "Gene_ID",
    "Hugo_Symbol",
    "Gene Symbol",
    "GENE_SYMBOL",
    "Unnamed: 0",
)

# The gene column of a portal study, of most extra cohorts, and of the targeted extra cohort.
PORTAL_GENE_COLUMNS = ("Hugo_Symbol", "Gene Symbol", "GENE_SYMBOL")
EXTRA_GENE_COLUMNS = ("Gene", "gene", "GENE", "Gene Name", "Unnamed: 0")
TARGETED_GENE_COLUMNS = ("GENE_ID", "Gene", "gene", "GENE", "Gene Name", "Unnamed: 0")

# Columns of cell metadata that may name the sample, by preference.
SAMPLE_COLUMN_CANDIDATES = (
    "sample",
    "sample_id",
    "Sample",
    "Sample_ID",
    "patient",
    "patient_id",
    "Patient",
    "Patient_ID",
    "assignment",
    "Assignment",
    "orig.ident",
    "library",
    "Library",
)
SAMPLE_COLUMN_WORDS = ("sample", "patient", "assignment", "library", "donor")
RESPONSE_COLUMN_WORDS = ("recist", "response")

# Attribute lines that are read, by prefix of their key.
ATTRIBUTE_PREFIXES = (
    "!Sample_geo_accession",
    "!Sample_title",
    "!Sample_source_name_ch1",
    "!Sample_description",
    "!Sample_platform_id",
    "!Sample_characteristics_ch1",
)
TITLE_KEY = "!Sample_title"
CHARACTERISTICS_KEY = "!Sample_characteristics_ch1"

# Text within a characteristics line -> column; the first hit counts.
CHARACTERISTIC_RULES = (
    ("anti-pd-1 response", "response"),
    ("age (yrs)", "age"),
    ("gender", "gender"),
    ("disease status", "disease_status"),
    ("overall survival (days)", "overall_survival_days"),
    ("vital status", "vital_status"),
    ("previous mapki", "previous_mapki"),
    ("biopsy time", "biopsy_time"),
    ("treatment:", "treatment"),
)

# Text within a file name -> measurement format; the first hit counts.
FORMAT_RULES = (
    ("tpm", "TPM"),
    ("rpkm", "RPKM"),
    ("fpkm", "FPKM"),
    ("zscore", "z-score"),
    ("count", "counts"),
    ("mrna", "mRNA expression, format exact à confirmer"),
    ("expression", "mRNA expression, format exact à confirmer"),
)
FORMAT_UNKNOWN = "unknown"

# What makes a .txt file an expression file, and what rules it out.
EXPRESSION_WORDS = ("data_mrna", "expression", "rpkm", "tpm", "fpkm", "zscore")
NOT_EXPRESSION_WORDS = (
    "genetic_alteration",
    "case_lists",
    "meta_",
    "clinical",
    "mutation",
    "cna",
    "timeline",
    "signature",
)

# Text within a .csv/.tsv name -> (table kind, format, rows previewed; None = all).
CELL_TABLE_RULES = (
    ("rna_counts", "single_cell_rna_counts", "counts", 5),
    ("adt_counts", "single_cell_adt_counts", "ADT counts", 5),
    ("metadata", "metadata", None, None),
    ("barcode", "sample_barcode_assignment", None, None),
)
CELL_TABLE_UNKNOWN = ("unknown_tabular", None, 20)

# Words that mark a clinically useful column, one list per kind of input.
TARGETED_KEYWORDS = (
    "patient", "sample", "response", "resistance", "responder",
    "treatment", "therapy", "braf", "mek", "group", "time",
)
VISIT_KEYWORDS = (
    "patient", "sample", "response", "resistance", "responder",
    "treatment", "therapy", "braf", "mek", "raf", "pre", "post",
    "relapse", "progression", "time", "group",
)
ATTRIBUTE_KEYWORDS = (
    "response", "responder", "nonresponder", "non_responder", "clinical",
    "benefit", "recist", "progression", "progressed", "survival", "vital",
    "death", "alive", "treatment", "therapy", "anti", "pd1", "pd_1", "pdl1",
    "ctla", "ipilimumab", "nivolumab", "pembrolizumab", "time", "timepoint",
    "baseline", "pre", "on", "post", "patient", "subject", "sample", "stage",
    "sex", "gender", "age", "braf", "nras", "nf1", "mapk", "mek", "raf",
)
PORTAL_KEYWORDS = (
    "response", "recist", "radiographic", "benefit", "progression", "pfs",
    "os", "survival", "vital", "death", "status", "treatment", "therapy",
    "immunotherapy", "anti", "pd1", "pd-1", "pdl1", "pd-l1", "ctla",
    "ipilimumab", "nivolumab", "pembrolizumab", "melanoma", "stage", "sex",
    "gender", "age", "biopsy", "sample", "patient", "tmb", "mutation", "braf",
    "mapk", "prior", "resistance", "resistant",
)

# Outcome label policies. Each rule is (match kind, label, tokens);
# rules are tried in order on the stripped upper-case text.
LABEL_POLICIES = {
    "main": (
        ("equals", 0, ("PD", "PROGRESSIVE DISEASE")),
        ("equals", 1, (
            "SD", "STABLE DISEASE", "PR", "PARTIAL RESPONSE", "CR", "COMPLETE RESPONSE",
        )),
    ),
    "responder": (
        ("equals", 1, (
            "R", "RESPONDER", "RESPONSE", "LR", "LONG RESPONDER", "LONG_RESPONSE",
            "LONG-RESPONDER",
        )),
        ("equals", 0, (
            "NR", "NON-RESPONDER", "NON_RESPONDER", "NONRESPONDER", "NON RESPONSE",
            "NON-RESPONSE", "SR", "SHORT RESPONDER", "SHORT_RESPONSE", "SHORT-RESPONDER",
            "RESISTANT",
        )),
    ),
    "portal": (
        ("contains", 0, ("PROGRESSION",)),
        ("contains", 1, ("CENSORED",)),
        ("contains", 1, ("DISEASEFREE", "DISEASE FREE")),
        ("contains", 0, ("RECURRED", "PROGRESSED", "DECEASED", "DEAD")),
        ("equals", 1, (
            "R", "RESPONDER", "RESPONSE", "CR", "PR", "COMPLETE RESPONSE",
            "PARTIAL RESPONSE", "YES", "TRUE", "BENEFIT", "CLINICAL BENEFIT",
            "DURABLE CLINICAL BENEFIT", "DCB", "CB",
        )),
        ("equals", 0, (
            "NR", "NON-RESPONDER", "NON_RESPONDER", "NONRESPONDER", "NO RESPONSE",
            "PROGRESSIVE DISEASE", "PD", "NO BENEFIT", "NO CLINICAL BENEFIT",
            "NON-DURABLE CLINICAL BENEFIT", "NDB", "NCB", "FALSE", "NO",
        )),
        ("equals", None, ("SD", "STABLE DISEASE")),
    ),
    "recist": (
        ("equals", 1, (
            "CR", "COMPLETE RESPONSE", "COMPLETE_RESPONSE", "PR", "PARTIAL RESPONSE",
            "PARTIAL_RESPONSE", "RESPONDER", "RESPONSE", "R",
        )),
        ("equals", 0, (
            "PD", "PROGRESSIVE DISEASE", "PROGRESSIVE_DISEASE", "PROGRESSION",
            "NON-RESPONDER", "NON_RESPONDER", "NONRESPONDER", "NR",
        )),
        ("equals", None, ("SD", "STABLE DISEASE", "STABLE_DISEASE")),
        ("contains", 1, ("COMPLETE",)),
        ("contains", 1, ("PARTIAL",)),
        ("contains", 0, ("PROGRESS",)),
        ("contains", None, ("STABLE",)),
    ),
}
