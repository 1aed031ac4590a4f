"""Fixed values that decide results. They are business facts, not code.

Product prefixes, bucket edges, accepted values, limits, masks and synonyms
must equal the values the lending data uses, so they are listed here once.
"""

# Loan product line by case-insensitive prefix of the product type, in order.
PRODUCT_PREFIXES = (("Tunaiku", "Tunaiku"), ("SMB", "SMB"))
PRODUCT_OTHER = "Other"

# Days-past-due buckets: (upper edge, label), in order; beyond the last edge
# (and for a missing value) the final label applies.
DPD_EDGES = ((30, "DPD_1_30"), (60, "DPD_31_60"), (90, "DPD_61_90"))
DPD_CURRENT = "CURRENT"
DPD_LAST = "DPD_90_PLUS"
DPD_LABELS = ("CURRENT", "DPD_1_30", "DPD_31_60", "DPD_61_90", "DPD_90_PLUS")

# Accepted values.
CUSTOMER_SEGMENTS = ("Tunaiku", "Senyumku", "SMB")
ACCOUNT_TYPES = ("TABUNGAN", "DEPOSITO")
DEFAULT_FLAGS = (0, 1)

# Limits of the quality gate and the freshness check.
SCORE_MIN, SCORE_MAX = 300, 850
NIK_LENGTH, NIK_PATTERN = 16, "^[0-9]+$"
WARN_HOURS, ERROR_HOURS = 24, 48

# Tokens in landed text files that mean "no value".
NULL_TOKENS = ("", "NULL", "null")

# Masks.
NIK_HIDDEN = "XXXXXXXXXXXXXXXX"
NIK_KEEP_LAST = 4
EMAIL_LOCAL_PART = "^[^@]+"
EMAIL_HIDDEN = "****"
PHONE_KEEP_FIRST = 4
PHONE_HIDDEN = "XXXXXX"
OPEN_PROVINCE = "DKI Jakarta"

# Tag keys with their allowed values.
TAG_VALUES = {
    "pii_type": ("NIK", "NPWP", "NAME", "PHONE", "EMAIL", "INCOME", "NONE"),
    "data_classification": ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"),
}

# Business words for tables and dimensions of the loan portfolio.
TABLE_SYNONYMS = {
    "loans": ("pinjaman", "kredit"),
    "customers": ("nasabah", "customer"),
}
DIMENSION_SYNONYMS = {
    "product_segment": ("produk", "segmen produk"),
    "dpd_bucket": ("bucket dpd", "tunggakan"),
    "province": ("provinsi", "wilayah"),
    "segment": ("segmen nasabah",),
    "city": ("kota",),
}

# Okapi BM25 parameters.
BM25_K1, BM25_B = 1.2, 0.75

# Numeric features of the default model and its label.
FEATURES = (
    "credit_score",
    "monthly_income",
    "age",
    "n_loans",
    "total_outstanding",
    "total_savings_balance",
    "n_transactions",
)
LABEL = "ever_default"
