"""Fixed values.

Everything in this file must equal the published behaviour for results to
agree: detection and masking patterns, keyword lists, weights, type names and
output texts.  They are stated in plain Python-regex form and natural order;
``functions/dialect.py`` turns the patterns into what the JVM needs.
"""

# --- fixed values: defaults -------------------------------------------------
WINDOW = 50
MASK = "***"

# --- fixed values: detection patterns (order = precedence), (regex, flags) ---
DETECTION_PATTERNS = {
    "email": (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "i"),
    "phone": (
        r"(?:\+?1[-.\s]?)?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})"
        r"|(?:\+?[0-9]{1,3}[-.\s]?)?\(?([0-9]{2,4})\)?[-.\s]?([0-9]{2,4})[-.\s]?([0-9]{2,4})",
        "i",
    ),
    "ssn": (r"\b(?!000|666|9\d{2})\d{3}[-.\s]?(?!00)\d{2}[-.\s]?(?!0000)\d{4}\b", ""),
    "credit_card": (
        r"\b(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|3[0-9]{13}"
        r"|6(?:011|5[0-9]{2})[0-9]{12})\b",
        "",
    ),
    "ip_address": (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", ""),
    "zip_code": (r"\b\d{5}(?:-\d{4})?\b", ""),
    "date_of_birth": (
        r"\b(?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12][0-9]|3[01])[-/](?:19|20)\d{2}\b",
        "",
    ),
    "name": (r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", ""),
}

# Same types, but the narrow digit formats win over the broad phone pattern.
SPECIFIC_ORDER = [
    "email", "ssn", "credit_card", "date_of_birth", "zip_code", "phone", "ip_address", "name",
]

# --- fixed values: masking patterns, in the order they are applied -----------
MASK_PATTERNS = {
    "ssn": DETECTION_PATTERNS["ssn"],
    "credit_card": (
        DETECTION_PATTERNS["credit_card"][0] + r"|\b(?:[0-9]{4}[-.\s]?){3}[0-9]{4}\b",
        "",
    ),
    "phone": (DETECTION_PATTERNS["phone"][0], ""),
    "email": (DETECTION_PATTERNS["email"][0], ""),
    "ip_address": DETECTION_PATTERNS["ip_address"],
    "date_of_birth": DETECTION_PATTERNS["date_of_birth"],
    "zip_code": DETECTION_PATTERNS["zip_code"],
}

# --- fixed values: provenance --------------------------------------------------
MODEL_LABELS = ["PERSON", "ORG", "GPE", "LOC"]
LABEL_TYPES = {"PERSON": "name", "ORG": "organization", "GPE": "location", "LOC": "location"}
# Types of our own that the pair rules know but no pattern gives; a dictionary or a
# model brings them under these labels.
OWN_LABELS = {"ADDRESS": "address", "ZIP": "zip", "EMPLOYER": "org"}
MODEL_CONFIDENCE = 0.9
REGEX_CONFIDENCE = 0.8
PATTERN_CONFIDENCE = 0.7
CONTEXT_CONFIDENCE = 0.6
MODEL_METHOD = "model_ner"
TERM_METHOD = "gazetteer"
REGEX_METHOD = "regex"
PATTERN_METHOD = "proximity_inference"
CONTEXT_METHOD = "context_inference"

# --- fixed values: combination patterns over a row's text ----------------------
NAME_PART = r"[A-Z][a-z]+ [A-Z][a-z]+"
SSN_TAIL = r"\d{3}[-.\s]?\d{2}[-.\s]?\d{4}"
PHONE_TAIL = r"(\+?1[-.\s]?)?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})"
ORG_SUFFIX = r"(?:Corp|Corporation|Inc|LLC|Ltd|Company)"
ZIP_PART = r"\d{5}(?:-\d{4})?"

COMBINATION_PATTERNS = {
    "name_with_ssn": f"({NAME_PART}).*?({SSN_TAIL})",
    "name_with_phone": f"({NAME_PART}).*?{PHONE_TAIL}",
    "address_with_name": rf"(\d+\s+[A-Za-z\s]+(?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard|Dr|Drive)).*?({NAME_PART})",
    "zip_with_org": rf"({ZIP_PART}).*?([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+{ORG_SUFFIX})",
}
COMBINATION_TYPES = {
    "name_with_ssn": "name_ssn_combination",
    "name_with_phone": "name_phone_combination",
    "address_with_name": "address_name_combination",
    "zip_with_org": "zip_org_combination",
}
COMBINATION_DEFAULT_TYPE = "inferred_combination"

# --- fixed values: context keywords ---------------------------------------------
CONTEXT_KEYWORDS = {
    "personal_identifiers": [
        "ssn", "social security", "tax id", "employee id", "member id",
        "customer id", "client id", "user id", "account number",
    ],
    "contact_info": [
        "phone", "mobile", "cell", "home", "work", "office",
        "email", "address", "residence", "mailing",
    ],
    "financial": [
        "credit card", "debit card", "bank account", "routing number",
        "account balance", "payment", "billing",
    ],
    "medical": [
        "patient", "medical record", "diagnosis", "treatment",
        "prescription", "doctor", "physician", "hospital",
    ],
    "employment": [
        "salary", "wage", "income", "employer", "job title",
        "department", "manager", "supervisor",
    ],
}

# --- fixed values: risk rules ------------------------------------------------------
HIGH_RISK_PAIRS = [
    ("name", "ssn"), ("name", "phone"), ("name", "email"),
    ("address", "name"), ("zip", "org"), ("name", "credit_card"),
]
BOOSTED_PAIRS = [
    ("name", "ssn"), ("name", "phone"), ("name", "email"), ("address", "name"), ("zip", "org"),
]
BOOST = 1.5
RISK_WEIGHTS = {
    "ssn": 1.0, "credit_card": 0.9, "name": 0.8, "phone": 0.7, "email": 0.6,
    "address": 0.5, "zip": 0.4, "organization": 0.3, "location": 0.2,
}
DEFAULT_WEIGHT = 0.1
HIGH_VALUE_TYPES = ["ssn", "credit_card", "name"]
TOP_CENTRAL = 5
MAX_GRAPH_NODES = 50

# --- fixed values: missing-value and boolean tokens of the CSV dialect ---------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
BOOL_TOKENS = ["True", "TRUE", "true", "False", "FALSE", "false"]

# --- fixed values: report texts --------------------------------------------------------
FOUND_ENTITIES = "Found %d PII entities. Consider implementing data minimization practices."
FOUND_HIGH_ROWS = (
    "Identified %d high-risk rows with multiple PII types in proximity. "
    "These pose significant re-identification risks."
)
FOUND_HIGH_REID = (
    "High re-identification risk detected due to entity clustering. "
    "Consider data anonymization or pseudonymization techniques."
)
GENERAL_ADVICE = [
    "Implement access controls and audit logging for PII data.",
    "Consider using differential privacy techniques for sensitive datasets.",
    "Regular PII audits should be conducted to maintain compliance.",
]
EMPTY_GRAPH = "No entities found in graph"
RISK_BADGES = {"low": "badge-success", "medium": "badge-warning", "high": "badge-danger"}
DEFAULT_BADGE = "badge-info"
