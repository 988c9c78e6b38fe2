"""Parameters and fixed values.

Everything here is data: the species pairs, the district -> macro-region map,
the common-name aliases, thresholds and the fixed wording of decisions and
reports. Operators take these as arguments with these values as defaults.
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------

# Species pairs: (invasive, native look-alike, pair confidence)
SPECIES_PAIRS = [
    ("Arundo donax", "Phragmites australis", "high"),
    ("Cortaderia selloana", "Ammophila arenaria", "medium"),
    ("Acacia dealbata", "Acacia longifolia", "medium"),
]

# District -> macro-region (last fallback of the spatial blocking)
MACRO_REGION_MAP = [
    ("Lisboa", "Centro-Litoral"),
    ("Setúbal", "Centro-Litoral"),
    ("Aveiro", "Centro-Litoral"),
    ("Coimbra", "Centro-Litoral"),
    ("Porto", "Norte-Litoral"),
    ("Braga", "Norte-Litoral"),
    ("Bragança", "Norte-Litoral"),
    ("Faro", "Sul"),
    ("Beja", "Sul"),
    ("Évora", "Sul"),
    ("Madeira", "Ilhas"),
    ("Açores", "Ilhas"),
]

# Common-name aliases: scientific name -> names that mean it
SPECIES_ALIASES = [
    ("Acacia dealbata", ["silver wattle", "mimosa", "acacia dealbata"]),
    ("Acacia longifolia", ["longleaf wattle", "acacia longifolia"]),
    ("Ammophila arenaria", ["marram grass", "beach grass", "ammophila arenaria"]),
    ("Arundo donax", ["giant reed", "arundo", "arundo donax"]),
    ("Cortaderia selloana", ["pampas grass", "cortaderia", "cortaderia selloana"]),
    ("Phragmites australis", ["common reed", "reed", "phragmites australis"]),
]

# Manifest source files, in merge order
MANIFEST_SOURCES = [
    "invasoras_manifest.csv",
    "floralens_manifest.csv",
    "gbif_dl_manifest.csv",
    "external_manifest.csv",
    "synthetic_manifest.csv",
]

# Image extensions kept by folder scans (compared in lower case)
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp"]

# Survey folder glob
SURVEY_GLOB = "*.{jpg,JPG,png,PNG}"

# Risk levels and actions (LOW and two actions are declared but never produced)
RISK_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "NATIVE"]
ACTIONS = [
    "Immediate removal",
    "Herbicide treatment",
    "Mechanical removal",
    "Containment measures",
    "Monitoring",
    "No action",
]

# Decision branches: follow-up actions per branch
FOLLOW_UPS_ABSTAIN = [
    "Manual photo review recommended",
    "Collect multiple angle shots",
    "Document GPS location precisely",
    "Re-photograph in different lighting",
]
FOLLOW_UPS_NATIVE = ["Document sighting for biodiversity records"]
FOLLOW_UPS_CRITICAL = [
    "Schedule immediate removal assessment",
    "Check for ecological damage indicators",
    "Document population size and extent",
    "Notify local environmental authorities",
    "Plan management strategy",
]
FOLLOW_UPS_HIGH = [
    "Initiate containment protocol",
    "Schedule removal within 30 days",
    "Mark area for monitoring",
    "Check for spread to adjacent areas",
    "Plan multi-year management if extensive",
]
FOLLOW_UPS_POSSIBLE = [
    "Schedule field verification",
    "Collect reference samples",
    "Document location and habitat",
]

# Reasoning templates ({pct} is the one-decimal percent text)
REASON_ABSTAIN = "Low confidence detection ({pct}). Requires field verification."
REASON_NATIVE = "Native or non-target species detected ({pct} confidence)."
REASON_CRITICAL = "High-confidence invasive species detection ({pct})."
REASON_HIGH = "Confirmed invasive species detection ({pct})."
REASON_POSSIBLE = "Possible invasive species ({pct}). Requires verification."

# Report wording
REPORT_RULE = "=" * 70
REPORT_TITLE = "INVASIVE SPECIES ASSESSMENT REPORT"
REPORT_CRITICAL_HEADER = "CRITICAL FINDINGS (IMMEDIATE ACTION REQUIRED):"
REPORT_HIGH_HEADER = "HIGH PRIORITY FINDINGS:"
REPORT_ACTIONS_HEADER = "RECOMMENDED ACTIONS:"
REPORT_BULLET = "•"

# Audit issue wording ({n}, {pct})
ISSUE_MISSING_FILES = "{n} manifest paths do not exist on disk."
ISSUE_DUP_PATHS = "{n} duplicate filepath rows found."
ISSUE_DUP_KEYS = "{n} duplicate source/gbif_id rows found."
ISSUE_NO_COORDS = "{pct} of rows lack latitude/longitude."
ISSUE_BIG_GROUP = "Largest validation group holds {pct} of rows."
ISSUE_SMALL_CLASS = "Smallest class has only {n} images."

# McNemar interpretation
MCNEMAR_SIGNIFICANT = "Models differ significantly (p < 0.05)."
MCNEMAR_NOT_SIGNIFICANT = "No statistically significant difference detected (p >= 0.05)."

# Synthetic fixture: district (centre latitude, centre longitude, jitter) in
# choice order, and the choice weights in the same order
SYNTHETIC_DISTRICTS = [
    ("Lisboa", 38.72, -9.14, 0.35),
    ("Porto", 41.15, -8.61, 0.30),
    ("Setúbal", 38.52, -8.89, 0.08),
    ("Faro", 37.02, -7.93, 0.08),
    ("Braga", 41.55, -8.42, 0.08),
    ("Madeira", 32.65, -16.90, 0.05),
]
SYNTHETIC_DISTRICT_WEIGHTS = [0.45, 0.25, 0.10, 0.08, 0.07, 0.05]

# Hyper-parameter grid
HYPERPARAMETER_GRID = {
    "learning_rate": [1e-5, 1e-4, 1e-3],
    "batch_size": [16, 32, 64],
    "dropout": [0.2, 0.3, 0.5],
}

# ---------------------------------------------------------------------------
# Thresholds
# ---------------------------------------------------------------------------
GRID_CELL_SIZE_DEG = 0.2
MIN_GRID_SIZE = 15
MIN_DISTRICT_SIZE = 30
N_FOLDS = 5
COMPARISON_FOLD = 0
SEED = 42
DECISION_THRESHOLD = 0.7
CRITICAL_THRESHOLD = 0.9
PREDICTOR_THRESHOLD = 0.5
AUDIT_NO_COORDS_RATIO = 0.25
AUDIT_LARGEST_GROUP_SHARE = 0.30
AUDIT_SMALLEST_CLASS = 100
MIN_IMAGE_BYTES = 1024
RETRY_INITIAL = 1.0
RETRY_FACTOR = 2.0
RETRY_MAX_DELAY = 60.0
RETRY_MAX_ATTEMPTS = 5
