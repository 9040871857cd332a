"""Configuration: thresholds, rule texts, code tables and key mode.

Everything an operator needs to decide *what* to compute lives here, so the
operators themselves stay plain DataFrame -> DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the behaviour being reproduced (rule texts,
# band edges, labels, code lists, regex patterns). They are stated here once,
# in their natural order, and referenced everywhere else by name.
# ---------------------------------------------------------------------------

# Quality rules applied before the silver layer (drop mode; NULL fails).
QUALITY_RULES: dict[str, str] = {
    "valid_primary_key": "dr_no IS NOT NULL",
    "valid_date_logic": "date_rptd >= date_occ OR date_rptd IS NULL OR date_occ IS NULL",
    "valid_date_range": "date_occ >= '2020-01-01'",
}

# Silver age groups on the cleaned age: (exclusive upper bound, label).
AGE_UNKNOWN = "Unknown"
SILVER_AGE_BANDS: list[tuple[int, str]] = [
    (18, "0-17 (Juvenile)"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
]
SILVER_AGE_TOP = "65+ (Senior)"

# Profiling age bands on the raw age (0 is Unknown, < 120 is the last band,
# anything else including NULL is Invalid).
RAW_AGE_BANDS: list[tuple[int, str]] = [
    (18, "0-17 (Juvenile)"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
    (120, "65+ (Senior)"),
]
RAW_AGE_INVALID = "Invalid"

# Time of day: (first hour, exclusive end hour, label); anything else is Evening.
TIME_PERIODS: list[tuple[int, int, str]] = [
    (0, 6, "Night"),
    (6, 12, "Morning"),
    (12, 18, "Afternoon"),
]
TIME_PERIOD_OTHER = "Evening"

# Detailed time bands of the time dimension.
TIME_PERIOD_DETAIL: list[tuple[int, int, str]] = [
    (0, 1, "Midnight (12-1AM)"),
    (1, 6, "Early Morning (1-6AM)"),
    (6, 9, "Morning Rush (6-9AM)"),
    (9, 12, "Late Morning (9-12PM)"),
    (12, 13, "Noon (12-1PM)"),
    (13, 17, "Afternoon (1-5PM)"),
    (17, 20, "Evening Rush (5-8PM)"),
    (20, 24, "Late Evening (8-12AM)"),
]
TIME_PERIOD_DETAIL_OTHER = "Unknown"
MORNING_PEAK_HOURS = [6, 7, 8]
EVENING_PEAK_HOURS = [17, 18, 19]
BUSINESS_CATEGORY_HOURS = (9, 16)   # "Business Hours" category, inclusive
BUSINESS_FLAG_HOURS = (9, 17)       # is_business_hours flag, inclusive

# Arrest statuses.
ARREST_STATUSES = ["AA", "JA"]

# Geographic regions by area number, first match wins; others are "Other".
REGIONS: list[tuple[str, list[int]]] = [
    ("Central", [1, 2, 4, 13]),
    ("West", [6, 7, 20]),
    ("Valley", [9, 10, 15, 17, 21]),
    ("South", [3, 8, 12, 18]),
]
REGION_OTHER = "Other"
VALID_AREAS = list(range(1, 22))

# Premise categories: ordered case-insensitive patterns, first match wins.
PREMISE_CATEGORIES: list[tuple[str, str]] = [
    ("DWELLING|HOUSE|APARTMENT|RESIDENCE", "Residential"),
    ("STREET|SIDEWALK|ALLEY|PARKING", "Street"),
    ("STORE|RESTAURANT|BANK|MARKET", "Commercial"),
    ("VEHICLE|CAR", "Vehicle"),
]
PREMISE_OTHER = "Other"

# Weapon categories (opt-in): ordered patterns; NULL code is "None".
WEAPON_CATEGORIES: list[tuple[str, str]] = [
    ("HAND GUN|SEMI-AUTO|REVOLVER|RIFLE|SHOTGUN", "Firearm"),
    ("KNIFE|CUTTING", "Knife"),
    ("CLUB|PIPE|ROCK|BOTTLE", "Blunt"),
    ("STRONG-ARM|HANDS|FEET", "Body"),
]
WEAPON_OTHER = "Other"
WEAPON_NONE = "None"

# Crime categories (opt-in): ordered patterns.
CRIME_CATEGORIES: list[tuple[str, str]] = [
    ("ASSAULT|BATTERY|HOMICIDE|RAPE|ROBBERY", "Violent"),
    ("THEFT|BURGLARY|VANDALISM|STOLEN", "Property"),
    ("DRUG|NARCOTIC", "Drug"),
]
CRIME_OTHER = "Other"

# Weapon dimension member for "no weapon".
NO_WEAPON_KEY = -1
NO_WEAPON_CODE = -1.0
NO_WEAPON_DESC = "No Weapon"

# Victim sex labels used by the demographics dimension.
SEX_LABELS: dict[str, str] = {
    "M": "Male",
    "F": "Female",
    "X": "Unknown",
    "H": "Non-binary",
}
# Victim descent labels used by the demographics dimension (13 codes).
DESCENT_LABELS: dict[str, str] = {
    "H": "Hispanic/Latin/Mexican",
    "W": "White",
    "B": "Black",
    "A": "Other Asian",
    "O": "Other",
    "X": "Unknown",
    "C": "Chinese",
    "K": "Korean",
    "F": "Filipino",
    "J": "Japanese",
    "V": "Vietnamese",
    "I": "American Indian/Alaskan Native",
    "Z": "Asian Indian",
}
LABEL_UNKNOWN = "Unknown"

# Descent codes known to profiling (20 codes).
PROFILE_DESCENT_CODES: dict[str, str] = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
    "-": "Unknown",
}
# Sex codes expected by profiling (NULL is also expected).
PROFILE_SEX_CODES = ["F", "M", "X", "H", "-"]

# Completeness grades: (minimum %, grade); below the last is "D (Poor)".
COMPLETENESS_GRADES: list[tuple[float, str]] = [
    (95.0, "A (Excellent)"),
    (85.0, "B (Good)"),
    (75.0, "C (Fair)"),
]
COMPLETENESS_GRADE_LAST = "D (Poor)"

# Cardinality classes: (ratio % strictly above, class); else the last.
CARDINALITY_CLASSES: list[tuple[float, str]] = [
    (90.0, "Very High (Identifier)"),
    (50.0, "High"),
    (10.0, "Medium-High"),
    (1.0, "Medium"),
]
CARDINALITY_CLASS_LAST = "Low (Good Dimension)"

# Surrogate key moduli.
MOD_SMALL = 1_000_000
MOD_LARGE = 10_000_000

# Audit producer names.
FLOW_BRONZE = "incidents_bronze_ingest_flow"
FLOW_SILVER = "incidents_silver_transformation_flow"
FLOW_FACT = "fact_crime_incidents_flow"

# Table names.
BRONZE = "incidents_bronze"
SILVER = "incidents_silver"
QUARANTINE = "incidents_quarantine"
FACT = "fact_crime_incidents"

# ---------------------------------------------------------------------------
# Tunables (not fixed values; safe to change per deployment).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Per-run knobs. Immutable; derive variants with :meth:`with_`."""

    # Surrogate-key function: "xxhash64" (63 bits, cheapest per row), "md5"
    # (60 bits, checkable in any SQL engine) or "parity" (abs(Murmur3 hash) % M,
    # as the original notebooks compute it).
    key_mode: str = "xxhash64"
    # Reduce dimension keys modulo 1e6 / 1e7 as the original notebooks do.
    # Off by default: full-width keys make collisions (which would fan out
    # star joins) negligible. "parity" mode always applies the moduli.
    key_modulus: bool = False
    date_start: str = "2019-01-01"
    date_end: str = "2029-12-31"
    fiscal_start_month: int = 10
    lat_bounds: tuple[float, float] = (33.7, 34.3)
    lon_bounds: tuple[float, float] = (-118.7, -118.1)
    max_age: int = 120
    # Reference date for "future date" checks (None -> current_date()).
    as_of: str | None = None
    # A side is broadcast only if it is known to have at most this many rows
    # and the planner's estimate of its size is at most this many bytes; a side
    # of unknown size is joined without a hint (AQE decides by the size it
    # finds and splits skewed partitions).
    broadcast_max_rows: int = 500_000
    broadcast_max_bytes: int = 64 << 20
    # Keys known to hold a large share of all rows, by star role. In a join
    # without broadcast their rows are dealt over the shuffle partitions by a
    # hash of the row, and only their dimension rows are repeated.
    hot_keys: dict[str, tuple] = field(default_factory=lambda: {"weapon": (NO_WEAPON_CODE,)})
    # Grid step in degrees for the density mart.
    grid_step: float = 0.05
    # Exact (count_distinct) or approximate (HLL++) cardinality profile, for
    # all columns or only the listed ones (e.g. identifiers such as dr_no).
    approx_distinct: bool = False
    approx_distinct_columns: tuple[str, ...] = ()
    # Exact (percentile) or approximate (percentile_approx) quantiles.
    approx_percentile: bool = False
    # Extra opt-in columns.
    weapon_category: bool = False
    crime_category: bool = False
    rules: dict[str, str] = field(default_factory=lambda: dict(QUALITY_RULES))

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)

    def modulus(self, m: int) -> int | None:
        """The modulus for a dimension key, or None for a full-width key."""
        return m if (self.key_modulus or self.key_mode == "parity") else None


DEFAULT = Config()
