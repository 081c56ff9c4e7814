"""Table families, their contracts, and the fixed values of the pipeline."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import PurePath

from pyspark.sql import types as T


@dataclass(frozen=True)
class Family:
    """One table family: how its files are recognised and which columns it must have (normalized names)."""

    name: str
    tokens: tuple[str, ...]
    required: tuple[str, ...]
    key: tuple[str, ...]
    dates: tuple[str, ...]


# The published file names and columns of the four source tables.
FAMILIES = {
    f.name: f
    for f in (
        Family("master", ("mdrfoi",), ("mdr_report_key", "date_received", "event_type"), ("mdr_report_key",), ("date_received", "date_report", "date_of_event")),
        Family("device", ("device", "foidev"), ("mdr_report_key", "device_sequence_no", "device_report_product_code"), ("mdr_report_key", "device_sequence_no"), ("date_received", "date_returned_to_manufacturer")),
        Family("patient", ("patient",), ("mdr_report_key", "patient_sequence_number"), ("mdr_report_key", "patient_sequence_number"), ("date_received",)),
        Family("narrative", ("foitext",), ("mdr_report_key", "mdr_text_key", "text_type_code", "foi_text"), ("mdr_text_key",), ("date_report",)),
    )
}
BRAND_COLUMNS = ("brand_name", "brand_name_1", "device_brand_name")
MANUFACTURER_COLUMNS = ("manufacturer_d_name", "manufacturer_name", "manufacturer_g1_name", "manufacturer_g2_name")
PROVENANCE = ("_source_line_number", "_source_snapshot_sha256", "_source_filename", "_source_role")
ROLES = {"base": 0, "add": 1, "change": 2}
OUTCOMES = {"DEATH": "death", "INJURY": "injury", "MALFUNCTION": "malfunction", "OTHER": "other", "": "missing"}
UNRECOGNIZED = "unrecognized"
VIEWS = {"reports": ("master", "reports"), "devices": ("device", "devices"), "patients": ("patient", "patients"), "narratives": ("narrative", "narratives")}

TRAIN_UNTIL, VALIDATION_UNTIL = "2024-12-31", "2025-12-31"
RECENT_MONTHS, BASELINE_MONTHS, Z_FLAG, EXTRA_FLAG, MAD_FACTOR, SCALE_FLOOR = 3, 12, 3.0, 5.0, 1.4826, 1.0
REJECTS_LIMIT, ORPHANS_LIMIT, DRIFT_LIMIT, TRUNCATION_LIMIT = 0.005, 0.01, 0.9, 0.9

NARRATIVE = T.StructType([T.StructField(n, T.StringType()) for n in ("report_id", "dataset_snapshot_id", "evidence_id", "text_type_code", "source_filename", "source_line_number", "source_text_sha256", "modeling_text", "cleaning_version")])
DOCUMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("report_id", "dataset_snapshot_id", "reported_event_type")]
    + [T.StructField("date_received", T.DateType())]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("product_codes", "brand_names", "manufacturers")]
    + [T.StructField("narratives", T.ArrayType(NARRATIVE)), T.StructField("modeling_text", T.StringType()), T.StructField("cleaning_version", T.StringType())]
)


def normalize_column(name: str) -> str:
    """Lower case; every run of other characters than a-z and 0-9 becomes one underscore, none at the ends."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def normalized(names: list[str]) -> list[str]:
    """Normalized names of a header; two that become one are an error."""
    made = [normalize_column(n) if not n.startswith("_source_") else n for n in names]
    twice = sorted({n for n in made if made.count(n) > 1})
    if twice or "" in made:
        raise ValueError(f"column names collide after normalization: {', '.join(twice) or 'an empty name'}")
    return made


def detect_family(filename: str, columns: list[str]) -> Family:
    """The one family whose token is in the file's name and whose required columns are in the header."""
    base = PurePath(filename).name.lower()
    found = [f for f in FAMILIES.values() if any(t in base for t in f.tokens)]
    if len(found) != 1:
        raise ValueError(f"{filename}: matches {len(found)} table families")
    missing = sorted(set(found[0].required) - {normalize_column(c) for c in columns})
    if missing:
        raise ValueError(f"{filename}: missing columns {', '.join(missing)}")
    return found[0]


def detect_role(filename: str) -> str:
    """change or add by the end of the file's stem, else base."""
    stem = PurePath(filename).stem.casefold()
    return "change" if stem.endswith("change") else "add" if stem.endswith("add") else "base"


def first_present(candidates: tuple[str, ...], columns: list[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def require(columns: list[str], needed: tuple[str, ...], what: str) -> None:
    missing = sorted(set(needed) - set(columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {', '.join(missing)}")


_IDENTIFIER = re.compile(r"[a-zA-Z0-9._-]+")


def valid_identifier(value: str) -> bool:
    return bool(_IDENTIFIER.fullmatch(value)) and value not in {".", ".."}
