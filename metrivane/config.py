"""Settings as frozen dataclasses, loadable from YAML.

The defaults are the published defaults of the evaluation track; a live
(unlabelled) track passes its own dimensions, thresholds and model groups.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

import yaml

LOWER = "lower_is_bad"
HIGHER = "higher_is_bad"
SEVERITIES = ("NORMAL", "WARNING", "CRITICAL")

# The default dimension set of the evaluation track.
DIMENSIONS = ("kpi_name", "region", "device_type", "browser", "channel", "business_segment")
LIVE_DIMENSIONS = ("kpi_name", "project", "access", "agent")

# Fixed values: (label, columns) pairs analysed for contribution.
DIMENSION_SPECS = (
    ("region", ("region",)),
    ("device_type", ("device_type",)),
    ("browser", ("browser",)),
    ("channel", ("channel",)),
    ("business_segment", ("business_segment",)),
    ("region_device_browser", ("region", "device_type", "browser")),
    ("full_segment", ("region", "device_type", "browser", "channel", "business_segment")),
)
LIVE_DIMENSION_SPECS = (
    ("project", ("project",)),
    ("access", ("access",)),
    ("agent", ("agent",)),
    ("project_access", ("project", "access")),
    ("full_segment", ("project", "access", "agent")),
)
INTERACTION_TYPES = ("region_device_browser", "full_segment")

# Which severity column belongs to which detector flag.
DETECTOR_SEVERITY = {
    "residual_anomaly": "residual_severity",
    "zscore_anomaly": "zscore_severity",
    "combined_anomaly": "combined_severity",
    "threshold_breached": "monitoring_status",
}

# Label columns carried next to the measures.
LABEL_COLUMNS = ("is_incident", "incident_id", "incident_type", "incident_description")


@dataclass(frozen=True)
class Threshold:
    warning: float
    critical: float
    direction: str = LOWER


# Per-KPI thresholds (relative variance from the baseline).
DEFAULT_THRESHOLDS = {
    "conversion_rate": Threshold(0.08, 0.16, LOWER),
    "click_through_rate": Threshold(0.06, 0.10, LOWER),
    "average_order_value": Threshold(0.08, 0.12, LOWER),
    "latency_ms": Threshold(0.15, 0.30, HIGHER),
    "revenue_per_session": Threshold(0.18, 0.30, LOWER),
}
FALLBACK_THRESHOLD = Threshold(0.05, 0.10, LOWER)
LIVE_THRESHOLDS = {"pageviews": Threshold(0.15, 0.30, LOWER)}


@dataclass(frozen=True)
class DetectorConfig:
    """Z-score, residual-model and residual-threshold settings (fixed default values)."""

    z_warning: float = 3.0
    z_critical: float = 4.0
    window: int = 28
    min_periods: int = 7
    residual_mode: str = "relative_pct"  # or "robust_mad"
    residual_warning: float = 0.20
    residual_critical: float = 0.40
    mad_warning: float = 3.5
    mad_critical: float = 5.0
    group_columns: tuple[str, ...] = ("kpi_name",)
    train_fraction: float = 0.70
    min_train_rows: int = 8
    ridge_alpha: float = 1.0
    model: str = "ridge"  # or "gbt"
    trees: int = 80
    depth: int = 3
    learning_rate: float = 0.08
    subsample: float = 0.9
    colsample: float = 0.9
    seed: int = 42


@dataclass(frozen=True)
class RcaConfig:
    detector: str = "residual_anomaly"
    allowed: tuple[str, ...] = tuple(DETECTOR_SEVERITY)
    specs: tuple[tuple[str, tuple[str, ...]], ...] = DIMENSION_SPECS
    interaction_types: tuple[str, ...] = INTERACTION_TYPES
    max_top: int = 10
    min_share: float = 0.05


@dataclass(frozen=True)
class IncidentConfig:
    """Severity bands, confidence weights and list lengths (fixed default values)."""

    detector: str = "residual_anomaly"
    max_incidents: int = 12
    max_causes: int = 3
    max_actions: int = 3
    support_saturation: float = 10.0
    warning_variance: float = 0.15
    critical_variance: float = 0.30
    critical_share: float = 0.60
    weight_model: float = 0.30
    weight_share: float = 0.30
    weight_quality: float = 0.20
    weight_support: float = 0.10
    weight_severity: float = 0.10
    interaction_types: tuple[str, ...] = INTERACTION_TYPES


@dataclass(frozen=True)
class Settings:
    dimensions: tuple[str, ...] = DIMENSIONS
    thresholds: dict[str, Threshold] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    detector: DetectorConfig = DetectorConfig()
    rca: RcaConfig = RcaConfig()
    incident: IncidentConfig = IncidentConfig()
    # Calendar days per independently computed block of a series; None: whole series.
    block_days: int | None = None

    def __post_init__(self):
        check_dimensions(self.dimensions)

    @property
    def directions(self) -> dict[str, str]:
        return {kpi: t.direction for kpi, t in self.thresholds.items()}


def check_dimensions(dimensions) -> list[str]:
    dims = list(dimensions)
    if not dims or dims[0] != "kpi_name":
        raise ValueError("dimensions must start with 'kpi_name'")
    return dims


def live_settings() -> Settings:
    """The operations track: series-level models, robust thresholding, no labels."""
    return Settings(
        dimensions=LIVE_DIMENSIONS,
        thresholds=dict(LIVE_THRESHOLDS),
        detector=DetectorConfig(residual_mode="robust_mad", group_columns=LIVE_DIMENSIONS),
        rca=RcaConfig(specs=LIVE_DIMENSION_SPECS),
    )


# YAML key -> dataclass field.  Keys not listed in a strict section are rejected,
# so a misspelt severity band cannot be ignored silently.
_DETECTOR_KEYS = {
    "z_score_warning_threshold": "z_warning",
    "z_score_critical_threshold": "z_critical",
    "rolling_window": "window",
    "min_periods": "min_periods",
    "residual_threshold_mode": "residual_mode",
    "residual_warning_threshold_pct": "residual_warning",
    "residual_critical_threshold_pct": "residual_critical",
    "residual_mad_warning_z": "mad_warning",
    "residual_mad_critical_z": "mad_critical",
    "model_group_columns": "group_columns",
}
_MODEL_KEYS = {
    "train_fraction": "train_fraction",
    "min_train_rows": "min_train_rows",
    "ridge_alpha": "ridge_alpha",
    "n_estimators": "trees",
    "max_depth": "depth",
    "learning_rate": "learning_rate",
    "subsample": "subsample",
    "colsample_bytree": "colsample",
    "random_state": "seed",
}
_RCA_KEYS = {
    "default_detector": "detector",
    "allowed_detectors": "allowed",
    "max_top_contributors": "max_top",
    "minimum_contribution_share": "min_share",
}
_INCIDENT_KEYS = {
    "default_detector": "detector",
    "max_incidents": "max_incidents",
    "max_root_causes_per_incident": "max_causes",
    "max_actions_per_incident": "max_actions",
    "support_saturation_count": "support_saturation",
}
_SEVERITY_KEYS = {
    "warning_percent_variance": "warning_variance",
    "critical_percent_variance": "critical_variance",
    "critical_contribution_share": "critical_share",
    # the shorter spelling of the live track is read, not ignored
    "warning": "warning_variance",
    "critical": "critical_variance",
}
_WEIGHT_KEYS = {
    "model_f1": "weight_model",
    "rca_concentration": "weight_share",
    "data_quality": "weight_quality",
    "anomaly_support": "weight_support",
    "severity": "weight_severity",
}
# What an absent key means in a YAML file (differs from the shipped defaults).
_ABSENT_DETECTOR = dict(z_warning=2.0, z_critical=3.0, residual_warning=0.12, residual_critical=0.25)


def _pick(section: dict, keys: dict[str, str], strict: str | None = None) -> dict:
    if strict:
        unknown = sorted(set(section) - set(keys))
        if unknown:
            raise ValueError(f"Unknown keys in {strict}: {unknown}")
    picked = {keys[k]: v for k, v in section.items() if k in keys}
    return {k: tuple(v) if isinstance(v, list) else v for k, v in picked.items()}


def load_settings(path: str | Path, dimensions=DIMENSIONS, specs=DIMENSION_SPECS) -> Settings:
    """Read a monitoring YAML file into ``Settings``."""
    raw = yaml.safe_load(Path(path).read_text()) or {}
    thresholds = {
        kpi: Threshold(
            float(t["warning_threshold_pct"]), float(t["critical_threshold_pct"]), t.get("direction", LOWER)
        )
        for kpi, t in raw.get("kpi_monitoring", {}).get("thresholds", {}).items()
    }
    section = raw.get("anomaly_detection", {})
    detector = replace(
        DetectorConfig(**_ABSENT_DETECTOR),
        **_pick(section, _DETECTOR_KEYS),
        **_pick(section.get("model", {}), _MODEL_KEYS),
    )
    rca = replace(
        RcaConfig(specs=tuple((n, tuple(c)) for n, c in specs)),
        **_pick(raw.get("root_cause_analysis", {}), _RCA_KEYS),
    )
    section = raw.get("incident_reporting", {})
    incident = replace(
        IncidentConfig(),
        **_pick(section, _INCIDENT_KEYS),
        **_pick(section.get("severity_thresholds", {}), _SEVERITY_KEYS, "severity_thresholds"),
        **_pick(section.get("confidence_weights", {}), _WEIGHT_KEYS, "confidence_weights"),
    )
    return Settings(tuple(dimensions), thresholds, detector, rca, incident)


# ---------------------------------------------------------------- quality contract

# Weight of each quality check in the health score.
CHECK_WEIGHTS = {
    "schema": 20,
    "data_types": 15,
    "accepted_values": 10,
    "nulls": 15,
    "duplicates": 10,
    "freshness": 10,
    "completeness": 10,
    "volume": 5,
    "numeric_ranges": 5,
}


@dataclass(frozen=True)
class Contract:
    """What a table must look like; every list may be empty."""

    name: str = "unknown"
    column_order: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)  # date|integer|number|boolean|string
    accepted: dict[str, tuple] = field(default_factory=dict)
    non_null: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    max_age_days: int = 999999
    min_coverage: float = 1.0
    min_days: int = 0
    min_rows: int = 0
    min_rows_per_day: int = 0
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)


def load_contract(path: str | Path) -> Contract:
    """Read a contract YAML file; a missing file is an empty contract."""
    if not Path(path).exists():
        return Contract()
    raw = yaml.safe_load(Path(path).read_text()) or {}
    return Contract(
        name=raw.get("dataset", {}).get("name", "unknown"),
        column_order=tuple(raw.get("column_order", ())),
        required=tuple(raw.get("required_columns", ())),
        types=dict(raw.get("data_types", {})),
        accepted={c: tuple(v) for c, v in raw.get("accepted_values", {}).items()},
        non_null=tuple(raw.get("non_null_required", ())),
        key=tuple(raw.get("duplicate_key", ())),
        max_age_days=int(raw.get("freshness", {}).get("max_days_since_latest_date", 999999)),
        min_coverage=float(raw.get("completeness", {}).get("minimum_date_coverage_pct", 1.0)),
        min_days=int(raw.get("completeness", {}).get("expected_min_days", 0)),
        min_rows=int(raw.get("volume", {}).get("minimum_rows", 0)),
        min_rows_per_day=int(raw.get("volume", {}).get("minimum_rows_per_day", 0)),
        ranges={c: (b.get("min"), b.get("max")) for c, b in raw.get("numeric_ranges", {}).items()},
    )


