"""Thresholds and code lists of the measures, as typed values."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field

from icuqm.functions.time import DAY, HOUR, MINUTE

# Unit slugs in display order.
UNIT_ORDER = (
    "medical_icu",
    "mixed_cardiothoracic_icu",
    "surgical_icu",
    "mixed_neuro_icu",
    "general_icu",
    "burn_icu",
)

# Display names of the unit slugs.
UNIT_LABELS = {
    "__ALL__": "All ICUs",
    "medical_icu": "Medical ICU",
    "mixed_cardiothoracic_icu": "Cardiothoracic ICU",
    "surgical_icu": "Surgical ICU",
    "mixed_neuro_icu": "Neuro ICU",
    "general_icu": "General ICU",
    "burn_icu": "Burn ICU",
}

# Plausible ranges of charted settings; values outside become NULL.
SETTING_RANGES = {
    "tidal_volume_obs": (100.0, 3000.0),
    "tidal_volume_set": (100.0, 3000.0),
    "plateau_pressure_obs": (0.0, 100.0),
    "peep_obs": (0.0, 50.0),
    "peep_set": (0.0, 30.0),
    "fio2_set": (0.21, 1.0),
}

# Words that no published feed may contain.
FORBIDDEN_IN_FEEDS = ("hospitalization_id", "patient_id")


@dataclass(frozen=True)
class Site:
    name: str
    timezone: str
    data_version: str | None = None
    code_version: str | None = None
    unit_labels: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class LungProtection:
    """Fixed values of the lung-protective ventilation measure."""

    adherence_fraction: float = 0.80
    floor: int = 60 * MINUTE
    fast_carry: int = 2 * HOUR
    slow_carry: int = 6 * HOUR
    max_gap: int = DAY
    trail: int = HOUR
    long_span_days: int = 200
    modes: tuple[str, ...] = (
        "assist control-volume control",
        "pressure-regulated volume control",
        "simv",
        "pressure control",
    )
    vt_max: float = 6.0
    plateau_max: float = 30.0
    dp_max: float = 15.0
    cutoffs: tuple[float, ...] = (4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 10.0)
    feed_cutoff: float = 8.0
    goal: float = 0.90
    height_range: tuple[float, float] = (100.0, 230.0)
    min_pbw: float = 25.0
    adult_years: float = 18.0
    definition_version: str = "lpv-v1"


@dataclass(frozen=True)
class Severity:
    """Fixed values of the oxygenation severity classes."""

    pf_below: float = 300.0
    sf_below: float = 315.0
    spo2_max: float = 97.0
    peep_above: float = 5.0
    lookback: int = 4 * HOUR
    pao2_range: tuple[float, float] = (30.0, 700.0)
    spo2_range: tuple[float, float] = (50.0, 100.0)


@dataclass(frozen=True)
class Sedation:
    """Fixed values of the sedation interruption measure."""

    sedatives: tuple[str, ...] = ("propofol", "midazolam", "fentanyl", "hydromorphone", "morphine", "remifentanil", "ketamine")
    dexmedetomidine: tuple[str, ...] = ("dexmedetomidine",)
    paralytics: tuple[str, ...] = ("cisatracurium", "vecuronium", "rocuronium")
    exclude_paralytic_days: bool = True
    hold: int = 30 * MINUTE
    half_dose: float = 0.5
    cap: int = DAY
    small_cell: int = 10
    null_action_is_running: bool = False
    definition_version: str = "sat-v1"


@dataclass(frozen=True)
class BreathingTrial:
    """Fixed values of the breathing trial measure."""

    controlled_modes: tuple[str, ...] = (
        "assist control-volume control",
        "pressure control",
        "pressure-regulated volume control",
        "simv",
    )
    support_modes: tuple[str, ...] = ("pressure support/cpap",)
    controlled_hours: int = 12
    stable_hours: int = 2
    max_step: int = 90 * MINUTE
    fio2_max: float = 0.50
    peep_max: float = 8.0
    spo2_min: float = 88.0
    spo2_range: tuple[float, float] = (50.0, 100.0)
    spo2_tolerance: int = HOUR
    ne_max: float = 0.2
    exclude_trach_days: bool = True
    exclude_paralytic_days: bool = True
    paralytics: tuple[str, ...] = ("cisatracurium", "rocuronium", "vecuronium", "atracurium", "pancuronium")
    ne_factors: tuple[tuple[str, float], ...] = (
        ("norepinephrine", 1.0),
        ("epinephrine", 1.0),
        ("phenylephrine", 0.1),
        ("dopamine", 0.01),
        ("vasopressin", 2.5),
        ("dobutamine", 0.0),
        ("milrinone", 0.0),
        ("isoproterenol", 0.0),
        ("angiotensin", 0.0),
    )
    not_per_kg: tuple[str, ...] = ("vasopressin",)
    # Charted unit -> (factor to mcg/min or u/min, already per kg). Our own table.
    unit_scale: tuple[tuple[str, tuple[float, bool]], ...] = (
        ("mcg/kg/min", (1.0, True)),
        ("mcg/kg/hr", (1.0 / 60, True)),
        ("mg/kg/hr", (1000.0 / 60, True)),
        ("ng/kg/min", (0.001, True)),
        ("mcg/min", (1.0, False)),
        ("mcg/hr", (1.0 / 60, False)),
        ("mg/min", (1000.0, False)),
        ("mg/hr", (1000.0 / 60, False)),
        ("u/min", (1.0, False)),
        ("u/hr", (1.0 / 60, False)),
    )
    support_minutes: float = 2.0
    ps_peep_max: float = 8.0
    cpap_peep_max: float = 5.0
    trail: int = HOUR
    cap: int = DAY
    assessable_gates_stability: bool = False
    close_at_cap: bool = False
    null_action_is_running: bool = False
    definition_version: str = "sbt-v1"


@dataclass(frozen=True)
class Proning:
    """Fixed values of the proning measure."""

    lookback: int = 6 * HOUR
    fio2_range: tuple[float, float] = (0.15, 1.0)
    peep_range: tuple[float, float] = (0.0, 40.0)
    percent_above: float = 1.5
    pf_range: tuple[float, float] = (10.0, 1000.0)
    onset_pf_max: float = 300.0
    onset_fio2_min: float = 0.4
    onset_peep_min: float = 5.0
    adult_years: float = 18.0
    pf_max: float = 150.0
    fio2_min: float = 0.6
    peep_min: float = 5.0
    sustained: int = 12 * HOUR
    adherent_hours: float = 16.0
    horizons: tuple[int, ...] = (24, 48, 72, 168)
    small_cell: int = 10
    definition_version: str = "proning-v1"


@dataclass(frozen=True)
class Config:
    site: Site | None = None
    lpv: LungProtection = field(default_factory=LungProtection)
    severity: Severity = field(default_factory=Severity)
    sat: Sedation = field(default_factory=Sedation)
    sbt: BreathingTrial = field(default_factory=BreathingTrial)
    proning: Proning = field(default_factory=Proning)


def fingerprint(*parts: object) -> str:
    """Short hash of configuration values; a stored stage is reused only under the same one."""
    plain = [dataclasses.asdict(p) if dataclasses.is_dataclass(p) else p for p in parts]
    return hashlib.sha256(json.dumps(plain, sort_keys=True, default=str).encode()).hexdigest()[:16]
