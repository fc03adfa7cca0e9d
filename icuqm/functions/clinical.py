"""Row-level rules: cleaning, categories, body weight and derived ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name parts that sort a drug into a bucket.
PARALYTIC_WORDS = ("cisatracurium", "vecuronium", "rocuronium", "atracurium", "pancuronium", "succinylcholine")
DEX_WORDS = ("dexmedetomidine", "precedex")
SEDATIVE_WORDS = (
    "propofol",
    "midazolam",
    "lorazepam",
    "diazepam",
    "fentanyl",
    "hydromorphone",
    "morphine",
    "remifentanil",
    "sufentanil",
    "ketamine",
)


def category(c: Column, blank: str | None = None) -> Column:
    """Trimmed lower-case code; blank becomes NULL, or ``blank`` where one is given."""
    clean = F.nullif(F.lower(F.trim(c.cast("string"))), F.lit(""))
    return F.coalesce(clean, F.lit(blank)) if blank is not None else clean


def label(c: Column, blank: str = "unknown") -> Column:
    """Trimmed text with its case kept, blank as ``blank``."""
    return F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), F.lit(blank))


def number(c: Column) -> Column:
    """Numeric value; text that is not a number becomes NULL."""
    return c.try_cast("double")


def years_between(birth: Column, at: Column) -> Column:
    """Whole elapsed days over 365.25 (F1)."""
    day = F.lit(86_400_000_000)
    return F.floor((F.unix_micros(at.cast("timestamp")) - F.unix_micros(birth.cast("timestamp"))) / day) / F.lit(365.25)


def within(c: Column, bounds: tuple[float, float]) -> Column:
    return c.between(F.lit(float(bounds[0])), F.lit(float(bounds[1])))


def null_outside(c: Column, bounds: tuple[float, float]) -> Column:
    """Keep the row but blank an implausible value (F2)."""
    return F.when(within(c, bounds), c)


def at_most(c: Column, limit: float) -> Column:
    """Threshold test in which an unknown value fails."""
    return F.coalesce(c <= F.lit(float(limit)), F.lit(False))


def at_least(c: Column, limit: float) -> Column:
    return F.coalesce(c >= F.lit(float(limit)), F.lit(False))


def predicted_body_weight(height_cm: Column, sex: Column, smallest: float = 25.0) -> Column:
    """Devine weight in kg from height and sex; implausibly small values are unknown."""
    inches = height_cm / F.lit(2.54)
    base = F.when(F.lower(sex) == "male", F.lit(50.0)).when(F.lower(sex) == "female", F.lit(45.5))
    weight = base + F.lit(2.3) * (inches - F.lit(60.0))
    return F.when(weight >= F.lit(smallest), weight)


def first_true(rules: Mapping[str, Column], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    out = None
    for name, rule in rules.items():
        held = F.coalesce(rule, F.lit(False))
        out = F.when(held, F.lit(name)) if out is None else out.when(held, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def mentions(c: Column, words: Sequence[str]) -> Column:
    return c.rlike("|".join(words))


def drug_bucket(c: Column) -> Column:
    """Paralytic before dexmedetomidine before sedative, by name part."""
    clean = F.coalesce(category(c), F.lit(""))
    return (
        F.when(mentions(clean, PARALYTIC_WORDS), F.lit("paralytic"))
        .when(mentions(clean, DEX_WORDS), F.lit("dexmedetomidine"))
        .when(mentions(clean, SEDATIVE_WORDS), F.lit("sat_relevant"))
        .otherwise(F.lit("other"))
    )


def mapped(c: Column, labels: Mapping[str, str]) -> Column:
    """Friendly label of a code, or the code itself."""
    if not labels:
        return c
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(pairs[c], c)


def died(discharge: Column) -> Column:
    """Died in hospital (F16)."""
    return F.coalesce(F.lower(discharge) == "expired", F.lit(False))


def alive_at(death_us: Column, at_us: Column) -> Column:
    """No death time, or one after the instant."""
    return death_us.isNull() | (death_us > at_us)
