"""Claim rules: which channels, benefits, plans and diagnoses take part, and label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.numeric import flag
from claimlens.functions.text import _col

# Fixed values of the business rules.
EXCLUDED_CATEGORIES = [3, 5, 9, 11, 14, 27, 29, 30, 31, 32, 44, 45]
EXCLUDED_CHANNELS = [2, 5, 6, 7, 9]
EXCLUDED_REQUEST_TYPES = [2, 4, 5]
EXCLUDED_BENEFIT_GROUPS = [300, 700, 800, 900]
HOSPITAL_GROUP = 100
HOSPITAL_CATEGORIES = [6, 12, 15, 16, 48]
EXCLUDED_DIAGNOSES = [-1, 16051]
EXCLUDED_DIAGNOSIS_PREFIXES = ["Z", "K0"]
EXCLUDED_DIAGNOSIS_CODE = "BBB"
DENTAL_PLAN_PREFIX = "DEN"
MENTAL_HEALTH = "SALUD MENTAL"
MENTAL_HEALTH_BENEFITS = "BENEFICIOS DE SALUD MENTAL"
PUBLIC_INSURER = "FONASA"
ELECTRONIC_CHANNEL = "Bonificacion I-Med"
APPROVED = 1


def channel_in_scope(category: str, channel: str, request_type: str) -> Column:
    """Every listed category, channel and request type is out, each on its own; NULL is out too."""
    return (
        ~F.col(category).isin(EXCLUDED_CATEGORIES)
        & ~F.col(channel).isin(EXCLUDED_CHANNELS)
        & ~F.col(request_type).isin(EXCLUDED_REQUEST_TYPES)
    )


def benefit_group_in_scope(code: Column | str) -> Column:
    return ~_col(code).isin(EXCLUDED_BENEFIT_GROUPS)


def plan_in_scope(plan: Column | str) -> Column:
    """Dental plans are out; a NULL plan is out as well."""
    return ~_col(plan).startswith(DENTAL_PLAN_PREFIX)


def diagnosis_in_scope(diagnosis_id: Column | str, code: Column | str) -> Column:
    keep = ~_col(diagnosis_id).isin(EXCLUDED_DIAGNOSES)
    for prefix in EXCLUDED_DIAGNOSIS_PREFIXES:
        keep = keep & ~_col(code).startswith(prefix)
    return keep & (_col(code) != EXCLUDED_DIAGNOSIS_CODE)


def is_mental_health(benefit_text: Column | str, subgroup: Column | str) -> Column:
    return (_col(benefit_text) == MENTAL_HEALTH_BENEFITS) | (_col(subgroup) == MENTAL_HEALTH)


def is_public(insurer: Column | str) -> Column:
    return _col(insurer) == PUBLIC_INSURER


def insurer_label(insurer: Column | str) -> Column:
    return F.when(is_public(insurer), PUBLIC_INSURER).otherwise(f"NO {PUBLIC_INSURER}")


def role_label(holder: Column | str, person: Column | str) -> Column:
    return F.when(_col(holder) == _col(person), "Titular").otherwise("Carga")


def state_label(state: Column | str) -> Column:
    return F.when(_col(state) == APPROVED, "APROBADA").otherwise("RECHAZADA")


def female_flag(sex: Column | str) -> Column:
    return flag(_col(sex) == "F")


def hospital_flag(group_code: Column | str, category: Column | str) -> Column:
    return flag((_col(group_code) == HOSPITAL_GROUP) | _col(category).isin(HOSPITAL_CATEGORIES))


def paediatric_flag(age: Column | str) -> Column:
    return flag(_col(age) <= 14)


def geriatric_flag(age: Column | str) -> Column:
    return flag(_col(age) >= 70)
