"""RX1-RX6, RX8: names, roles and administrators in movement sentences.

Spark's regex engine is Java's: ``i`` ignores case, ``u`` extends that to
accented letters, ``d`` makes ``.`` exclude only the line feed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflow.constants import PARTY_ROLES

_FLAGS = "(?iud)"

# The sentence patterns.
_ENROLMENT = r"(?:DESH?)?ABILIT.+?Parte:\s+"
_NOTICE = (r"(?:P/\s*advgs\.|advogados?/curador/defensor|pelo\s+advogado/curador/defensor)"
           r"\s+de\s+")
_ADMIN = r"ADMINISTRADOR\s+JUDICIAL"
_TRUSTEE = r"\(S[IÍ]NDICO\s+DO\(A\)"
_ROLES = "|".join(PARTY_ROLES)

MENTIONS_PARTY = _FLAGS + f"{_ENROLMENT}|{_NOTICE}"
ENROLMENT = _FLAGS + _ENROLMENT
NOTICE = _FLAGS + _NOTICE
NAME_A = _FLAGS + _ENROLMENT + _ADMIN + r"\s*\(([^)]+)\)\s*\("
NAME_B = _FLAGS + _ENROLMENT + r"\(" + _ADMIN + r"\)\s*([^(]+?)\s*\("
NAME_C = _FLAGS + _ENROLMENT + r"(.+?)\s*" + _TRUSTEE
NAME_D = _FLAGS + _ENROLMENT + r"([^(]+?)\s*\(" + _ADMIN + r"\)\s*\("
NAME_E = _FLAGS + _ENROLMENT + rf"(.+?)\s*\((?:{_ROLES})\)"
NOTICE_NAME = (_FLAGS + _NOTICE + r"(.+?(?:\([^)]+\))?)"
               r"(?:\s+com\s+prazo|\s+\*|\s+em\s+\d|\s*\)\s+em\s|\s*\z)")
TRUSTEE_TAIL = _FLAGS + r"\s*" + _TRUSTEE + r".+\z"
ESTATE_PREFIX = _FLAGS + r"^MASSA\s+FALIDA\s*(?:DE\s+|-\s*)"
ROLE = _FLAGS + rf"\(({_ROLES})\)\s*\z"
HAS_C = _FLAGS + _ENROLMENT + r".+?" + _TRUSTEE
HAS_A = _FLAGS + _ENROLMENT + _ADMIN + r"\s*\("
HAS_B = _FLAGS + _ENROLMENT + r"\(" + _ADMIN + r"\)"
HAS_D = _FLAGS + _ENROLMENT + r"[^(]+\(" + _ADMIN + r"\)"
HAS_NOTICE_TRUSTEE = _FLAGS + _NOTICE + r".+?S[IÍ]NDICO\s+DO\(A\)"
ADMIN_A = _FLAGS + _ADMIN + r"\s*\(([^)]+)\)"
ADMIN_B = _FLAGS + r"\(" + _ADMIN + r"\)\s*([^(]+?)\s*\("
ADMIN_D = _FLAGS + _ENROLMENT + r"([^(]+?)\s*\(" + _ADMIN + r"\)"
ADMIN_NOTICE = _FLAGS + _NOTICE + r"(.+?)\s*" + _TRUSTEE


def _grab(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1)


def _grab_or_null(text: Column, pattern: str) -> Column:
    return F.nullif(_grab(text, pattern), F.lit(""))


def _squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def party_name(text: Column) -> Column:
    """RX2-RX4: enrolment patterns A to E in that order, else the notice pattern."""
    enrolment = F.coalesce(*[_grab_or_null(text, p) for p in (NAME_A, NAME_B, NAME_C, NAME_D, NAME_E)])
    notice = F.nullif(
        F.regexp_replace(_grab(text, NOTICE_NAME), TRUSTEE_TAIL, ""), F.lit("")
    )
    raw = F.when(text.rlike(ENROLMENT), enrolment).when(text.rlike(NOTICE), notice)
    return F.lower(F.trim(_squeeze(F.regexp_replace(_squeeze(raw), ESTATE_PREFIX, ""))))


def party_role(text: Column) -> Column:
    """RX5: the closing role; '' for an enrolment with no known role, NULL elsewhere."""
    return F.when(text.rlike(ENROLMENT), F.lower(_grab(text, ROLE)))


def administrator(text: Column) -> Column:
    """RX6: tests C, A, B, D, then a notice to a trustee."""
    def clean(pattern: str) -> Column:
        return F.lower(F.trim(_grab(text, pattern)))

    return (
        F.when(text.rlike(HAS_C), clean(NAME_C))
        .when(text.rlike(HAS_A), clean(ADMIN_A))
        .when(text.rlike(HAS_B), clean(ADMIN_B))
        .when(text.rlike(HAS_D), clean(ADMIN_D))
        .when(text.rlike(HAS_NOTICE_TRUSTEE), clean(ADMIN_NOTICE))
    )


# Company suffix rules, applied in this order (unicode word rules).
SUFFIX_RULES = (
    (r"(?iU)\s*&\s*cia\.?\s+ltda\.?", " e cia ltda"),
    (r"(?iU)\s*&\s*cia\.?\s+s\.?/?a\.?", " e cia sa"),
    (r"(?iU)\bcia\.", "cia"),
    (r"(?iU)\bs\.?/?a\.?", "sa"),
    (r"(?iU)\bltda\.?", "ltda"),
)


def normalise_suffix(name: Column) -> Column:
    """RX8: one spelling per company suffix, no commas, single spaces."""
    for pattern, replacement in SUFFIX_RULES:
        name = F.regexp_replace(name, pattern, replacement)
    name = F.replace(name, F.lit(","), F.lit(""))
    return F.trim(F.regexp_replace(name, r"(?U)\s+", " "))
