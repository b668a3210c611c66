"""Licence text to SPDX identifiers, elements and permissions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.scalars import present, stripped

# Patterns of the policy, in Java and RE2 syntax alike.
ELEMENTS = ["BY", "NC", "ND", "SA"]
ZERO = r"\b(cc0|cc-zero|zero)\b"
PUBLIC = r"\b(pdm|publicdomain|public domain|pd)\b"
RESTRICTED = r"non[-\s]*commercial|no[-\s]*deriv|\bnc\b|\bnd\b"
CODED = r"(?i)^(?:cc[-\s_]*)?((?:by|nc|nd|sa)(?:[-\s_]+(?:by|nc|nd|sa))*)(?:[-\s_]+(\d+\.\d+))?$"
MARKER = r"(?i)creative\s*commons|creativecommons\.org|\bcc\b"
LONG_FORM = {"BY": r"(?i)\battribution\b", "NC": r"(?i)non[-\s]*commercial", "ND": r"(?i)no[-\s]*deriv", "SA": r"(?i)share[-\s]*alike"}
LONG_VERSION = r"(?is)(?:\battribution\b|non[-\s]*commercial|no[-\s]*deriv|share[-\s]*alike).*?(\d+\.\d+)"
SHARE_ALIKE = r"share[-\s]*alike|\bsa\b"
DEFAULT_VERSION = "4.0"


def _spdx(elements: Column, version: Column) -> Column:
    ordered = F.filter(F.array(*map(F.lit, ELEMENTS)), lambda e: F.array_contains(elements, e))
    return F.concat(F.lit("CC-"), F.array_join(ordered, "-"), F.lit("-"), F.coalesce(present(version), F.lit(DEFAULT_VERSION)))


def normalise_license(raw: Column) -> Column:
    """An SPDX identifier, or null where the text can't be read as one licence."""
    text = stripped(raw)
    low = F.lower(text)
    claim = F.when(low.rlike(ZERO), F.lit("CC0-1.0")).when(low.rlike(PUBLIC), F.lit("PDM-1.0"))
    coded = F.split(F.upper(F.regexp_extract(text, CODED, 1)), r"[-\s_]+")
    named = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(e)) for e, p in LONG_FORM.items()]))
    prose = text.rlike(MARKER) & F.array_contains(named, "BY")
    return (
        F.when(claim.isNotNull(), F.when(~low.rlike(RESTRICTED), claim))
        .when(text.rlike(CODED), _spdx(coded, F.regexp_extract(text, CODED, 2)))
        .when(prose, _spdx(named, F.regexp_extract(text, LONG_VERSION, 1)))
    )


def license_elements(spdx: Column) -> Column:
    """The elements of an identifier; none for public-domain marks."""
    parts = F.split(F.substring(spdx, 4, 100), "-")
    found = F.array_intersect(parts, F.array(*map(F.lit, ELEMENTS)))
    return F.when(spdx.startswith("CC-"), found).otherwise(F.array().cast("array<string>"))


def permits(spdx: Column, forbidden) -> Column:
    return ~F.arrays_overlap(license_elements(spdx), F.array(*map(F.lit, forbidden)).cast("array<string>"))


def requires_attribution(spdx: Column) -> Column:
    return spdx.startswith("CC-BY")


def deed_license(href: Column) -> Column:
    """A licence code from the URL of a Creative Commons deed."""
    own = r"(?i)creativecommons\.org/licenses/([a-z\-]+)(?:/(\d+\.\d+))?"
    return (
        F.when(href.rlike(own), F.concat_ws("-", F.regexp_extract(href, own, 1), present(F.regexp_extract(href, own, 2))))
        .when(href.rlike(r"(?i)creativecommons\.org/publicdomain/zero"), F.lit("cc0"))
        .when(href.rlike(r"(?i)creativecommons\.org/publicdomain/mark"), F.lit("public domain"))
    )


def restrictiveness(raw: Column) -> Column:
    """3 for NC or ND, 2 for share-alike, 1 for attribution, else 0: ranks the licence boxes of a page."""
    low = F.lower(raw)
    return F.when(low.rlike(RESTRICTED), 3).when(low.rlike(SHARE_ALIKE), 2).when(low.contains("by") | low.contains("attribution"), 1).otherwise(0)
