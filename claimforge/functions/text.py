"""Text normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimforge.schemas import STANDARD_CLAIM_TYPES


def fold_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def fold_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def standard_claim_type(name: str = "claim_type") -> Column:
    """One of the five standard upper-case types; anything else becomes NULL."""
    folded = fold_upper(name)
    return F.when(folded.isin(STANDARD_CLAIM_TYPES), folded)


def code_list(name: str, separator: str = ",") -> Column:
    """Delimited codes to an array of trimmed upper-case codes without blanks."""
    pieces = F.split(F.col(name), f"\\Q{separator}\\E")
    folded = F.transform(pieces, lambda piece: F.upper(F.trim(piece)))
    return F.filter(folded, lambda piece: piece != "")
