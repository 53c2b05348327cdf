"""chartfold: land, clean, pseudonymise and version clinical files with Spark."""

from chartfold.contracts import ENROLLMENT, VITALS, Contract, Field

__all__ = ["ENROLLMENT", "VITALS", "Contract", "Field"]
