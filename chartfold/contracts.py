"""Column contracts: what a landing file must offer and how its columns are treated."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Texts that a silver CSV file uses for NULL.
NULL_TOKENS = ("NULL", "", "NONE")

LINEAGE_COLUMNS = ("source_vendor", "lineage_file_uuid")
HASHED_ID = "hashed_patient_id"


@dataclass(frozen=True)
class Field:
    """One contract column.

    ``type`` is a Spark SQL type name, ``non_blank`` drops rows without a value, and
    ``default`` replaces a blank value. ``xml_path`` says where an XML record holds the value, if not
    in a child of the column's name: ``patient/@id`` is an attribute, and ``scores/score[]`` are
    repeated children, whose texts, but blank ones, are joined by commas in their order.
    """

    name: str
    type: str = "string"
    non_blank: bool = False
    default: str | None = None
    xml_path: str | None = None


@dataclass(frozen=True)
class Contract:
    """Ordered columns, the natural key, and the column that holds the clear identity."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ("encounter_id",)
    identity: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def non_blank(self) -> list[str]:
        return [f.name for f in self.fields if f.non_blank]

    @property
    def silver_columns(self) -> list[str]:
        """Contract columns with the identity replaced by its hash, then lineage."""
        kept = [HASHED_ID if c == self.identity else c for c in self.columns]
        return kept + [c for c in LINEAGE_COLUMNS if c not in kept]

    @property
    def text_schema(self) -> T.StructType:
        """All-string read schema, so identifiers such as ``00123`` keep their zeros."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def silver_text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.silver_columns])

    @property
    def payload(self) -> list[str]:
        """Typed columns that a history version carries besides its natural key."""
        return [c for c in self.silver_columns if c not in self.key]

    def typed(self, column: str) -> str:
        return next((f.type for f in self.fields if f.name == column), "string")

    def staging_schema(self) -> T.StructType:
        columns = [f"{c} {self.typed(c)}" for c in self.silver_columns]
        return T.StructType.fromDDL(", ".join([*columns, "ingested_at timestamp_ntz"]))

    def history_schema(self) -> T.StructType:
        columns = [f"{c} {self.typed(c)}" for c in self.silver_columns]
        audit = ["start_time timestamp_ntz", "end_time timestamp_ntz", "is_current boolean"]
        return T.StructType.fromDDL(", ".join(["vitals_hash_key string", *columns, *audit]))

    def keyed_by(self, *key: str) -> Contract:
        return replace(self, key=key)


ENROLLMENT = Contract(
    name="enrollment",
    fields=(
        Field("encounter_id", non_blank=True),
        Field("patient_id", non_blank=True),
        Field("enrollment_date"),
        Field("gpa", default="0.00"),
    ),
    identity="patient_id",
)

VITALS = Contract(
    name="vitals",
    fields=(
        Field("encounter_id", non_blank=True),
        Field("hashed_patient_id"),
        Field("heart_rate", "bigint"),
        Field("blood_pressure"),
        Field("temperature", "double"),
        Field("source_vendor"),
        Field("lineage_file_uuid"),
    ),
)
