"""Schemas of the health-care records that the engine enriches out of the box.

Fixed values: field names and types must match the files and messages users already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.spec import Registry, SourceSpec


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "patient_info": _schema(
        "patientID STRING, patientname STRING, age INT, streetAddress STRING, city STRING, "
        "email STRING, number STRING"
    ),
    "billing_cost": _schema("pcn STRING, patientID STRING, totalCost BIGINT"),
    "insurance_details": _schema(
        "pcn STRING, providerName STRING, opened TIMESTAMP, reason STRING, disposition STRING, "
        "conclusion STRING, amountPayed BIGINT, insuranceDate TIMESTAMP"
    ),
    "medicine_orders": _schema(
        "pcn STRING, medName STRING, dosageForm STRING, labelerName STRING, substanceName STRING, "
        "medDesc STRING, medPrice BIGINT"
    ),
    "treatment": _schema("pcn STRING, icd STRING, treatmentDesc STRING, visitDate TIMESTAMP"),
}

# Name of each part inside an enriched record.
RECORD_FIELDS: dict[str, str] = {
    "patient_info": "patientInfo",
    "treatment": "treatment",
    "medicine_orders": "medicineOrders",
    "billing_cost": "billingCost",
    "insurance_details": "insuranceDetails",
}


def health_registry(**options) -> Registry:
    """The four streamed sources; ``patient_info`` is the lookup and not streamed."""
    return Registry([SourceSpec(n, s, **options) for n, s in SCHEMAS.items() if n != "patient_info"])
