"""Declared contracts of the seven source tables, and the label sets of the model.

Everything the cleaning step needs to know about a table is data here: column
types, business key, required columns, references, business rules, imputation
and the treatment of personal data. The operators read these declarations and
know no table by name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Columns the ingest adds to every row; they are carried through, never checked.
INGEST_COLUMNS = {"_ingest_ts": "timestamp", "_source_system": "string", "_batch_id": "string"}

WATERMARK_START = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class Reference:
    """A column that must hold a key of another table."""

    column: str
    parent: str


@dataclass(frozen=True)
class Rule:
    """A business rule; ``breaks_when`` is SQL that is true for an offending row."""

    name: str
    breaks_when: str


@dataclass(frozen=True)
class Mask:
    """A clear-text column replaced by its hash; ``mandatory`` hashes null as ''."""

    column: str
    mandatory: bool

    @property
    def output(self) -> str:
        return f"{self.column}_hash"


#: Digits that a number of the source may have before its point; larger ones do not fit their column.
WHOLE_DIGITS = 16


@dataclass(frozen=True)
class Contract:
    table: str
    key: str
    types: dict[str, str]
    required: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    rules: tuple[Rule, ...] = ()
    imputed: dict[str, float] = field(default_factory=dict)
    filled: dict[str, str] = field(default_factory=dict)
    masks: tuple[Mask, ...] = ()
    newest_by: str = "updated_at"

    @property
    def clean_columns(self) -> list[str]:
        """Columns of the cleaned table without ingest columns, in order."""
        hidden = {m.column for m in self.masks}
        return (
            [c for c in self.types if c not in hidden]
            + [m.output for m in self.masks]
            + [f"{c}_missing" for c in self.imputed]
        )


@dataclass(frozen=True)
class Sensitive:
    """One entry of the sensitivity register."""

    table: str
    column: str
    tag: str
    treatment: str

    @property
    def mask(self) -> Mask | None:
        """How the column is hashed, if it is; names also where they are missing."""
        return Mask(self.column, self.tag == "PII_NAME") if self.treatment == "hash_and_drop" else None


PII_REGISTER = (
    Sensitive("drivers", "first_name", "PII_NAME", "hash_and_drop"),
    Sensitive("drivers", "last_name", "PII_NAME", "hash_and_drop"),
    Sensitive("drivers", "doc_type", "PII_IDENTIFIER", "restricted"),
    Sensitive("drivers", "doc_hash", "PII_HASHED", "already_hashed"),
    Sensitive("ratings", "comment_text", "PII_FREE_TEXT", "hash_and_drop"),
    Sensitive("incidents", "incident_text", "PII_FREE_TEXT", "hash_and_drop"),
    Sensitive("incidents", "agent_id", "INTERNAL_IDENTIFIER", "restricted"),
    Sensitive("shipments", "declared_value", "BUSINESS_SENSITIVE", "restricted"),
)

def masks_of(table: str) -> tuple[Mask, ...]:
    return tuple(s.mask for s in PII_REGISTER if s.table == table and s.mask)


CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        # Parents stand before their children: references are enforced in this order.
        Contract(
            table="zones",
            key="zone_id",
            types={
                "zone_id": "string", "zone_name": "string", "city_code": "string", "district": "string",
                "lat": "double", "lon": "double", "traffic_level": "double", "zone_type": "string",
                "depot_km": "double", "updated_at": "timestamp",
            },
            required=("zone_id", "city_code"),
            filled={"district": "NO_DATA"},
        ),
        Contract(
            table="shippers",
            key="shipper_id",
            types={
                "shipper_id": "string", "legal_name": "string", "client_type": "string", "main_city": "string",
                "sla_hours": "int", "penalty_rate": "double", "active": "boolean", "updated_at": "timestamp",
            },
            required=("shipper_id", "sla_hours"),
        ),
        Contract(
            table="drivers",
            key="driver_id",
            types={
                "driver_id": "string", "first_name": "string", "last_name": "string", "doc_type": "string",
                "doc_hash": "string", "hire_date": "date", "base_city": "string", "vehicle_type": "string",
                "home_zone_id": "string", "active": "boolean", "rating_avg": "double", "updated_at": "timestamp",
            },
            required=("driver_id", "hire_date", "home_zone_id"),
            references=(Reference("home_zone_id", "zones"),),
            imputed={"rating_avg": 0.0},
            masks=masks_of("drivers"),
        ),
        Contract(
            table="shipments",
            key="shipment_id",
            types={
                "shipment_id": "string", "shipper_id": "string", "driver_id": "string", "zone_id": "string",
                "package_type": "string", "weight_kg": "double", "received_date": "date", "received_time": "time",
                "due_date": "date", "attempt1_date": "date", "attempt1_time": "time", "attempt1_result": "string",
                "attempt2_date": "date", "attempt2_time": "time", "attempt2_result": "string",
                "delivered_date": "date", "final_status": "string", "failure_code": "string",
                "declared_value": "double", "updated_at": "timestamp",
            },
            required=("shipment_id", "shipper_id", "driver_id", "zone_id", "received_date"),
            references=(
                Reference("driver_id", "drivers"),
                Reference("shipper_id", "shippers"),
                Reference("zone_id", "zones"),
            ),
            rules=(
                Rule("WEIGHT_NOT_POSITIVE", "weight_kg <= 0"),
                Rule("DELIVERED_BEFORE_RECEIVED", "delivered_date < received_date"),
            ),
            imputed={"declared_value": 0.0},
        ),
        Contract(
            table="routes",
            key="route_id",
            types={
                "route_id": "string", "driver_id": "string", "route_date": "date", "start_time": "time",
                "end_time": "time", "km": "double", "stops_planned": "int", "stops_done": "int",
                "deviation_km": "double", "fuel": "double", "updated_at": "timestamp",
            },
            required=("route_id", "driver_id", "route_date"),
            references=(Reference("driver_id", "drivers"),),
            imputed={"fuel": 0.0},
        ),
        Contract(
            table="ratings",
            key="rating_id",
            types={
                "rating_id": "string", "shipment_id": "string", "rating_date": "date", "score": "int",
                "comment_text": "string", "channel": "string", "updated_at": "timestamp",
            },
            required=("rating_id", "shipment_id", "score"),
            references=(Reference("shipment_id", "shipments"),),
            masks=masks_of("ratings"),
        ),
        Contract(
            table="incidents",
            key="incident_id",
            types={
                "incident_id": "string", "shipment_id": "string", "incident_date": "date",
                "incident_type": "string", "incident_text": "string", "agent_id": "string",
                "action_required": "boolean", "updated_at": "timestamp",
            },
            required=("incident_id", "shipment_id", "incident_date"),
            references=(Reference("shipment_id", "shipments"),),
            masks=masks_of("incidents"),
        ),
    )
}


# Fixed value: result and final status of a delivered shipment in the source.
DELIVERED = "Entregado"

# City codes and names.
CITY_NAMES = {
    "BOG": "Bogota",
    "MED": "Medellin",
    "CAL": "Cali",
    "BAQ": "Barranquilla",
    "BGA": "Bucaramanga",
    "PEI": "Pereira",
    "MZL": "Manizales",
    "CTG": "Cartagena",
    "SMR": "Santa Marta",
    "CUC": "Cucuta",
}

# Reasons of a failed delivery.
FAILURE_TEXTS = {
    "DEST_AUSENTE": "Destinatario ausente",
    "DIR_INCORRECTA": "Direccion incorrecta",
    "ZONA_DIFICIL": "Zona de dificil acceso",
    "RECHAZADO": "Paquete rechazado",
    "OTRO": "Otro",
}

# Word contained in the source text -> class, first hit wins.
VEHICLE_CLASSES = {"moto": "Motorcycle", "bici": "Bicycle", "van": "Van"}
VEHICLE_OTHER = "Truck"
INDUSTRY_SEGMENTS = {"ecommerce": "Ecommerce", "farm": "Pharma", "retail": "Retail", "telecom": "Telecom"}
INDUSTRY_OTHER = "Other"

# Weights of the driver score.
SCORE_WEIGHTS = {
    "success_rate": 0.35,
    "route_adherence": 0.20,
    "speed_vs_standard": 0.20,
    "inverse_attempts": 0.15,
    "rating_share": 0.10,
}

VOLUME_ALERT_PCT = 30.0
VOLUME_HISTORY = 7
