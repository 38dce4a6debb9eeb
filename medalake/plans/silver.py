"""Silver: cleaning rules of the six booking tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from medalake.operators.clean import CleanSpec, clean

# Fixed value: channel given to bookings that name none (the call centre).
DEFAULT_CHANNEL = 4

SPECS = {
    "rutas": CleanSpec(
        key=["ruta_id"],
        text={"origen_iata": "upper", "destino_iata": "upper"},
        casts={"distancia_km": "int", "internacional_flag": "boolean"},
    ),
    "canales": CleanSpec(
        key=["canal_id"],
        text={"nombre": "upper"},
        casts={"canal_id": "int", "digital_flag": "boolean"},
    ),
    "vuelos": CleanSpec(
        key=["vuelo_id"],
        text={"aeronave": "strip"},
        casts={"fecha_vuelo": "timestamp_ntz", "capacidad_asientos": "int"},
        not_null=["vuelo_id", "ruta_id", "fecha_vuelo"],
    ),
    "pasajeros": CleanSpec(
        key=["pasajero_id"],
        text={"pais_residencia": "upper", "segmento": "lower"},
        casts={"fecha_alta": "timestamp_ntz"},
        not_null=["pasajero_id"],
    ),
    "reservas": CleanSpec(
        key=["reserva_id"],
        text={"estado": "upper"},
        casts={
            "canal_id": "int",
            "fecha_reserva": "timestamp_ntz",
            "fecha_vuelo_pretendida": "timestamp_ntz",
            "dias_anticipacion": "int",
            "precio_pagado": "double",
            "asientos_reservados": "int",
            "descuento_aplicado": "double",
            "es_cancelada": "int",
        },
        defaults={"canal_id": DEFAULT_CHANNEL, "descuento_aplicado": 0.0, "es_cancelada": 0},
        not_null=["reserva_id", "pasajero_id", "vuelo_id", "fecha_reserva", "precio_pagado"],
        rules=[
            ("precio_no_positivo", "precio_pagado > 0"),
            ("anticipacion_negativa", "dias_anticipacion >= 0"),
        ],
        order_by=["fecha_reserva"],
    ),
    "pagos": CleanSpec(
        key=["pago_id"],
        text={"medio_pago": "upper", "estado_pago": "upper"},
        casts={"monto": "double"},
        not_null=["pago_id", "reserva_id", "monto"],
        rules=[("monto_no_positivo", "monto > 0")],
    ),
}


def silver_table(
    name: str, bronze: DataFrame, on_error: str = "null", stored: bool = False
) -> DataFrame:
    """Clean one table. ``on_error="fail"`` raises on values that cannot be cast; ``stored`` tells
    that ``bronze`` is a table on storage, see ``clean``."""
    return clean(bronze, replace(SPECS[name], on_error=on_error), stored)


def build_silver(
    bronze: Mapping[str, DataFrame], on_error: str = "null"
) -> dict[str, DataFrame]:
    return {name: silver_table(name, df, on_error) for name, df in bronze.items()}
