"""Declared schemas: bronze tables of the booking domain."""

from __future__ import annotations

# Source columns of each bronze table, as landed. Identifiers are text, dates are timestamps
# without zone, the cancel flag is 0/1. Every bronze table also carries the audit columns.
BRONZE = {
    "rutas": (
        "ruta_id string, origen_iata string, origen_ciudad string, destino_iata string, "
        "destino_ciudad string, distancia_km bigint, internacional_flag boolean"
    ),
    "canales": (
        "canal_id bigint, nombre string, digital_flag boolean, categoria string"
    ),
    "vuelos": (
        "vuelo_id string, numero_vuelo string, ruta_id string, fecha_vuelo timestamp_ntz, "
        "aeronave string, capacidad_asientos bigint, aerolinea string"
    ),
    "pasajeros": (
        "pasajero_id string, pais_residencia string, segmento string, fecha_alta timestamp_ntz"
    ),
    "reservas": (
        "reserva_id string, pasajero_id string, vuelo_id string, canal_id double, "
        "fecha_reserva timestamp_ntz, fecha_vuelo_pretendida timestamp_ntz, "
        "dias_anticipacion bigint, precio_pagado double, asientos_reservados bigint, "
        "descuento_aplicado double, es_cancelada bigint, estado string"
    ),
    "pagos": (
        "pago_id string, reserva_id string, medio_pago string, estado_pago string, monto double"
    ),
}

AUDIT = "_extraido_en timestamp_ntz, _fuente string"
AUDIT_COLUMNS = ("_extraido_en", "_fuente")

TABLES = tuple(BRONZE)
