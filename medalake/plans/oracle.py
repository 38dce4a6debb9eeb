"""The registered queries as plain SQL, for comparison on another engine (DuckDB dialect)."""

from __future__ import annotations


def _money(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def _mean(c: str) -> str:
    return f"{_money(c)} / COUNT({c})"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0), {digits})"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _spine(bounds: str, name: str = "cal", sunday: bool = False) -> str:
    """CTEs ``<name>`` with the calendar over ``bounds`` (a SELECT of lo, hi)."""
    return f"""
    {name}_days AS (
        SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                           INTERVAL 1 DAY)) AS DATE) AS fecha
        FROM ({bounds})
    ),
    {name} AS (
        SELECT ROW_NUMBER() OVER (ORDER BY fecha) AS tiempo_sk, fecha,
               CAST(year(fecha) AS INTEGER) AS anio,
               CAST(quarter(fecha) AS INTEGER) AS trimestre,
               CAST(month(fecha) AS INTEGER) AS mes,
               strftime(fecha, '%B') AS mes_nombre,
               CAST(day(fecha) AS INTEGER) AS dia,
               CAST({'dayofweek(fecha)' if sunday else 'isodow(fecha) - 1'} AS INTEGER)
                   AS dia_semana,
               strftime(fecha, '%A') AS dia_nombre,
               isodow(fecha) >= 6 AS es_fin_semana,
               month(fecha) IN (1, 7, 12) AS es_temporada_alta
        FROM {name}_days
    )"""


def _span(table: str, column: str) -> str:
    return (
        f"SELECT CAST(MIN({column}) AS DATE) AS lo, CAST(MAX({column}) AS DATE) AS hi FROM {table}"
    )


ORDERS_CAL = _spine(_span("orders", "o_orderdate"))
EVENTS_CAL = _spine(_span("events", "ts"))
CANCEL = "CAST(o_orderstatus = 'F' AS INTEGER)"
LEAD = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"
BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER)"
ROUTE_FROM = f"CAST(FLOOR({BRAND} / 10) AS INTEGER)"

# Orders as bookings.
BOOKED = f"""
    booked AS (
        SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority,
               {CANCEL} AS cancelled, c_mktsegment, c_nationkey
        FROM orders JOIN customer ON o_custkey = c_custkey
    ),
    routes AS (
        SELECT n_nationkey, n_name || '→' || r_name AS ruta, r_name <> 'AMERICA' AS intl
        FROM nation JOIN region ON n_regionkey = r_regionkey
    )"""

# Order lines as bookings, parts as flights, brands as routes.
LINES = f"""
    lines AS (
        SELECT l_orderkey || '-' || l_linenumber AS reserva_id, l_partkey, o_custkey, o_orderdate,
               o_orderpriority, l_extendedprice AS price, l_quantity AS seats,
               l_discount AS discount, CAST({LEAD} AS INTEGER) AS lead, {CANCEL} AS cancelled,
               p_brand, p_name, p_type, p_size, c_mktsegment, n_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN part ON l_partkey = p_partkey
             JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
    ),
    brands AS (
        SELECT DISTINCT p_brand, 'A' || {ROUTE_FROM} AS origin, 'B' || ({BRAND} % 10) AS target,
               {BRAND} % 5 = 0 AS intl
        FROM part
    )"""

Q = {}

Q["q1_monthly"] = f"""
    WITH {ORDERS_CAL}, {BOOKED}
    SELECT anio, trimestre, mes, mes_nombre, COUNT(*) AS reservas,
           {_money('o_totalprice')} AS ingresos_cop, {_mean('o_totalprice')} AS ticket_promedio,
           {_big('SUM(cancelled)')} AS canceladas,
           {_pct('SUM(cancelled)', 'COUNT(*)', 2)} AS tasa_cancel_pct
    FROM booked JOIN cal ON CAST(o_orderdate AS DATE) = fecha
    GROUP BY ALL"""

Q["q2_utilisation"] = f"""
    WITH {LINES},
    sold AS (
        SELECT p_brand, SUM(seats) AS sold FROM lines
        WHERE cancelled = 0 AND o_orderdate >= DATE '2000-01-01' GROUP BY p_brand
    ),
    departures AS (
        SELECT l_partkey, MAX(l_shipdate) AS departure FROM lineitem GROUP BY l_partkey
    ),
    capacity AS (
        SELECT p_brand, SUM(p_size) AS seats FROM part JOIN departures ON p_partkey = l_partkey
        WHERE departure >= DATE '2000-01-01' GROUP BY p_brand
    )
    SELECT origin || '→' || target AS ruta, intl AS internacional_flag,
           sold AS asientos_vendidos, {_big('seats')} AS asientos_disponibles,
           {_pct('sold', 'seats', 1)} AS ocupacion_pct
    FROM sold JOIN capacity USING (p_brand) JOIN brands USING (p_brand)"""

Q["q3_conversion"] = f"""
    SELECT substr(o_orderpriority, 3) AS canal,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 AS digital_flag,
           COUNT(*) AS total_reservas, {_big(f'SUM(1 - {CANCEL})')} AS confirmadas,
           {_big(f'SUM({CANCEL})')} AS canceladas,
           {_pct(f'SUM(1 - {CANCEL})', 'COUNT(*)', 2)} AS conversion_pct,
           {_money('o_totalprice')} AS ingresos_cop
    FROM orders GROUP BY ALL"""

Q["q4_lead_time"] = f"""
    WITH {LINES}
    SELECT month(o_orderdate) IN (1, 7, 12) AS es_temporada_alta, c_mktsegment AS segmento,
           COUNT(*) AS reservas, ROUND(AVG(lead), 1) AS dias_anticipacion_avg,
           ROUND({_mean('price')}, 0) AS ticket_promedio
    FROM lines WHERE cancelled = 0 GROUP BY ALL"""

Q["q5_peaks"] = """
    SELECT dia_nombre, hora, reservas FROM (
        SELECT strftime(ts, '%A') AS dia_nombre, isodow(ts) - 1 AS dow,
               CAST(hour(ts) AS INTEGER) AS hora, COUNT(*) AS reservas
        FROM events WHERE isodow(ts) - 1 IN (0, 4, 5, 6) GROUP BY ALL
        ORDER BY reservas DESC, dow, hora LIMIT 15
    )"""

Q["q5_peaks_sunday"] = Q["q5_peaks"]

Q["money_fine_scale"] = """
    SELECT l_returnflag,
           CAST(SUM(CAST(l_extendedprice / 10000 AS DECIMAL(38,6))) AS DOUBLE) AS amount,
           CAST(0 AS BIGINT) AS misfits
    FROM lineitem GROUP BY l_returnflag"""

Q["money_large"] = """
    SELECT o_orderstatus,
           CAST(SUM(CAST(o_totalprice * 1e12 AS DECIMAL(38,4))) AS VARCHAR) AS amount
    FROM orders GROUP BY o_orderstatus"""

Q["topk_routes"] = f"""
    WITH {BOOKED}
    SELECT ruta, intl AS internacional_flag, {_money('o_totalprice')} / 1e6 AS "ingresos_M_COP",
           COUNT(*) AS asientos
    FROM booked JOIN routes ON c_nationkey = n_nationkey WHERE cancelled = 0
    GROUP BY ALL ORDER BY 3 DESC, ruta LIMIT 10"""

_HOURS = ", ".join(
    f"COUNT(event_id) FILTER (WHERE hour(ts) = {h}) AS h{h:02d}" for h in range(24)
)
_DAYS = ", ".join(
    f"({i}, '{label}')"
    for i, label in enumerate(["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"])
)
Q["pivot_day_hour"] = f"""
    WITH spine(dow, dia) AS (VALUES {_DAYS}),
    cells AS (SELECT isodow(ts) - 1 AS dow, {_HOURS} FROM events GROUP BY 1)
    SELECT dia, cells.* EXCLUDE (dow) FROM spine LEFT JOIN cells USING (dow)"""

Q["trend_monthly"] = f"""
    WITH monthly AS (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
               CAST(month(o_orderdate) AS INTEGER) AS mes,
               {_money('o_totalprice')} / 1e6 AS y, COUNT(*) AS reservas
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2
    ),
    numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY anio, mes) - 1 AS x FROM monthly),
    line AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM numbered)
    SELECT anio, mes, y AS "ingresos_M_COP", reservas,
           anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo,
           ROUND(a, 4) AS pendiente, ROUND(b, 4) AS intercepto, ROUND(b + a * x, 4) AS ajuste
    FROM numbered, line"""

Q["kpi_row"] = f"""
    WITH {LINES}
    SELECT (SELECT {_pct('SUM(cancelled)', 'COUNT(*)', 2)} FROM lines) AS tasa_cancelacion_pct,
           (SELECT ROUND({_mean('price')}, 0) FROM lines WHERE cancelled = 0) AS ticket_promedio,
           (SELECT ROUND(AVG(lead), 1) FROM lines WHERE cancelled = 0) AS ventana_media_dias,
           (SELECT {_money('price')} / 1e9 FROM lines WHERE cancelled = 0)
               AS "ingresos_total_B_COP",
           (SELECT COUNT(*) FROM lines) AS total_reservas,
           (SELECT COUNT(*) FROM lines WHERE cancelled = 0) AS confirmadas"""

Q["conversion_long"] = f"""
    WITH {BOOKED}
    SELECT substr(o_orderpriority, 3) AS canal, c_mktsegment AS segmento,
           {_pct('SUM(1 - cancelled)', 'COUNT(*)', 1)} AS conversion_pct, COUNT(*) AS total
    FROM booked GROUP BY ALL"""


def _by_segment(value) -> str:
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    columns = ", ".join(f"{value(s)} AS {s.lower()}" for s in segments)
    return f"""
        WITH {BOOKED}
        SELECT substr(o_orderpriority, 3) AS canal, {columns} FROM booked GROUP BY 1"""


Q["pivot_channel_segment"] = _by_segment(
    lambda s: f"ROUND(CAST(SUM(1 - cancelled) FILTER (WHERE c_mktsegment = '{s}') AS DOUBLE)"
    f" * 100 / NULLIF(COUNT(*) FILTER (WHERE c_mktsegment = '{s}'), 0), 1)"
)
Q["pivot_channel_segment_sum"] = _by_segment(
    lambda s: "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4)))"
    f" FILTER (WHERE c_mktsegment = '{s}') AS DOUBLE)"
)

Q["card_route_count_since"] = f"""
    WITH {BOOKED}
    SELECT ruta, COUNT(*) AS reservas FROM booked JOIN routes ON c_nationkey = n_nationkey
    WHERE o_orderdate >= DATE '2000-01-01' GROUP BY ruta"""

Q["card_monthly_revenue"] = f"""
    WITH {LINES}
    SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
           {_money('price')} AS ingresos
    FROM lines GROUP BY 1, 2"""

Q["card_lead_and_cancelled"] = f"""
    WITH {LINES}
    SELECT ROUND(AVG(lead), 4) AS dias_anticipacion_avg,
           COUNT(*) FILTER (WHERE cancelled = 1) AS canceladas
    FROM lines"""

Q["bench_a"] = f"""
    WITH {ORDERS_CAL}, {BOOKED}
    SELECT anio, mes, COUNT(*) AS reservas, {_money('o_totalprice')} AS ingresos
    FROM booked JOIN cal ON CAST(o_orderdate AS DATE) = fecha WHERE cancelled = 0 GROUP BY 1, 2"""

Q["bench_a_rowstore_form"] = f"""
    SELECT strftime(o_orderdate, '%Y') AS anio, strftime(o_orderdate, '%m') AS mes,
           COUNT(*) AS reservas, {_money('o_totalprice')} AS ingresos
    FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2"""

Q["bench_b"] = f"SELECT COUNT(*) AS reservas, {_money('o_totalprice')} AS ingresos FROM orders"

# --- cleaning and quality

LINE_RANK = (
    "ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY l_shipdate, l_partkey, l_suppkey)"
)
CLEAN_LINES = f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(TRUNC(l_quantity) AS INTEGER) AS l_quantity, l_extendedprice, l_discount, l_tax,
           lower(l_returnflag) AS l_returnflag, COALESCE(l_linestatus, '?') AS l_linestatus,
           l_shipdate
    FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_shipdate IS NOT NULL AND l_extendedprice IS NOT NULL
      AND l_quantity > 5
    QUALIFY {LINE_RANK} = 1"""
Q["clean_silver"] = CLEAN_LINES
Q["dedupe_keep_first"] = f"SELECT * FROM lineitem QUALIFY {LINE_RANK} = 1"
Q["quality_ledger"] = f"""
    WITH marked AS (
        SELECT *, CASE WHEN l_orderkey IS NULL OR l_shipdate IS NULL OR l_extendedprice IS NULL
                       THEN 0 WHEN NOT COALESCE(l_quantity > 5, FALSE) THEN 1 END AS step
        FROM lineitem
    ),
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber, step IS NULL
                                     ORDER BY l_shipdate, l_partkey, l_suppkey) AS n
        FROM marked
    )
    SELECT CAST(paso AS INTEGER) AS paso, concepto, {_big('filas')} AS filas FROM (
        SELECT 0 AS paso, 'bronze' AS concepto, COUNT(*) AS filas FROM lineitem
        UNION ALL SELECT 1, 'default:l_linestatus', COUNT(*) FROM lineitem
                  WHERE l_linestatus IS NULL
        UNION ALL SELECT 2, 'not_null', COUNT(*) FROM marked WHERE step = 0
        UNION ALL SELECT 3, 'cantidad_minima', COUNT(*) FROM marked WHERE step = 1
        UNION ALL SELECT 4, 'duplicates', COUNT(*) FROM ranked WHERE step IS NULL AND n > 1
        UNION ALL SELECT 5, 'silver', COUNT(*) FROM ranked WHERE step IS NULL AND n = 1
    )"""
Q["quality_summary"] = f"""
    WITH kept AS ({CLEAN_LINES}), b AS (SELECT COUNT(*) AS n FROM lineitem),
    s AS (SELECT COUNT(*) AS n, {_money('l_extendedprice')} AS total FROM kept)
    SELECT b.n AS filas_bronze, s.n AS filas_silver, b.n - s.n AS filas_eliminadas,
           {_pct('s.n', 'b.n', 1)} AS pct_retenido, total AS monto_total
    FROM b, s"""

GAPPED = """
    SELECT * REPLACE (nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority)
    FROM orders"""
Q["filter_not_null"] = f"SELECT * FROM ({GAPPED}) WHERE o_orderpriority IS NOT NULL"
Q["filter_ne_nullsafe"] = f"SELECT * FROM ({GAPPED}) WHERE o_orderpriority IS DISTINCT FROM '5-LOW'"
Q["filter_positive"] = "SELECT * FROM customer WHERE c_acctbal > 0"
Q["filter_lead_time"] = f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST({LEAD} AS INTEGER) AS dias_anticipacion
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {LEAD} >= 0"""
Q["normalise_text"] = """
    SELECT n_nationkey, upper(n_name) AS upper_name, lower(n_name) AS lower_name,
           lower(n_name) AS strip_name
    FROM nation"""
Q["cast_coerce"] = """
    SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS channel,
           CAST(TRUNC(o_totalprice) AS BIGINT) AS whole_price, o_totalprice AS price,
           TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number
    FROM orders"""
Q["cast_strict"] = """
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS channel,
           o_totalprice AS price, CAST(o_orderdate AS DATE) AS day,
           date_trunc('day', o_orderdate) + INTERVAL '10 hours 30 minutes' AS moment,
           o_orderstatus = 'F' AS cancelled
    FROM orders"""
Q["default_nulls"] = f"""
    SELECT * REPLACE (COALESCE(o_orderpriority, '4-CALL CENTER') AS o_orderpriority)
    FROM ({GAPPED})"""
Q["value_map"] = """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSEHOLD'
                                        WHEN 'HOUSEHOLD' THEN 'MACHINERY' ELSE 'TOP' END AS promoted
    FROM customer"""

# --- dimensions, keys and lookups

Q["dim_calendar"] = "WITH" + _spine("""
    SELECT LEAST((SELECT MIN(o_orderdate) FROM orders), (SELECT MIN(l_shipdate) FROM lineitem))
               AS lo,
           GREATEST((SELECT MAX(o_orderdate) FROM orders), (SELECT MAX(l_shipdate) FROM lineitem))
               AS hi""") + " SELECT * FROM cal"
Q["weekday_conventions"] = "WITH" + _spine("""
    SELECT MIN(LEAST(o_orderdate, l_shipdate)) AS lo, MAX(GREATEST(o_orderdate, l_shipdate)) AS hi
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", sunday=True) + """
    SELECT fecha, dia_semana AS desde_domingo,
           CAST(isodow(fecha) - 1 AS INTEGER) AS desde_lunes FROM cal"""
Q["calendar_join"] = f"""
    WITH {EVENTS_CAL}
    SELECT event_id, tiempo_sk, fecha, dia_nombre FROM events JOIN cal ON CAST(ts AS DATE) = fecha"""
Q["surrogate_key"] = """
    SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name, c_mktsegment
    FROM customer"""
Q["two_hop_lookup"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_nationkey
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
         LEFT JOIN customer ON o_custkey = c_custkey"""


def _versions(log: str, key: str, state: str) -> str:
    """CTE body: type-2 versions of ``log`` (key, day, state; one row per key and day)."""
    return f"""
    ordered AS (
        SELECT {key}, day, {state}, LAG({state}) OVER w AS before, ROW_NUMBER() OVER w AS n
        FROM ({log}) WINDOW w AS (PARTITION BY {key} ORDER BY day)
    ),
    changed AS (SELECT * FROM ordered WHERE n = 1 OR {state} IS DISTINCT FROM before),
    versions AS (
        SELECT {key}, {state}, day AS valido_desde,
               COALESCE(CAST(LEAD(day) OVER v - INTERVAL 1 DAY AS DATE), DATE '9999-12-31')
                   AS valido_hasta,
               LEAD(day) OVER v IS NULL AS activo
        FROM changed WINDOW v AS (PARTITION BY {key} ORDER BY day)
    )"""


EVENT_LOG = """
    SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                               ORDER BY ts DESC, event_id DESC) = 1"""
EVENT_VERSIONS = _versions(EVENT_LOG, "user_id", "event_type")

Q["fact_build"] = f"""
    WITH {EVENTS_CAL}, {EVENT_VERSIONS},
    v AS (SELECT *, ROW_NUMBER() OVER (ORDER BY user_id, valido_desde) AS version_sk
          FROM versions),
    k AS (SELECT event_type, ROW_NUMBER() OVER (ORDER BY event_type) AS tipo_sk
          FROM (SELECT DISTINCT event_type FROM events)),
    c AS (SELECT c_custkey, c_nationkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS cliente_sk
          FROM customer),
    n AS (SELECT n_nationkey, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS nacion_sk FROM nation)
    SELECT event_id, tiempo_sk, tipo_sk, cliente_sk, nacion_sk, version_sk, ts, value
    FROM events LEFT JOIN cal ON CAST(ts AS DATE) = fecha
         LEFT JOIN k ON events.event_type = k.event_type
         LEFT JOIN c ON events.user_id = c_custkey
         LEFT JOIN n ON c_nationkey = n_nationkey
         LEFT JOIN v ON events.user_id = v.user_id
                    AND CAST(ts AS DATE) BETWEEN valido_desde AND valido_hasta
    WHERE tiempo_sk IS NOT NULL AND tipo_sk IS NOT NULL AND cliente_sk IS NOT NULL
      AND nacion_sk IS NOT NULL AND version_sk IS NOT NULL"""
SUPPLIED = """
    SELECT event_id, user_id, value, s_suppkey + 1 AS supplier_sk
    FROM events LEFT JOIN supplier ON user_id = s_suppkey"""
Q["orphan_drop"] = f"SELECT * FROM ({SUPPLIED}) WHERE supplier_sk IS NOT NULL"
Q["orphan_report"] = f"""
    SELECT COUNT(*) AS filas, COUNT(*) FILTER (WHERE supplier_sk IS NULL) AS huerfanas,
           COUNT(*) FILTER (WHERE supplier_sk IS NULL) AS sin_supplier_sk
    FROM ({SUPPLIED})"""
Q["union_by_name"] = """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
Q["star_wide_view"] = f"""
    WITH {LINES}
    SELECT reserva_id, price AS precio_pagado, seats AS asientos_reservados,
           discount AS descuento_aplicado, lead AS dias_anticipacion, cancelled AS es_cancelada,
           o_orderdate AS fecha_reserva, CAST(hour(o_orderdate) AS INTEGER) AS hora,
           CAST(o_orderdate AS DATE) AS fecha, CAST(year(o_orderdate) AS INTEGER) AS anio,
           CAST(month(o_orderdate) AS INTEGER) AS mes, strftime(o_orderdate, '%B') AS mes_nombre,
           strftime(o_orderdate, '%A') AS dia_nombre,
           month(o_orderdate) IN (1, 7, 12) AS es_temporada_alta,
           p_name AS numero_vuelo, p_type AS aeronave, p_size AS capacidad_asientos,
           origin AS origen_iata, target AS destino_iata, intl AS internacional_flag,
           origin || '→' || target AS ruta, c_mktsegment AS segmento, n_name AS pais_residencia,
           substr(o_orderpriority, 3) AS canal,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 AS digital_flag
    FROM lines JOIN brands USING (p_brand)"""

# --- slowly changing dimensions

Q["scd2_build"] = f"WITH {EVENT_VERSIONS} SELECT * FROM versions"
Q["scd2_apply"] = Q["scd2_build"]
Q["scd2_stats"] = f"""
    WITH {EVENT_VERSIONS},
    per_id AS (SELECT user_id, COUNT(*) AS n FROM versions GROUP BY user_id)
    SELECT COUNT(*) AS ids, {_big('SUM(n)')} AS versions,
           COUNT(*) FILTER (WHERE n > 1) AS ids_with_history
    FROM per_id"""
Q["scd2_promote"] = """
    WITH changes AS (
        SELECT o_custkey AS id, CAST(MIN(o_orderdate) AS DATE) AS day
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
    ),
    base AS (
        SELECT c_custkey AS id, c_mktsegment AS segmento, c_nationkey,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS promoted
        FROM customer
    ),
    effective AS (
        SELECT base.*, day FROM base LEFT JOIN changes
          ON base.id = changes.id AND promoted <> segmento
    )
    SELECT id, segmento, c_nationkey, DATE '1990-01-01' AS valido_desde,
           COALESCE(CAST(day - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valido_hasta,
           day IS NULL AS activo
    FROM effective
    UNION ALL
    SELECT id, promoted, c_nationkey, day, DATE '9999-12-31', TRUE
    FROM effective WHERE day IS NOT NULL"""

def _promoted(change_days: str, epoch: str) -> str:
    """Versions of customers whose n-th change day promotes their segment n times."""
    log = f"""
        SELECT c_custkey AS id, CASE
            WHEN COALESCE(nth, 0) = 0 THEN c_mktsegment
            WHEN c_mktsegment = 'BUILDING' AND nth = 1 THEN 'HOUSEHOLD'
            ELSE 'MACHINERY' END AS segmento, COALESCE(c.day, opening) AS day
        FROM (
            SELECT customer.*, LEAST(DATE '{epoch}',
                COALESCE(CAST(first_day - INTERVAL 1 DAY AS DATE), DATE '{epoch}')) AS opening
            FROM customer LEFT JOIN (
                SELECT id, MIN(day) AS first_day FROM change_days GROUP BY id) ON id = c_custkey
        ) LEFT JOIN (
            SELECT id, NULL AS day, 0 AS nth FROM (SELECT DISTINCT id FROM change_days)
            UNION ALL
            SELECT id, day, ROW_NUMBER() OVER (PARTITION BY id ORDER BY day) FROM change_days
        ) c ON c.id = c_custkey"""
    return f"""
    WITH change_days AS ({change_days}),
    {_versions(log, 'id', 'segmento')}
    SELECT v.*, c_nationkey FROM versions v JOIN customer ON c_custkey = v.id"""


_CANCELLED_DAYS = """
    SELECT DISTINCT o_custkey AS id, CAST(o_orderdate AS DATE) AS day
    FROM orders WHERE o_orderstatus = 'F'"""
Q["scd2_promote_many"] = _promoted(_CANCELLED_DAYS, "1990-01-01")
Q["scd2_change_before_epoch"] = _promoted(
    f"SELECT id, MIN(day) AS day FROM ({_CANCELLED_DAYS}) GROUP BY id", "1997-01-01"
)
Q["scd2_late_rows"] = Q["scd2_build"]

_PIT = """
    SELECT event_id, events.user_id, ts, v.event_type AS estado, v.valido_desde
    FROM events {how} JOIN versions v ON events.user_id = v.user_id
         AND {at} BETWEEN valido_desde AND valido_hasta"""
Q["pit_join"] = f"WITH {EVENT_VERSIONS}" + _PIT.format(how="LEFT", at="CAST(ts AS DATE)")
Q["pit_join_closed_ts"] = f"WITH {EVENT_VERSIONS}" + _PIT.format(how="INNER", at="ts")
Q["dim_single_version"] = """
    SELECT c_custkey, c_mktsegment, DATE '2020-01-01' AS valido_desde,
           DATE '9999-12-31' AS valido_hasta, TRUE AS activo
    FROM customer"""
Q["semi_changed"] = f"""
    WITH {EVENT_VERSIONS}
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT user_id FROM versions GROUP BY user_id HAVING COUNT(*) > 1)"""


def _segments(table: str, key: str, at: str, confirmed: str) -> str:
    """The segment rule by counting: on a booking's day and on the day it expires, confirmed
    bookings of the year before and of all time."""
    return f"""
    booked AS (
        SELECT {key}, CAST({at} AS DATE) AS dia, COUNT(*) FILTER (WHERE {confirmed}) AS n
        FROM {table} WHERE {key} IS NOT NULL AND {at} IS NOT NULL GROUP BY 1, 2
    ),
    moments AS (
        SELECT {key}, dia FROM booked
        UNION
        SELECT {key}, CAST(dia + INTERVAL 365 DAYS AS DATE) FROM booked WHERE n > 0
    ),
    counted AS (
        SELECT m.{key}, m.dia,
               {_big('SUM(CASE WHEN b.dia = m.dia THEN n ELSE 0 END)')} AS reservas_dia,
               {_big('SUM(CASE WHEN b.dia > m.dia - INTERVAL 365 DAYS THEN n ELSE 0 END)')}
                   AS reservas_12m,
               {_big('SUM(n)')} AS reservas_total
        FROM moments m JOIN booked b ON b.{key} = m.{key} AND b.dia <= m.dia
        GROUP BY 1, 2
    ),
    rolling AS (
        SELECT *, CASE WHEN reservas_12m > 5 THEN 'frecuente'
                       WHEN reservas_total <= 1 THEN 'nuevo' ELSE 'ocasional' END AS segmento
        FROM counted
    )"""


ROLLING = _segments("orders", "o_custkey", "o_orderdate", "o_orderstatus <> 'F'")
Q["rolling_segment"] = f"WITH {ROLLING} SELECT * FROM rolling"
SEGMENT_LOG = "SELECT o_custkey, dia AS day, segmento FROM rolling"
SEGMENTED = f"{ROLLING}, {_versions(SEGMENT_LOG, 'o_custkey', 'segmento')}"
Q["revenue_by_segment_asof"] = f"""
    WITH {SEGMENTED}
    SELECT segmento, COUNT(*) AS reservas, {_money('o_totalprice')} AS ingresos
    FROM orders o JOIN versions v ON o.o_custkey = v.o_custkey
         AND CAST(o_orderdate AS DATE) BETWEEN valido_desde AND valido_hasta
    GROUP BY segmento"""
Q["promotion_rate"] = f"""
    WITH {SEGMENTED},
    following AS (
        SELECT *, LEAD(segmento) OVER w AS next_segment, LEAD(valido_desde) OVER w AS next_day
        FROM versions WINDOW w AS (PARTITION BY o_custkey ORDER BY valido_desde)
    ),
    per_id AS (
        SELECT o_custkey,
               bool_or(COALESCE(next_segment = 'frecuente'
                                AND next_day < valido_desde + INTERVAL 12 MONTH, FALSE)) AS promoted
        FROM following WHERE segmento = 'ocasional' GROUP BY o_custkey
    )
    SELECT COUNT(*) AS ids, COUNT(*) FILTER (WHERE promoted) AS promovidos,
           {_pct('COUNT(*) FILTER (WHERE promoted)', 'COUNT(*)', 2)} AS tasa_promocion_pct
    FROM per_id"""
Q["pre_post_change"] = f"""
    WITH {SEGMENTED},
    chain AS (
        SELECT *, COUNT(*) OVER (PARTITION BY o_custkey) AS n,
               CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY valido_desde) AS INTEGER)
                   AS version
        FROM versions
    )
    SELECT o.o_custkey, version, segmento, COUNT(*) AS reservas,
           {_money('o_totalprice')} AS ingresos, {_mean('o_totalprice')} AS ticket_promedio
    FROM orders o JOIN chain c ON o.o_custkey = c.o_custkey AND n > 1
         AND CAST(o_orderdate AS DATE) BETWEEN valido_desde AND valido_hasta
    GROUP BY ALL"""

# --- declared tests


def _check(kind: str, table: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{kind}' AS prueba, '{table}' AS tabla, '{column}' AS columna,"
        f" {_big(f'({failures})')} AS fallos"
    )


def _nulls(table: str, column: str, source: str | None = None) -> str:
    sql = f"SELECT COUNT(*) FROM {source or table} WHERE {column} IS NULL"
    return _check("not_null", table, column, sql)


def _dups(table: str, *columns: str, source: str | None = None) -> str:
    keys = ", ".join(columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    sql = (
        f"SELECT COUNT(*) FROM (SELECT {keys} FROM {source or table} WHERE {present}"
        f" GROUP BY {keys} HAVING COUNT(*) > 1)"
    )
    return _check("unique", table, "+".join(columns), sql)


def _lost(table: str, column: str, parent: str, parent_column: str) -> str:
    sql = (
        f"SELECT COUNT(*) FROM {table} c WHERE {column} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    )
    return _check("relationships", table, column, sql)


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


Q["dq_not_null"] = _all(
    _nulls("orders", "o_orderkey"), _nulls("orders", "o_orderpriority", f"({GAPPED})"),
    _nulls("lineitem", "l_orderkey"), _nulls("lineitem", "l_shipdate"),
    _nulls("customer", "c_custkey"),
)
Q["dq_unique"] = _all(
    _dups("orders", "o_orderkey"), _dups("orders", "o_orderpriority", source=f"({GAPPED})"),
    _dups("lineitem", "l_orderkey", "l_linenumber"), _dups("customer", "c_custkey"),
)
Q["dq_relationships"] = _all(
    _lost("events", "user_id", "supplier", "s_suppkey"),
    _lost("orders", "o_custkey", "customer", "c_custkey"),
    _lost("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _lost("customer", "c_nationkey", "nation", "n_nationkey"),
)

# --- silver and gold from raw tables

DEPARTURES = "SELECT l_partkey, MAX(l_shipdate) AS departure FROM lineitem GROUP BY l_partkey"
SILVER = f"""
    silver_rutas AS (
        SELECT DISTINCT p_brand AS ruta_id, 'A' || {ROUTE_FROM} AS origen_iata,
               'City A' || {ROUTE_FROM} AS origen_ciudad, 'B' || ({BRAND} % 10) AS destino_iata,
               'City B' || ({BRAND} % 10) AS destino_ciudad,
               CAST({BRAND} * 100 AS INTEGER) AS distancia_km, {BRAND} % 5 = 0 AS internacional_flag
        FROM part
    ),
    silver_canales AS (
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS canal_id,
               upper(substr(o_orderpriority, 3)) AS nombre,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 AS digital_flag,
               CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2
                    THEN 'online' ELSE 'presencial' END AS categoria
        FROM orders
    ),
    silver_vuelos AS (
        SELECT p_partkey AS vuelo_id, p_name AS numero_vuelo, p_brand AS ruta_id,
               departure AS fecha_vuelo, p_type AS aeronave, p_size AS capacidad_asientos,
               'Line ' || ({BRAND} % 3) AS aerolinea
        FROM part JOIN ({DEPARTURES}) ON p_partkey = l_partkey
    ),
    silver_pasajeros AS (
        SELECT c_custkey AS pasajero_id, upper(n_name) AS pais_residencia,
               lower(c_mktsegment) AS segmento, CAST(NULL AS TIMESTAMP) AS fecha_alta
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    ),
    bookings AS (
        SELECT 'RES-' || l_orderkey || '-' || l_linenumber AS reserva_id,
               o_custkey AS pasajero_id, l_partkey AS vuelo_id,
               CAST(COALESCE(substr(nullif(o_orderpriority, '4-NOT SPECIFIED'), 1, 1), '4')
                    AS INTEGER) AS canal_id,
               o_orderdate AS fecha_reserva, l_shipdate AS fecha_vuelo_pretendida,
               CAST({LEAD} AS INTEGER) AS dias_anticipacion, l_extendedprice AS precio_pagado,
               CAST(l_quantity AS INTEGER) AS asientos_reservados,
               l_discount AS descuento_aplicado, {CANCEL} AS es_cancelada,
               CASE WHEN o_orderstatus = 'F' THEN 'CANCELADA' ELSE 'CONFIRMADA' END AS estado
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ),
    silver_reservas AS (
        SELECT * FROM bookings WHERE precio_pagado > 0 AND dias_anticipacion >= 0
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY reserva_id
            ORDER BY fecha_reserva, pasajero_id, vuelo_id, canal_id, fecha_vuelo_pretendida,
                     dias_anticipacion, precio_pagado, asientos_reservados, descuento_aplicado
        ) = 1
    ),
    silver_pagos AS (
        SELECT o_orderkey AS pago_id, 'RES-' || o_orderkey || '-1' AS reserva_id,
               upper(substr(o_orderpriority, 3)) AS medio_pago, upper(o_orderstatus) AS estado_pago,
               o_totalprice AS monto
        FROM orders WHERE o_totalprice > 0
    )"""
for _name in ("rutas", "canales", "vuelos", "pasajeros", "reservas", "pagos"):
    Q[f"silver_{_name}"] = f"WITH {SILVER} SELECT * FROM silver_{_name}"

Q["booking_ledger"] = f"""
    WITH {SILVER},
    gap AS (SELECT COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE o_orderpriority = '4-NOT SPECIFIED'),
    steps AS (
        SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE precio_pagado <= 0) AS price,
               COUNT(*) FILTER (WHERE precio_pagado > 0 AND dias_anticipacion < 0) AS lead,
               COUNT(*) FILTER (WHERE precio_pagado > 0 AND dias_anticipacion >= 0) AS alive
        FROM bookings
    ),
    kept AS (SELECT COUNT(*) AS n FROM silver_reservas)
    SELECT CAST(paso AS INTEGER) AS paso, concepto, {_big('filas')} AS filas FROM (
        SELECT 0 AS paso, 'bronze' AS concepto, total AS filas FROM steps
        UNION ALL SELECT 1, 'default:canal_id', n FROM gap
        UNION ALL SELECT 2, 'default:descuento_aplicado', 0
        UNION ALL SELECT 3, 'default:es_cancelada', 0
        UNION ALL SELECT 4, 'not_null', 0
        UNION ALL SELECT 5, 'precio_no_positivo', price FROM steps
        UNION ALL SELECT 6, 'anticipacion_negativa', lead FROM steps
        UNION ALL SELECT 7, 'duplicates', alive - n FROM steps, kept
        UNION ALL SELECT 8, 'silver', n FROM kept
    )"""

_CHANGE_LOG = """
    SELECT * FROM (
        SELECT pasajero_id, DATE '1990-01-01' AS day, segmento FROM silver_pasajeros
        UNION ALL
        SELECT r.pasajero_id, dia,
               CASE WHEN r.segmento = 'frecuente' THEN r.segmento ELSE p.segmento END
        FROM rolling r JOIN silver_pasajeros p ON r.pasajero_id = p.pasajero_id
    )"""
_LOGGED = f"""
    {_segments('silver_reservas', 'pasajero_id', 'fecha_reserva', 'es_cancelada = 0')},
    {_versions(_CHANGE_LOG, 'pasajero_id', 'segmento')}"""
_SPLIT = "@versions@"
_STAR = f"""{SILVER},
    {_SPLIT},
    {_spine('''
        SELECT LEAST((SELECT MIN(fecha_reserva) FROM silver_reservas),
                     (SELECT MIN(fecha_vuelo) FROM silver_vuelos)) AS lo,
               GREATEST((SELECT MAX(fecha_vuelo_pretendida) FROM silver_reservas),
                        (SELECT MAX(fecha_vuelo) FROM silver_vuelos)) AS hi''', 'dim_tiempo')},
    dim_vuelo AS (
        SELECT ROW_NUMBER() OVER (ORDER BY vuelo_id) AS vuelo_sk, * FROM silver_vuelos
    ),
    dim_ruta AS (SELECT ROW_NUMBER() OVER (ORDER BY ruta_id) AS ruta_sk, * FROM silver_rutas),
    dim_canal AS (
        SELECT ROW_NUMBER() OVER (ORDER BY canal_id) AS canal_sk, * FROM silver_canales
    ),
    dim_pasajero AS (
        SELECT ROW_NUMBER() OVER (ORDER BY v.pasajero_id, valido_desde) AS pasajero_sk,
               v.pasajero_id, v.segmento, pais_residencia, fecha_alta, valido_desde, valido_hasta,
               activo
        FROM versions v JOIN silver_pasajeros p ON v.pasajero_id = p.pasajero_id
    ),
    fact_reservas AS (
        SELECT reserva_id, tiempo_sk, vuelo_sk, ruta_sk, pasajero_sk, canal_sk, fecha_reserva,
               fecha_vuelo_pretendida, precio_pagado, asientos_reservados, descuento_aplicado,
               dias_anticipacion, es_cancelada
        FROM silver_reservas r
             JOIN dim_tiempo t ON CAST(fecha_reserva AS DATE) = t.fecha
             JOIN dim_vuelo v ON r.vuelo_id = v.vuelo_id
             JOIN dim_ruta u ON v.ruta_id = u.ruta_id
             JOIN dim_canal c ON r.canal_id = c.canal_id
             JOIN dim_pasajero p ON r.pasajero_id = p.pasajero_id
                  AND CAST(fecha_reserva AS DATE) BETWEEN valido_desde AND valido_hasta
    )"""
GOLD = _STAR.replace(_SPLIT, _LOGGED)
for _name in ("dim_tiempo", "dim_vuelo", "dim_ruta", "dim_canal", "dim_pasajero", "fact_reservas"):
    Q[f"gold_{_name}"] = f"WITH {GOLD} SELECT * FROM {_name}"
Q["gold_monthly"] = f"""
    WITH {GOLD}
    SELECT anio, trimestre, mes, mes_nombre, COUNT(*) AS reservas,
           {_money('precio_pagado')} AS ingresos_cop, {_mean('precio_pagado')} AS ticket_promedio,
           {_big('SUM(es_cancelada)')} AS canceladas,
           {_pct('SUM(es_cancelada)', 'COUNT(*)', 2)} AS tasa_cancel_pct
    FROM fact_reservas JOIN dim_tiempo USING (tiempo_sk) GROUP BY ALL"""
Q["gold_utilisation"] = f"""
    WITH {GOLD},
    sold AS (
        SELECT ruta_sk, SUM(asientos_reservados) AS sold
        FROM fact_reservas JOIN dim_tiempo USING (tiempo_sk)
        WHERE fecha >= DATE '2000-01-01' AND es_cancelada = 0 GROUP BY ruta_sk
    ),
    capacity AS (
        SELECT ruta_id, SUM(capacidad_asientos) AS seats FROM dim_vuelo
        WHERE fecha_vuelo >= DATE '2000-01-01' GROUP BY ruta_id
    )
    SELECT origen_iata || '→' || destino_iata AS ruta, internacional_flag,
           {_big('sold')} AS asientos_vendidos, {_big('seats')} AS asientos_disponibles,
           {_pct('sold', 'seats', 1)} AS ocupacion_pct
    FROM sold JOIN dim_ruta USING (ruta_sk) JOIN capacity USING (ruta_id)"""
Q["gold_lead_time"] = f"""
    WITH {GOLD}
    SELECT es_temporada_alta, segmento, COUNT(*) AS reservas,
           ROUND(AVG(dias_anticipacion), 1) AS dias_anticipacion_avg,
           ROUND({_mean('precio_pagado')}, 0) AS ticket_promedio
    FROM fact_reservas JOIN dim_tiempo USING (tiempo_sk) JOIN dim_pasajero USING (pasajero_sk)
    WHERE es_cancelada = 0 GROUP BY ALL"""

Q["gold_conversion"] = f"""
    WITH {GOLD}
    SELECT nombre AS canal, digital_flag, COUNT(*) AS total_reservas,
           {_big('SUM(1 - es_cancelada)')} AS confirmadas,
           {_big('SUM(es_cancelada)')} AS canceladas,
           {_pct('SUM(1 - es_cancelada)', 'COUNT(*)', 2)} AS conversion_pct,
           {_money('precio_pagado')} AS ingresos_cop
    FROM fact_reservas JOIN dim_canal USING (canal_sk) GROUP BY nombre, digital_flag"""
Q["gold_top_routes"] = f"""
    WITH {GOLD}
    SELECT origen_iata || '→' || destino_iata AS ruta, internacional_flag,
           {_money('precio_pagado')} / 1e6 AS "ingresos_M_COP",
           {_big('SUM(asientos_reservados)')} AS asientos
    FROM fact_reservas JOIN dim_ruta USING (ruta_sk) WHERE es_cancelada = 0
    GROUP BY ALL ORDER BY 3 DESC, ruta LIMIT 10"""
Q["gold_kpi_row"] = f"""
    WITH {GOLD}, confirmed AS (SELECT * FROM fact_reservas WHERE es_cancelada = 0)
    SELECT (SELECT {_pct('SUM(es_cancelada)', 'COUNT(*)', 2)} FROM fact_reservas)
               AS tasa_cancelacion_pct,
           (SELECT ROUND({_mean('precio_pagado')}, 0) FROM confirmed) AS ticket_promedio,
           (SELECT ROUND(AVG(dias_anticipacion), 1) FROM confirmed) AS ventana_media_dias,
           (SELECT {_money('precio_pagado')} / 1e9 FROM confirmed) AS "ingresos_total_B_COP",
           (SELECT COUNT(*) FROM fact_reservas) AS total_reservas,
           (SELECT COUNT(*) FROM confirmed) AS confirmadas"""
_SEGMENT_SHARES = ", ".join(
    f"ROUND(CAST(SUM(1 - es_cancelada) FILTER (WHERE segmento = '{s}') AS DOUBLE) * 100"
    f" / NULLIF(COUNT(*) FILTER (WHERE segmento = '{s}'), 0), 1) AS {s}"
    for s in ("frecuente", "automobile", "building", "furniture", "household", "machinery")
)
Q["gold_channel_segment"] = f"""
    WITH {GOLD}
    SELECT nombre AS canal, {_SEGMENT_SHARES}
    FROM fact_reservas JOIN dim_canal USING (canal_sk) JOIN dim_pasajero USING (pasajero_sk)
    GROUP BY nombre"""
Q["gold_route_count_since"] = f"""
    WITH {GOLD}
    SELECT origen_iata || '→' || destino_iata AS ruta, COUNT(*) AS reservas
    FROM fact_reservas JOIN dim_ruta USING (ruta_sk) JOIN dim_tiempo USING (tiempo_sk)
    WHERE fecha >= DATE '2000-01-01' GROUP BY 1"""
Q["gold_wide_view"] = f"""
    WITH {GOLD}
    SELECT reserva_id, precio_pagado, asientos_reservados, descuento_aplicado,
           dias_anticipacion, es_cancelada, fecha_reserva,
           CAST(hour(fecha_reserva) AS INTEGER) AS hora, fecha, anio, mes, mes_nombre, dia_nombre,
           es_temporada_alta, numero_vuelo, aeronave, capacidad_asientos, origen_iata,
           destino_iata, internacional_flag, origen_iata || '→' || destino_iata AS ruta,
           segmento, pais_residencia, nombre AS canal, digital_flag
    FROM fact_reservas JOIN dim_tiempo USING (tiempo_sk) JOIN dim_vuelo USING (vuelo_sk)
         JOIN dim_ruta USING (ruta_sk) JOIN dim_pasajero USING (pasajero_sk)
         JOIN dim_canal USING (canal_sk)"""

# Two snapshots: the segment of customers in debt is another one until the second.
_SNAPSHOTS = """
    SELECT pasajero_id, DATE '1990-01-01' AS day,
           CASE WHEN c_acctbal < 0 THEN 'building' ELSE segmento END AS segmento
    FROM silver_pasajeros JOIN customer ON c_custkey = pasajero_id
    UNION ALL
    SELECT pasajero_id, DATE '2000-01-01', segmento FROM silver_pasajeros"""
GROWN = _STAR.replace(_SPLIT, _versions(_SNAPSHOTS, "pasajero_id", "segmento"))
Q["gold_incremental"] = Q["gold_wide_view"].replace(GOLD, GROWN)
Q["gold_incremental_pasajero"] = f"""
    WITH {GROWN}
    SELECT CASE WHEN first THEN ROW_NUMBER() OVER (PARTITION BY first ORDER BY pasajero_id)
                ELSE (SELECT COUNT(*) FROM silver_pasajeros)
                     + ROW_NUMBER() OVER (PARTITION BY first ORDER BY pasajero_id)
           END AS pasajero_sk, * EXCLUDE (first, pasajero_sk)
    FROM (SELECT *, valido_desde = DATE '1990-01-01' AS first FROM dim_pasajero)"""
Q["gold_quarantine"] = f"""
    WITH {SILVER}
    SELECT reserva_id, motivo, pasajero_id, vuelo_id, canal_id,
           strftime(fecha_reserva, '%Y-%m') AS anio_mes
    FROM silver_reservas JOIN part ON p_partkey = vuelo_id,
         (VALUES ('sin_vuelo_sk'), ('sin_ruta_sk')) reasons(motivo)
    WHERE fecha_reserva < DATE '2000-01-01' AND p_size > 40"""
Q["stable_keys"] = """
    SELECT CASE WHEN c_acctbal < 0 THEN 0 ELSE (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0) END
           + ROW_NUMBER() OVER (PARTITION BY c_acctbal < 0 ORDER BY c_custkey) AS c_sk, c_custkey
    FROM customer"""
Q["snapshot_changes"] = """
    WITH then_ AS (
        SELECT * REPLACE (CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 'O'
                               ELSE o_orderstatus END AS o_orderstatus)
        FROM orders WHERE o_orderdate < DATE '2000-01-01'
    ),
    now_ AS (SELECT * FROM orders WHERE o_orderdate >= DATE '1996-01-01')
    SELECT 'insert' AS cambio, * FROM now_ WHERE o_orderkey NOT IN (SELECT o_orderkey FROM then_)
    UNION ALL
    SELECT 'delete', * FROM then_ WHERE o_orderkey NOT IN (SELECT o_orderkey FROM now_)
    UNION ALL
    SELECT 'update', n.* FROM now_ n JOIN then_ t ON n.o_orderkey = t.o_orderkey
    WHERE n.o_orderstatus <> t.o_orderstatus"""

Q["published_views"] = """
    SELECT c_mktsegment, n_name, COUNT(*) AS clientes
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""

_DIM_KEYS = {
    "dim_tiempo": ("tiempo_sk", "fecha"), "dim_vuelo": ("vuelo_sk", "vuelo_id"),
    "dim_ruta": ("ruta_sk", "ruta_id"), "dim_canal": ("canal_sk", "canal_id"),
}
_SKS = ("tiempo_sk", "vuelo_sk", "ruta_sk", "pasajero_sk", "canal_sk")
Q["gold_checks"] = f"WITH {GOLD} " + _all(
    *[_nulls(t, c) for t, cs in _DIM_KEYS.items() for c in cs],
    *[_dups(t, c) for t, cs in _DIM_KEYS.items() for c in cs],
    _nulls("dim_pasajero", "pasajero_sk"), _dups("dim_pasajero", "pasajero_sk"),
    _nulls("dim_pasajero", "pasajero_id"),
    _nulls("fact_reservas", "reserva_id"), _dups("fact_reservas", "reserva_id"),
    *[_nulls("fact_reservas", k) for k in _SKS],
    *[_lost("fact_reservas", k, "dim_" + k.removesuffix("_sk"), k) for k in _SKS],
    _nulls("fact_reservas", "precio_pagado"),
)


def oracle_sql() -> dict[str, str]:
    return dict(Q)
