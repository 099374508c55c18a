"""SQL for DuckDB that gives the result of each query from the same tables."""

from __future__ import annotations

_LINES = """
lines AS (
    SELECT concat_ws('-', l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE)) AS remessa,
           l_suppkey, l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
           CAST(l_shipdate AS DATE) AS shipped,
           l_linenumber AS n, l_linenumber - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS n_wind,
           round(l_discount * 100) AS discount, round(l_extendedprice * 100) AS cents,
           l_tax, l_quantity, l_partkey, l_linestatus, l_returnflag,
           CASE WHEN l_linestatus = 'F' THEN '°F' ELSE '°C' END AS unit_temperature_2m
    FROM lineitem
), positions AS (
    SELECT lines.*, CAST(unnest(range(n)) AS INTEGER) AS idx FROM lines
), readings AS (
    SELECT *, shipped + CAST(idx // 4 AS INTEGER) AS data,
           CAST(shipped + CAST(idx // 4 AS INTEGER) AS TIMESTAMP)
               + to_hours(CAST(idx % 4 * 6 AS BIGINT)) AS time,
           CASE WHEN l_tax <> 0 OR idx > 0 THEN l_quantity + idx END AS relativehumidity_2m,
           cents - idx AS temperature_2m,
           discount * (idx + 1) AS windspeed_10m
    FROM positions
), wide AS (
    SELECT * FROM readings WHERE discount <> 10 AND idx < n_wind
)"""

# The same over documents without copies.
_DISTINCT_LINES = _LINES.replace("SELECT concat_ws", "SELECT DISTINCT concat_ws")

_TIME_COLUMNS = """l_suppkey AS codigo_ibge, ano, mes, remessa, idx, time, l_quantity AS elevation,
    CAST(l_partkey AS DOUBLE) AS latitude, l_tax AS longitude, l_linestatus AS timezone,
    l_returnflag AS timezone_abbreviation, CAST(n * -3600 AS BIGINT) AS utc_offset_seconds"""

_HUMIDITY = f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, relativehumidity_2m, '%' AS unit_relativehumidity_2m
FROM readings WHERE discount <> 10"""

_TEMPERATURE = f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, temperature_2m, unit_temperature_2m FROM readings"""

_DISTINCT_WIND = f"""WITH {_DISTINCT_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, windspeed_10m, 'km/h' AS unit_windspeed_10m
FROM readings WHERE idx < n_wind"""

_WIND = _DISTINCT_WIND.replace("SELECT DISTINCT", "SELECT")

_WIDE = f"""WITH {_LINES}
SELECT {_TIME_COLUMNS}, relativehumidity_2m, '%' AS unit_relativehumidity_2m, temperature_2m, unit_temperature_2m,
    windspeed_10m, 'km/h' AS unit_windspeed_10m
FROM wide"""

_MEASURES = """AVG(relativehumidity_2m) AS humidade_relativa_media,
    MIN(relativehumidity_2m) AS humidade_relativa_minima, MAX(relativehumidity_2m) AS humidade_relativa_maxima,
    AVG(temperature_2m) AS temperatura_media,
    MIN(temperature_2m) AS temperatura_minima, MAX(temperature_2m) AS temperatura_maxima,
    AVG(windspeed_10m) AS velocidade_do_vento_media,
    MIN(windspeed_10m) AS velocidade_do_vento_minima, MAX(windspeed_10m) AS velocidade_do_vento_maxima"""

_DAILY = f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, data, {_MEASURES}
FROM wide GROUP BY l_suppkey, data"""

_DISTINCT_DAILY = _DAILY.replace("SELECT concat_ws", "SELECT DISTINCT concat_ws")

_DAILY_BY_YEAR = f"""WITH {_DISTINCT_LINES}
SELECT l_suppkey AS codigo_ibge, data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
    {_MEASURES}
FROM wide {{where}} GROUP BY l_suppkey, data"""

# The first reading of each document of one month is dated five years back.
_STRAY = _DAILY_BY_YEAR.format(where="").replace(
    "SELECT *, shipped + CAST(idx // 4 AS INTEGER) AS data",
    "SELECT *, CASE WHEN idx = 0 AND ano = 1998 AND mes = 7 THEN DATE '1993-07-01' ELSE shipped + CAST(idx // 4 AS INTEGER) END AS data",
)

_MONTHS = f"""WITH docs AS (
    SELECT c_custkey, c_acctbal, make_date(2008 + c_custkey % 3, 1 + c_custkey // 3 % 12, 1) AS first FROM customer
), readings AS (
    SELECT *, CAST(unnest(range(24 * day(last_day(first)))) AS INTEGER) AS idx FROM docs WHERE c_custkey % 10 <> 0
), wide AS (
    SELECT c_custkey AS codigo_ibge, first + CAST(idx // 24 AS INTEGER) AS data,
           CASE WHEN c_custkey % 3 <> 0 OR idx % 5 <> 0 THEN CAST((c_custkey * 7 + idx) % 100 AS DOUBLE) END AS relativehumidity_2m,
           round(c_acctbal * 100) - idx AS temperature_2m, CAST(idx % 30 AS DOUBLE) AS windspeed_10m
    FROM readings
)
SELECT codigo_ibge, CAST(data AS DATE) AS data, {_MEASURES} FROM wide {{where}} GROUP BY codigo_ibge, CAST(data AS DATE)"""

_DIMENSION = """
    SELECT DISTINCT c_custkey AS codigo_ibge, c_name AS nome, c_acctbal AS latitude, c_acctbal / 2 AS longitude,
           nullif(c_nationkey, 0) = 1 AS e_capital, concat('N', n_nationkey) AS uf, n_name AS nome_estado,
           r_name AS regiao
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_TRUSTED = f"""WITH dimension AS ({_DIMENSION})
SELECT codigo_ibge, nome, e_capital, uf, nome_estado, regiao FROM dimension"""

# Per supplier and hour, the reading of the last document that holds it.
_SETTLED = f"""{_LINES}, settled AS (
    SELECT * FROM wide QUALIFY row_number() OVER (PARTITION BY l_suppkey, time ORDER BY ano DESC, mes DESC, remessa DESC, idx DESC) = 1
)"""

_HISTORY = """history AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderkey AS codigo_ibge, o_orderdate AS time,
           o_totalprice AS valor, o_orderpriority AS prioridade
    FROM orders
)"""

_UPSERT = f"""WITH {_HISTORY}, old AS (
    SELECT * FROM history WHERE CAST(time AS DATE) <= DATE '1998-12-31'
), new AS (
    SELECT ano, codigo_ibge, time, MAX(valor) + 1 AS valor, MAX(prioridade) AS prioridade
    FROM history WHERE CAST(time AS DATE) >= DATE '1998-01-01' GROUP BY ano, codigo_ibge, time
)
SELECT old.ano, old.codigo_ibge, old.time, COALESCE(new.valor, old.valor) AS valor,
    COALESCE(new.prioridade, old.prioridade) AS prioridade
FROM old LEFT JOIN new ON new.codigo_ibge = old.codigo_ibge AND new.time = old.time
UNION ALL
SELECT ano, codigo_ibge, time, valor, prioridade FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.codigo_ibge = new.codigo_ibge AND old.time = new.time)"""


# The address of a request, which must be the same text on both sides.
def _requests(periods: str, last: str, directory: str, period_columns: str, where: str = "") -> str:
    return f"""WITH dimension AS ({_DIMENSION}), periods AS ({periods}), requests AS (
    SELECT codigo_ibge, regiao, {period_columns}, first AS data_inicial, CAST({last} AS DATE) AS data_final,
           'raw/clima/' || strftime(first, '{directory}') AS prefixo, latitude, longitude
    FROM dimension, periods {where}
)
SELECT * EXCLUDE (latitude, longitude),
    'https://archive-api.open-meteo.com/v1/era5?latitude=' || CAST(latitude AS VARCHAR)
    || '&longitude=' || CAST(longitude AS VARCHAR)
    || '&start_date=' || strftime(data_inicial, '%Y-%m-%d') || '&end_date=' || strftime(data_final, '%Y-%m-%d')
    || '&hourly=temperature_2m,relativehumidity_2m,windspeed_10m&timezone=America/Sao_Paulo' AS url
FROM requests"""


def _months(first: str, last: str) -> str:
    return f"""SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 MONTH)) AS DATE) AS first"""


_YEAR_MONTH = "CAST(year(first) AS INTEGER) AS ano, CAST(month(first) AS INTEGER) AS mes"

ORACLES: dict[str, str] = {
    "explode_time": f"WITH {_LINES} SELECT {_TIME_COLUMNS} FROM readings",
    "explode_humidity": _HUMIDITY,
    "explode_temperature": _TEMPERATURE,
    "explode_wind": _WIND,
    "component_tables": f"""WITH {_LINES}, tables AS (
    SELECT 'temporalidade' AS tabela, l_suppkey FROM readings
    UNION ALL SELECT 'humidade', l_suppkey FROM readings WHERE discount <> 10
    UNION ALL SELECT 'temperatura', l_suppkey FROM readings
    UNION ALL SELECT 'velocidade_do_vento', l_suppkey FROM readings WHERE idx < n_wind
)
SELECT tabela, l_suppkey AS codigo_ibge, COUNT(*) AS linhas FROM tables GROUP BY tabela, l_suppkey""",
    "hourly_wide": _WIDE,
    "hourly_wide_range": f"{_WIDE} WHERE data BETWEEN DATE '1996-03-01' AND DATE '1998-02-28'",
    "distinct_documents": _DISTINCT_WIND,
    "distinct_rows": f"""WITH {_LINES}
SELECT DISTINCT l_suppkey AS codigo_ibge, idx, windspeed_10m, 'km/h' AS unit_windspeed_10m
FROM readings WHERE idx < n_wind""",
    "latest_documents": f"""WITH {_LINES}
SELECT DISTINCT l_suppkey AS codigo_ibge, ano, mes, remessa, l_quantity + 1 AS elevation, 'b' AS documento
FROM lines""",
    "daily_rollup": _DAILY,
    "daily_rollup_range": f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, data, {_MEASURES}
FROM wide WHERE data BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY l_suppkey, data""",
    "daily_rollup_components": _DISTINCT_DAILY,
    # The joined rows themselves: every document of an order meets every other one.
    "daily_rollup_by_position": f"""WITH {_LINES}
SELECT t.l_orderkey AS codigo_ibge, t.data, {_MEASURES}
FROM (SELECT l_orderkey, idx, data FROM readings) t
JOIN (SELECT l_orderkey, idx, relativehumidity_2m FROM readings WHERE discount <> 10) h
    ON h.idx = t.idx AND h.l_orderkey = t.l_orderkey
JOIN (SELECT l_orderkey, idx, temperature_2m FROM readings) c ON c.idx = t.idx AND c.l_orderkey = t.l_orderkey
JOIN (SELECT l_orderkey, idx, windspeed_10m FROM readings WHERE idx < n_wind) w
    ON w.idx = t.idx AND w.l_orderkey = t.l_orderkey
GROUP BY t.l_orderkey, t.data""",
    "aligned_components": f"""WITH {_DISTINCT_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, time, relativehumidity_2m, temperature_2m, windspeed_10m
FROM wide""",
    "daily_rollup_events": """
SELECT user_id, CAST(ts AS DATE) AS data, ROUND(AVG(value), 6) AS valor_media,
    MIN(value) AS valor_minima, MAX(value) AS valor_maxima
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "month_documents_daily": _MONTHS.format(where=""),
    "month_documents_range": _MONTHS.format(where="WHERE data BETWEEN DATE '2009-12-20' AND DATE '2010-02-10'"),
    "month_documents_components": _MONTHS.format(where=""),
    "dimension_refined": _DIMENSION,
    "dimension_trusted": _TRUSTED,
    "dimension_annotated": _DIMENSION,
    "dimension_stamps": f"""WITH refined AS ({_DIMENSION})
SELECT CAST(carga AS INTEGER) AS carga, COUNT(*) AS linhas, CAST(1 AS BIGINT) AS carimbos, TRUE AS depois
FROM refined, (VALUES (1), (2)) AS loads(carga) GROUP BY carga""",
    "dimension_by_region": _DIMENSION,
    "hourly_annotated": f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, time AS data_hora, relativehumidity_2m AS humidade_relativa,
    '%' AS unidade_humidade_relativa, temperature_2m AS temperatura, unit_temperature_2m AS unidade_temperatura,
    windspeed_10m AS velocidade_do_vento, 'km/h' AS unidade_velocidade_do_vento, l_quantity AS elevacao,
    CAST(l_partkey AS DOUBLE) AS latitude, l_tax AS longitude, l_linestatus AS fuso_horario, l_returnflag AS abreviacao_fuso_horario,
    CAST(n * -3600 AS BIGINT) AS deslocamento_fuso_horario_em_segundos
FROM wide""",
    "csv_landing": """
SELECT c_custkey AS codigo_ibge, c_name AS nome, c_acctbal AS latitude, c_acctbal / 2 AS longitude,
    nullif(c_nationkey, 0) AS capital, CAST(c_nationkey AS BIGINT) AS codigo_uf, c_custkey AS siafi_id,
    CAST(c_nationkey AS BIGINT) AS ddd, c_mktsegment AS fuso_horario
FROM customer""",
    "csv_declared_prefix": """
SELECT c_custkey AS codigo_ibge, c_name AS nome, c_acctbal AS latitude, c_acctbal / 2 AS longitude,
    nullif(c_nationkey, 0) AS capital, CAST(c_nationkey AS BIGINT) AS codigo_uf
FROM customer""",
    "documents_landing": _HUMIDITY,
    "documents_recursive": _TEMPERATURE,
    "documents_subtree": f"WITH {_LINES} SELECT {_TIME_COLUMNS} FROM readings WHERE ano = 1997",
    "documents_region": f"""{_TEMPERATURE} JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""",
    "documents_quarantine": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes, l_linenumber <> 7 AS lidos,
    COUNT(*) AS registros
FROM lineitem GROUP BY ALL""",
    "documents_compacted": _DISTINCT_WIND,
    "table_years": f"WITH {_HISTORY} SELECT * FROM history WHERE ano IN (1996, 1998)",
    "table_glob": f"WITH {_HISTORY} SELECT * FROM history WHERE ano BETWEEN 1990 AND 1999",
    "partition_overwrite": f"""WITH {_HISTORY}
SELECT ano, codigo_ibge, time, CASE WHEN ano = 1998 THEN valor + 1 ELSE valor END AS valor, prioridade FROM history""",
    "schema_replacement": f"WITH {_HISTORY} SELECT codigo_ibge, prioridade AS valor, ano FROM history",
    "views_cte": f"""WITH {_LINES}
SELECT l_suppkey AS codigo_ibge, unit_temperature_2m AS unidade, idx, MIN(temperature_2m) AS minima,
    MAX(temperature_2m) AS maxima
FROM readings GROUP BY l_suppkey, unit_temperature_2m, idx""",
    "upsert": _UPSERT,
    "upsert_table": _UPSERT,
    "upsert_files": _UPSERT,
    "monthly_requests": _requests(
        _months("1998-01-01", "1998-12-01"), "last_day(first)", "%Y/%m", _YEAR_MONTH
    ),
    "yearly_requests": _requests(
        "SELECT make_date(y, 1, 1) AS first FROM (SELECT unnest(range(1995, 2002)) AS y)",
        "make_date(year(first), 12, 31)",
        "%Y",
        "CAST(year(first) AS INTEGER) AS ano",
    ),
    "selected_requests": _requests(
        _months("2000-02-01", "2000-02-01"), "last_day(first)", "%Y/%m", _YEAR_MONTH, "WHERE NOT e_capital"
    ),
    "pending_requests": f"""WITH dimension AS ({_DIMENSION}), periods AS ({_months("1995-01-01", "2001-12-01")})
SELECT codigo_ibge, {_YEAR_MONTH}, last_day(first) AS data_final, 'raw/clima/' || strftime(first, '%Y/%m') AS prefixo
FROM dimension, periods
WHERE NOT EXISTS (
    SELECT 1 FROM orders
    WHERE o_custkey = codigo_ibge AND year(o_orderdate) = year(first) AND month(o_orderdate) = month(first)
)""",
    "dimension_job": _TRUSTED,
    "backfill_job": _DAILY_BY_YEAR.format(where=""),
    "backfill_years": _DAILY_BY_YEAR.format(where="WHERE year(data) IN (1999, 2000)"),
    "backfill_scattered_years": _DAILY_BY_YEAR.format(where="WHERE year(data) IN (1993, 1996, 1998)"),
    "refresh_stray_reading": _STRAY,
    "refresh_month_job": _DAILY_BY_YEAR.format(where=""),
    "refresh_days_job": _DAILY_BY_YEAR.format(
        where="WHERE NOT (ano = 1996 AND mes = 5 AND l_tax = 0) AND NOT (ano = 1997 AND mes = 2)"
    ),
    "compact_new_files": _DISTINCT_WIND,
    "daily_from_parts": _DAILY,
    "hourly_settled": f"""WITH {_SETTLED}
SELECT l_suppkey AS codigo_ibge, time, ano, mes, remessa, idx, relativehumidity_2m, temperature_2m, windspeed_10m FROM settled""",
    "daily_settled": f"WITH {_SETTLED} SELECT l_suppkey AS codigo_ibge, data, {_MEASURES} FROM settled GROUP BY l_suppkey, data",
    "stacked_tables": f"""WITH {_DISTINCT_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, time, relativehumidity_2m, temperature_2m, windspeed_10m
FROM wide""",
    "bucketed_tables": f"""WITH {_DISTINCT_LINES}
SELECT l_suppkey AS codigo_ibge, ano, mes, remessa, idx, time, relativehumidity_2m, temperature_2m, windspeed_10m
FROM wide""",
    "bucketed_daily": _DISTINCT_DAILY,
    "table_of_two_types": f"""WITH {_HISTORY}
SELECT ano, codigo_ibge, time, CAST(floor(valor) AS DOUBLE) AS valor, prioridade FROM history""",
}
