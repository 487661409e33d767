"""SQL that computes the rows of the check queries, for an independent engine."""

from __future__ import annotations

WORDS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

PAYMENTS = """
payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS tx_id, 'U' || o_custkey AS user_id,
         o_totalprice AS amount, 'EUR' AS currency, n_name AS card_country,
         o_orderpriority AS method, o_orderstatus = 'P' AS flag_ataque,
         o_orderstatus AS order_status
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
"""

ALERTS = PAYMENTS + """,
scored AS (
  SELECT *, CAST(CASE WHEN amount > 400000 THEN 50 ELSE 0 END
         + CASE WHEN card_country IN ('NATION_3', 'NATION_7') THEN 50 ELSE 0 END
         + CASE WHEN method = '1-URGENT' THEN 20 ELSE 0 END AS INTEGER) AS score_fraude
  FROM payments),
alerts AS (
  SELECT tx_id, user_id, amount, card_country, score_fraude,
         CASE WHEN score_fraude >= 100 THEN 'BLOQUEADO'
              WHEN score_fraude >= 50 THEN 'SOSPECHOSO' ELSE 'OK' END AS status,
         order_status
  FROM scored)
"""

ALERT_COLUMNS = "tx_id, user_id, amount, card_country, score_fraude, status"

VISITS = """
visits AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", ts AS event_time,
         CASE WHEN event_type = 'purchase' AND value > 200 THEN 'U' ELSE 'V' END || user_id
           AS user_id,
         '10.' || ((user_id // 4) // 256) || '.' || ((user_id // 4) % 256) || '.'
           || regexp_extract(props, '"k": (\\d+)', 1) AS ip,
         CAST(event_id % 600 AS INTEGER) AS session_duration,
         CAST(floor(value) AS INTEGER) AS pages_visited,
         event_type = 'error' AS is_bot, event_type = 'purchase' AS flag_ataque
  FROM events)
"""

VISIT_COLUMNS = '"timestamp", user_id, ip, session_duration, pages_visited, is_bot, flag_ataque'

BOTS = VISITS + """,
blacklist AS (
  SELECT ip, CASE WHEN max(pages_visited) > 300 THEN 'CRITICO_BOTNET' ELSE 'SOSPECHOSO' END
           AS riesgo_historico
  FROM visits GROUP BY ip HAVING max(pages_visited) > 200),
bots AS (
  SELECT v.user_id, v.ip, v.pages_visited, v."timestamp", b.riesgo_historico
  FROM visits v LEFT JOIN blacklist b ON b.ip = v.ip
  WHERE v.is_bot OR b.riesgo_historico IS NOT NULL)
"""

WINDOWS = VISITS + """,
windows AS (
  SELECT date_trunc('minute', event_time) AS window_start,
         date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
         CAST(count(*) AS INTEGER) AS total_visitas,
         round(avg(pages_visited), 6) AS media_paginas
  FROM visits GROUP BY ALL)
"""

GRAPH = PAYMENTS + "," + VISITS + """,
vertices AS (
  SELECT user_id AS id, 'usuario' AS tipo FROM payments
  UNION SELECT user_id, 'usuario' FROM visits
  UNION SELECT card_country, 'pais' FROM payments
  UNION SELECT ip, 'ip' FROM visits),
edges AS (
  SELECT 'usuario' AS src_tipo, user_id AS src, 'pais' AS dst_tipo, card_country AS dst,
         'pago' AS relacion
  FROM payments
  UNION ALL
  SELECT DISTINCT 'ip', ip, 'usuario', user_id, 'visita' FROM visits),
degrees AS (
  SELECT id, tipo, count(*) AS degree
  FROM (SELECT src AS id, src_tipo AS tipo FROM edges
        UNION ALL SELECT dst, dst_tipo FROM edges)
  GROUP BY ALL)
"""

COMPONENTS = GRAPH + """,
links AS (
  SELECT DISTINCT src_tipo || ':' || src AS a, dst_tipo || ':' || dst AS b FROM edges
  UNION SELECT DISTINCT dst_tipo || ':' || dst, src_tipo || ':' || src FROM edges),
labels_of(k, label) USING KEY (k) AS (
  SELECT tipo || ':' || id, tipo || ':' || id FROM vertices
  UNION
  SELECT l.b, min(f.label)
  FROM labels_of f JOIN links l ON l.a = f.k JOIN recurring.labels_of old ON old.k = l.b
  WHERE f.label < old.label GROUP BY l.b),
members AS (
  SELECT c.label AS component, v.tipo, v.id
  FROM vertices v JOIN labels_of c ON c.k = v.tipo || ':' || v.id),
sizes AS (
  SELECT component, count(*) AS num_entidades FROM members GROUP BY component HAVING count(*) > 2),
ring_rows AS (SELECT m.*, s.num_entidades FROM members m JOIN sizes s USING (component)),
rings AS (SELECT DISTINCT component, num_entidades FROM ring_rows),
severity AS (
  SELECT component, num_entidades,
         CASE WHEN bool_or(contains(upper(id), '10.0.7.') OR contains(upper(id), '10.0.11.'))
                THEN '🔴 CRÍTICO: Red Criminal'
              WHEN bool_or(contains(upper(id), '10.0.2')) THEN '🟠 ALTO: Botnet / Scraper'
              WHEN bool_or(upper(id) IN (SELECT 'NATION_' || i FROM range(20) t(i)))
                THEN '🟢 SEGURO: Geografía Legítima'
              ELSE '🟡 INFO: IP Doméstica Compartida' END AS nivel_amenaza
  FROM ring_rows GROUP BY ALL)
"""

DOCUMENTS = """
docs AS (
  SELECT doc_id, lang AS project_id,
         'data/projects/' || lang || '/docs/' || source || extension AS source,
         CASE WHEN extension = '.pdf' THEN doc_id END AS page, text
  FROM (SELECT *, CASE WHEN source = 'src5' THEN '.md' WHEN length(source) > 4 THEN '.pdf'
                       ELSE '.txt' END AS extension FROM documents))
"""

CHUNKS = DOCUMENTS + """,
chunks AS (
  SELECT doc_id, project_id, source, page, CAST(start // 450 AS INTEGER) AS chunk_no,
         substr(text, start + 1, 500) AS text
  FROM (SELECT *, unnest(range(0, greatest(length(text) - 51, 0) + 1, 450)) AS start
        FROM docs WHERE length(text) > 0))
"""

RETRIEVAL = DOCUMENTS + """,
passages AS (
  SELECT d.doc_id AS chunk_id, d.project_id, d.source, d.page, d.text,
         CAST(e.embedding AS DOUBLE[]) AS vector
  FROM docs d JOIN embeddings e ON e.vec_id = d.doc_id),
asked AS (
  SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS question
  FROM conversations WHERE role = 'user' GROUP BY conv_id),
questions AS (
  SELECT a.conv_id AS query_id, a.turn, a.question, d.project_id, d.source AS own_source,
         list_reverse(CAST(e.embedding AS DOUBLE[])) AS vector
  FROM asked a JOIN docs d ON d.doc_id = a.conv_id JOIN embeddings e ON e.vec_id = a.conv_id)
"""


def _cosine(left: str, right: str, rounded: bool) -> str:
    """To 12 decimals where sums of another order must tie."""
    plain = f"list_cosine_similarity({left}, {right})"
    return f"round(CASE WHEN isnan({plain}) THEN 0 ELSE {plain} END, 12)" if rounded else plain


def _hits(condition: str = "TRUE", rounded: bool = False) -> str:
    return f""",
pairs AS (
  SELECT q.query_id, p.chunk_id, {_cosine("q.vector", "p.vector", rounded)} AS sim
  FROM questions q JOIN passages p ON p.project_id = q.project_id AND {condition}),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id)
         AS INTEGER) AS rank FROM pairs),
hits AS (SELECT * FROM ranked WHERE rank <= 10)
"""


def _gain(rounded: bool) -> str:
    return "round(0.5 * h.sim - 0.5 * max(m.sim), 9)" if rounded else "0.5 * h.sim - 0.5 * max(m.sim)"


def _picks(steps: int = 5, rounded: bool = False) -> str:
    parts = [f""",
among AS (
  SELECT a.query_id, a.chunk_id, b.chunk_id AS other, {_cosine("pa.vector", "pb.vector", rounded)} AS sim
  FROM hits a JOIN hits b ON b.query_id = a.query_id
  JOIN passages pa ON pa.chunk_id = a.chunk_id JOIN passages pb ON pb.chunk_id = b.chunk_id),
picked1 AS (SELECT query_id, chunk_id, rank, 1 AS pick FROM hits WHERE rank = 1)
"""]
    for step in range(2, steps + 1):
        parts.append(f""",
picked{step} AS (
  SELECT * FROM picked{step - 1}
  UNION ALL
  SELECT query_id, chunk_id, rank, {step} FROM (
    SELECT h.query_id, h.chunk_id, h.rank, row_number() OVER (
             PARTITION BY h.query_id ORDER BY {_gain(rounded)} DESC, h.rank) AS best
    FROM hits h
    JOIN among m ON m.query_id = h.query_id AND m.chunk_id = h.chunk_id
    JOIN picked{step - 1} p ON p.query_id = m.query_id AND p.chunk_id = m.other
    WHERE NOT EXISTS (SELECT 1 FROM picked{step - 1} s
                      WHERE s.query_id = h.query_id AND s.chunk_id = h.chunk_id)
    GROUP BY h.query_id, h.chunk_id, h.rank, h.sim)
  WHERE best = 1)
""")
    parts.append(f""",
picks AS (
  SELECT k.query_id, k.chunk_id, k.rank, CAST(k.pick AS INTEGER) AS pick, p.source, p.page, p.text
  FROM picked{steps} k JOIN passages p ON p.chunk_id = k.chunk_id)
""")
    return "".join(parts)


def _sketch(name: str, fitted: str | None = None) -> str:
    """Count sketches of the texts of a table (id, text), with its own weights or those of ``fitted``."""
    weights = f"""
{name}_weights AS (
  SELECT b, CAST(floor(1000 * ln(((SELECT count(*) FROM {name}) + 1) / (count(DISTINCT id) + 1))) AS BIGINT) + 1
    AS weight
  FROM (SELECT unnest(range(256)) AS b) LEFT JOIN {name}_words ON bucket = b GROUP BY b),"""
    return f""",
{name}_words AS (
  SELECT id, ('0x' || md5(word)[1:7])::BIGINT % 256 AS bucket,
         1 - 2 * (('0x' || md5(word)[8:8])::BIGINT % 2) AS sign
  FROM (SELECT id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+')) AS word FROM {name})),{"" if fitted else weights}
{name}_cells AS (
  SELECT id, bucket, CAST(sum(sign) * any_value(weight) AS BIGINT) AS cell
  FROM {name}_words JOIN {fitted or name}_weights ON b = bucket GROUP BY id, bucket),
{name}_grid AS (SELECT id, b FROM {name}, (SELECT unnest(range(256)) AS b)),
{name}_vectors AS (
  SELECT g.id, list(coalesce(cell, 0) ORDER BY b) AS vector
  FROM {name}_grid g LEFT JOIN {name}_cells c ON c.id = g.id AND c.bucket = g.b GROUP BY g.id)
"""


CORPUS_SEARCH = CHUNKS + """,
parts AS (
  SELECT doc_id * 8388608 + chunk_no AS id, project_id, source, page, text FROM chunks
  WHERE source LIKE '%.pdf' OR source LIKE '%.txt'),
last_turns AS (
  SELECT conv_id, arg_max(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY conv_id),
wanted AS (
  SELECT conv_id AS id, d.project_id, question AS text FROM last_turns JOIN docs d ON d.doc_id = conv_id)
""" + _sketch("parts") + _sketch("wanted", "parts") + """,
passages AS (
  SELECT id AS chunk_id, project_id, source, page, text, CAST(vector AS DOUBLE[]) AS vector
  FROM parts JOIN parts_vectors USING (id)),
questions AS (
  SELECT id AS query_id, project_id, CAST(vector AS DOUBLE[]) AS vector FROM wanted JOIN wanted_vectors USING (id))
"""


CONTEXTS = """,
contexts AS (
  SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY pick) AS context
  FROM picks GROUP BY query_id)
"""

FOOTERS = """,
footers AS (
  SELECT query_id, chr(10) || chr(10) || '📚 **Fuentes consultadas:**' || chr(10)
         || array_to_string(list_sort(list_distinct(list(
              '- ' || regexp_extract(source, '[^/]*$')
              || CASE WHEN page IS NULL THEN '' ELSE ' (Pág. ' || page || ')' END))), chr(10))
         AS footer
  FROM picks GROUP BY query_id)
"""

FILE_LISTS = """,
files AS (
  SELECT DISTINCT project_id, regexp_extract(source, '[^/]*$') AS file_name FROM docs
  WHERE (source LIKE '%.pdf' OR source LIKE '%.txt') AND length(text) > 0
    AND project_id <> 'es'),
file_lists AS (
  SELECT p.project_id, count(f.file_name) AS n_files,
         coalesce(string_agg(f.file_name, ', ' ORDER BY f.file_name), 'Ninguno') AS files
  FROM (SELECT DISTINCT project_id FROM docs) p LEFT JOIN files f USING (project_id)
  GROUP BY p.project_id)
"""

RASTERS = """
rasters AS (
  SELECT vec_id AS id, label,
         list_transform(embedding,
           lambda v: CAST(round((CAST(v AS DOUBLE) + 1) * 127.5) AS INTEGER)) AS pixels
  FROM embeddings)
"""


def _unit(purpose: str) -> str:
    """The number in [0, 1) derived from the row id."""
    return f"(('0x' || substr(md5('{purpose}:42:' || id), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _joined(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: CAST(v AS VARCHAR)), ',')"


def _milli(values: str) -> str:
    return _joined(f"list_transform({values}, lambda v: CAST(round(v * 1000) AS BIGINT))")


def _pixel(y: str, x: str) -> str:
    return (
        f"CAST(pixels[CAST(least(greatest({y}, 0), 7) * 8 + least(greatest({x}, 0), 7) AS BIGINT)"
        " + 1] AS DOUBLE)"
    )


PREDICTIONS = """
probabilities AS (
  SELECT model, id, label,
         CASE model WHEN 'long text' THEN least(0.95, greatest(0.05, n_chars / 2000.0::DOUBLE))
                    WHEN 'short text'
                      THEN least(0.95, greatest(0.05, 1 - n_chars / 4000.0::DOUBLE))
                    ELSE 1.0::DOUBLE END AS p
  FROM (SELECT l.doc_id AS id, l.quality AS label, d.n_chars,
               unnest(['long text', 'short text', 'always good']) AS model
        FROM labels l JOIN documents d USING (doc_id))),
predictions AS (
  SELECT *, CAST(CASE WHEN p > 1 - p THEN 1 ELSE 0 END AS INTEGER) AS prediction,
         least(greatest(CASE WHEN label = 1 THEN p ELSE 1 - p END, 1e-7), 1 - 1e-7) AS chosen
  FROM probabilities)
"""

TOKENS = f"len(list_filter(string_split_regex(text, '{WORDS}'), lambda w: w <> ''))"

REMEMBERED = f""",
tokens AS (SELECT *, CAST({TOKENS} AS BIGINT) AS n FROM conversations),
earlier AS (
  SELECT t.*, CAST(sum(n) OVER (PARTITION BY t.conv_id ORDER BY t.turn DESC) AS BIGINT) AS upto
  FROM tokens t JOIN questions q ON q.query_id = t.conv_id AND t.turn < q.turn)
"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


def all_oracles() -> dict[str, str]:
    hits = RETRIEVAL + _hits()
    picks = hits + _picks()
    return {
        "fraud_score": _with(ALERTS, f"SELECT {ALERT_COLUMNS} FROM alerts"),
        "fraud_status_counts": _with(
            ALERTS, "SELECT score_fraude, status, count(*) AS n FROM alerts GROUP BY ALL"
        ),
        "alerts_with_status": _with(
            ALERTS, f"SELECT {ALERT_COLUMNS} FROM alerts WHERE status = 'SOSPECHOSO'"
        ),
        "country_summary": _with(
            PAYMENTS,
            "SELECT card_country, count(*) AS total_transacciones FROM payments "
            "GROUP BY card_country ORDER BY 2 DESC, 1",
        ),
        "soc_kpis": _with(ALERTS, """
SELECT count(*) AS analizadas, count(*) FILTER (status = 'BLOQUEADO') AS bloqueadas,
       round(coalesce(sum(amount) FILTER (status = 'BLOQUEADO'), 0), 2) AS dinero_salvado,
       printf('%.2f', round(coalesce(sum(amount) FILTER (status = 'BLOQUEADO'), 0), 2))
         AS dinero_salvado_texto
FROM alerts"""),
        "blocked_by_country": _with(ALERTS, """
SELECT card_country, count(*) AS bloqueadas FROM alerts WHERE status = 'BLOQUEADO'
GROUP BY card_country"""),
        "new_attacks": _with(ALERTS, f"""
SELECT {ALERT_COLUMNS} FROM alerts WHERE status = 'BLOQUEADO' AND order_status <> 'F'"""),
        "latest_attacks": _with(ALERTS, f"""
SELECT {ALERT_COLUMNS}, CAST(CASE WHEN order_status = 'F' THEN 1 ELSE 0 END AS INTEGER) AS block
FROM alerts WHERE status = 'BLOQUEADO' ORDER BY block, amount DESC, tx_id LIMIT 8"""),
        "decode_events_json": _with(PAYMENTS, """
SELECT CASE WHEN NOT flag_ataque THEN tx_id END AS tx_id,
       CASE WHEN NOT flag_ataque THEN user_id END AS user_id,
       CASE WHEN NOT flag_ataque AND method <> '1-URGENT' THEN amount END AS amount,
       CASE WHEN NOT flag_ataque THEN currency END AS currency,
       CASE WHEN NOT flag_ataque THEN card_country END AS card_country,
       CASE WHEN NOT flag_ataque THEN method END AS method,
       CASE WHEN NOT flag_ataque THEN CAST(flag_ataque AS VARCHAR) END AS flag_ataque
FROM payments"""),
        "payment_rejects": _with(PAYMENTS, """
SELECT CASE WHEN flag_ataque THEN 'rejected' ELSE 'kept' END AS outcome, count(*) AS n
FROM payments GROUP BY ALL"""),
        "payments_from_json": _with(PAYMENTS, """
SELECT card_country, method, count(*) AS n, count(tx_id) AS n_keys, count(amount) AS n_amounts,
       round(sum(amount), 2) AS total
FROM (SELECT CASE WHEN NOT flag_ataque THEN tx_id END AS tx_id,
             CASE WHEN NOT flag_ataque AND method <> '1-URGENT' THEN amount END AS amount,
             CASE WHEN NOT flag_ataque THEN card_country END AS card_country,
             CASE WHEN NOT flag_ataque THEN method END AS method FROM payments)
GROUP BY card_country, method"""),
        "visits_from_text": _with(VISITS, f"SELECT {VISIT_COLUMNS} FROM visits"),
        "missing_blacklist": _with(VISITS, """
SELECT user_id, ip, pages_visited, "timestamp", CAST(NULL AS VARCHAR) AS riesgo_historico
FROM visits WHERE is_bot"""),
        "chunks_rebuilt": """
SELECT doc_id, TRUE AS short, TRUE AS numbered, md5(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g')) AS signs
FROM documents WHERE regexp_matches(text, '[^ \t\n\x0B\f\r]')""",
        "registered_projects": """
SELECT lang AS name, count(DISTINCT lang) AS n_ids, 36 AS id_length, TRUE AS timed FROM documents GROUP BY lang""",
        "exported_members": _with(VISITS, """
SELECT user_id, CAST(count(DISTINCT ip) AS INTEGER) AS n_members, max(ip) AS last_member,
       bool_or(ip IN (SELECT '10.0.' || i || '.' || i FROM range(40) t(i))) AS marked
FROM visits GROUP BY user_id"""),
        "strip_frame_prefix": _with(VISITS, f"SELECT {VISIT_COLUMNS} FROM visits"),
        "history_messages": """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text
FROM conversations""",
        "bot_traffic": _with(BOTS, "SELECT * FROM bots"),
        "scraper_rollup": _with(VISITS, """
SELECT ip, CAST(sum(pages_visited) AS BIGINT) AS total_paginas_dia,
       count(user_id) AS total_sesiones_dia,
       CAST(sum(session_duration) AS BIGINT) AS tiempo_total_segundos
FROM visits GROUP BY ip"""),
        "top_scrapers": _with(VISITS, """
SELECT ip, CAST(sum(pages_visited) AS BIGINT) AS total_paginas_dia,
       count(user_id) AS total_sesiones_dia,
       CAST(sum(session_duration) AS BIGINT) AS tiempo_total_segundos
FROM visits GROUP BY ip ORDER BY 2 DESC, 1 LIMIT 10"""),
        "window_metrics": _with(WINDOWS, "SELECT * FROM windows"),
        "window_series": _with(WINDOWS, """
SELECT window_start, total_visitas FROM windows ORDER BY window_start DESC LIMIT 100"""),
        "late_rows": """
WITH arrivals AS (SELECT o_orderkey // 1000 AS batch, o_orderdate FROM orders),
tops AS (SELECT batch, max(o_orderdate) AS top FROM arrivals GROUP BY batch),
marks AS (
  SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL 365 DAYS AS watermark FROM tops)
SELECT a.batch, m.watermark, count(*) AS n_rows,
       count(*) FILTER (a.o_orderdate < m.watermark) AS n_late
FROM arrivals a JOIN marks m USING (batch) GROUP BY ALL""",
        "fraud_alerts_stream": _with(ALERTS, f"SELECT {ALERT_COLUMNS} FROM alerts"),
        "bot_traffic_stream": _with(BOTS, """
SELECT user_id, ip, pages_visited, "timestamp", riesgo_historico FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, "timestamp"
            ORDER BY ip DESC, pages_visited DESC, riesgo_historico DESC) AS newest FROM bots)
WHERE newest = 1"""),
        "window_metrics_stream": _with(WINDOWS, """
SELECT * FROM windows
WHERE window_end <= (SELECT max(event_time) - INTERVAL 1 MINUTE FROM visits)"""),
        "observed_streams": _with(PAYMENTS + "," + BOTS, """
SELECT 'alertas_fraude' AS name, count(*) AS n_in, count(*) FILTER (flag_ataque) AS n_rejected,
       CAST(0 AS BIGINT) AS n_dropped, count(*) FILTER (NOT flag_ataque) AS n_held
FROM payments
UNION ALL
SELECT 'trafico_bot', (SELECT count(*) FROM visits), 0, 0, count(DISTINCT (user_id, "timestamp")) FROM bots
UNION ALL
SELECT 'metricas_ventanas', (SELECT count(*) FROM visits), 0, 0, count(*)
FROM (SELECT DISTINCT date_trunc('minute', event_time) AS start FROM visits)
WHERE start + INTERVAL 1 MINUTE <= (SELECT max(event_time) - INTERVAL 1 MINUTE FROM visits)"""),
        "dedup_stream": "SELECT event_id, ts, user_id, event_type FROM events",
        "incremental_close": """
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS n_keys
FROM orders GROUP BY o_orderstatus""",
        "two_day_close": _with(PAYMENTS + "," + VISITS, """
SELECT 'pagos' AS source, CASE WHEN flag_ataque THEN 'rejected' ELSE 'kept' END AS outcome,
       '2026-01-0' || (CAST(substr(user_id, 2) AS BIGINT) % 2 + 1) AS batch_date,
       count(*) AS n, count(DISTINCT tx_id) AS n_distinct
FROM payments GROUP BY ALL
UNION ALL
SELECT 'visitas', 'kept', '2026-01-0' || (CAST(substr(user_id, 2) AS BIGINT) % 2 + 1),
       count(*), count(DISTINCT ip)
FROM visits GROUP BY ALL"""),
        "keyed_upsert": """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
            CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END DESC, o_orderdate DESC,
            o_orderkey DESC) AS newest FROM orders)
WHERE newest = 1""",
        "csv_roundtrip": _with(PAYMENTS, """
SELECT card_country, count(*) AS total_transacciones FROM payments GROUP BY card_country"""),
        "history_by_date": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS batch_year, count(*) AS n,
       round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""",
        "tenant_purge": """
SELECT lang AS project_id, count(*) AS n, TRUE AS existed, FALSE AS existed_again
FROM documents WHERE lang <> 'es' GROUP BY lang""",
        "graph_vertices": _with(GRAPH, "SELECT * FROM vertices"),
        "graph_edges": _with(GRAPH, "SELECT * FROM edges"),
        "graph_degrees": _with(GRAPH, "SELECT * FROM degrees"),
        "hot_nodes": _with(GRAPH, """
SELECT id, degree, upper(tipo) AS tipo FROM (
  SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY degree DESC, id) AS r FROM degrees)
WHERE r <= 15"""),
        "hot_addresses": _with(GRAPH, """
SELECT id, degree, 'IP' AS tipo FROM degrees WHERE tipo = 'ip'
ORDER BY degree DESC, id LIMIT 15"""),
        "connected_components": _recursive(COMPONENTS, "SELECT * FROM members"),
        "fraud_rings": _recursive(COMPONENTS, "SELECT * FROM rings"),
        "ring_members": _recursive(
            COMPONENTS, "SELECT component, num_entidades, tipo, id FROM ring_rows"
        ),
        "ring_lookup": _recursive(
            COMPONENTS,
            "SELECT component, num_entidades, tipo, id FROM ring_rows "
            "WHERE component = 'ip:10.0.1.0'",
        ),
        "ring_triage": _recursive(COMPONENTS, """
SELECT nivel_amenaza AS "Severidad", component AS "ID Comunidad",
       num_entidades AS "Nº Nodos", id AS "Entidad Implicada"
FROM ring_rows JOIN severity USING (component, num_entidades)
WHERE nivel_amenaza LIKE '🔴%' OR nivel_amenaza LIKE '🟠%'"""),
        "ring_severity": _recursive(COMPONENTS, "SELECT * FROM severity"),
        "ring_topology": _recursive(COMPONENTS, """
SELECT *, ips * usuarios AS lineas_ip_usuario, usuarios * paises AS lineas_usuario_pais
FROM (SELECT component, count(*) FILTER (tipo = 'ip') AS ips,
             count(*) FILTER (tipo = 'usuario') AS usuarios,
             count(*) FILTER (tipo = 'pais') AS paises
      FROM ring_rows GROUP BY component)"""),
        "ring_node_types": _recursive(COMPONENTS, """
SELECT component, id,
       CASE WHEN contains(id, '.') THEN 'IP'
            WHEN length(id) = 2 AND upper(id) = id AND lower(id) <> id THEN 'PAIS'
            ELSE 'USUARIO' END AS tipo_inferido
FROM ring_rows"""),
        "ring_edges": _recursive(COMPONENTS, """
SELECT r.component, e.relacion, e.src, e.dst, count(*) AS n
FROM edges e JOIN ring_rows r ON r.tipo = e.src_tipo AND r.id = e.src GROUP BY ALL"""),
        "supported_documents": _with(DOCUMENTS, """
SELECT doc_id, project_id, source FROM docs
WHERE (source LIKE '%.pdf' OR source LIKE '%.txt') AND length(text) > 0"""),
        "chunks_fixed": _with(CHUNKS, "SELECT doc_id, chunk_no, text FROM chunks"),
        "chunk_counts": _with(
            CHUNKS, "SELECT project_id, source, count(*) AS n_chunks FROM chunks GROUP BY ALL"
        ),
        "index_reupload": _with(DOCUMENTS, """,
sizes AS (
  SELECT project_id, source, length(text) AS n,
         CASE WHEN source LIKE '%.txt' THEN 900 ELSE 450 END AS stride,
         CASE WHEN source LIKE '%.txt' THEN 100 ELSE 50 END AS overlap
  FROM docs WHERE (source LIKE '%.txt' OR source LIKE '%.pdf') AND length(text) > 0)
SELECT project_id, source,
       CAST(sum(greatest(n - overlap - 1, 0) // stride + 1) AS BIGINT) AS n_chunks
FROM sizes GROUP BY ALL""".lstrip()),
        "text_stats": f"""
SELECT doc_id, CAST(n_words AS INTEGER) AS n_words, CAST(length(text) AS INTEGER) AS n_chars,
       'El fragmento tiene ' || n_words || ' palabras y ' || length(text)
         || ' caracteres (incluyendo espacios).' AS summary
FROM (SELECT *, {TOKENS} AS n_words FROM documents)""",
        "project_registry": """
SELECT DISTINCT md5(lang) AS id, lang AS name, '2026-01-01 00:00:00' AS created_at
FROM documents""",
        "project_files": _with(DOCUMENTS + FILE_LISTS, """
SELECT l.project_id, l.n_files, coalesce(f.file_name, 'Ninguno') AS file_name
FROM file_lists l LEFT JOIN files f USING (project_id)"""),
        "history_window": f"""
SELECT *, running_tokens > 200 AS to_summarise FROM (
  SELECT conv_id, turn, role, tokens,
         CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS BIGINT)
           AS running_tokens
  FROM (SELECT *, CAST({TOKENS} AS BIGINT) AS tokens FROM conversations))""",
        "history_append": """
SELECT role, count(*) AS n FROM conversations WHERE conv_id % 4 <> 0 GROUP BY role""",
        "knn_exact": _with(
            hits, "SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank FROM hits"
        ),
        "knn_filtered": _with(
            RETRIEVAL + _hits("p.source = q.own_source"),
            "SELECT query_id, chunk_id, round(sim, 6) AS similarity, rank FROM hits",
        ),
        "knn_all": """
WITH pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS chunk_id,
         list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS sim
  FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)
SELECT query_id, chunk_id, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS rank FROM pairs)
WHERE rank <= 10""",
        "lsh_recall": """
SELECT count(*) AS n_queries, CAST(sum(least(10, (SELECT count(*) FROM embeddings))) AS BIGINT) AS n_wanted,
       TRUE AS reached
FROM embeddings WHERE vec_id % 100 = 0""",
        "hashed_embeddings": _with("texts AS (SELECT doc_id AS id, text FROM documents)" + _sketch("texts"), """
SELECT id AS doc_id, CAST(len(vector) AS INTEGER) AS width,
       array_to_string(list_transform(vector, lambda v: CAST(v AS VARCHAR)), ',') AS vector
FROM texts_vectors"""),
        "corpus_search": _with(CORPUS_SEARCH + _hits(rounded=True) + _picks(rounded=True), """
SELECT query_id, pick, rank, chunk_id, source, CAST(page AS VARCHAR) AS page FROM picks"""),
        "mmr": _with(picks, "SELECT query_id, chunk_id, rank, pick FROM picks"),
        "context_table": _with(picks + CONTEXTS, "SELECT * FROM contexts"),
        "source_footer": _with(picks + FOOTERS, "SELECT * FROM footers"),
        "no_index_answers": _with(picks + FOOTERS, """
SELECT q.query_id, q.project_id,
       CASE WHEN q.project_id = 'es'
            THEN 'Aún no tengo conocimientos sobre ese tema u otros en general ya que no existen '
                 || 'archivos en mi base RAG. Pide que suban fuentes (documentos).'
            ELSE f.footer END AS answer
FROM questions q LEFT JOIN footers f USING (query_id)"""),
        "prompt_messages": _with(picks + CONTEXTS + FILE_LISTS + REMEMBERED, """
SELECT query_id, CAST(0 AS INTEGER) AS section, CAST(0 AS BIGINT) AS position, 'system' AS role,
       'Responde solo con datos del contexto.' || chr(10) || chr(10) || 'Contexto:' || chr(10)
         || coalesce(context, '') AS content
FROM questions LEFT JOIN contexts USING (query_id)
UNION ALL
SELECT query_id, 0, 1, 'system', 'ARCHIVOS DISPONIBLES EN ESTE PROYECTO: ' || files
FROM questions JOIN file_lists USING (project_id)
UNION ALL
SELECT conv_id, 1, turn, role, text FROM earlier WHERE upto <= 200
UNION ALL
SELECT query_id, 2, turn, 'user', question FROM questions"""),
        "dataset_profile": _with(RASTERS, """
SELECT count(*) AS n_rows, min(len(pixels)) AS min_size, max(len(pixels)) AS max_size,
       min(list_min(pixels)) AS min_value, max(list_max(pixels)) AS max_value, 'int' AS dtype
FROM rasters"""),
        "class_distribution": """
SELECT label, count(*) AS n,
       ['Avión', 'Coche', 'Pájaro', 'Gato', 'Ciervo',
        'Perro', 'Rana', 'Caballo', 'Barco', 'Camión'][label + 1] AS class_name
FROM embeddings GROUP BY label""",
        "class_weights": """
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight
FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""",
        "first_samples": _with(RASTERS, f"""
SELECT id, ['Avión', 'Coche', 'Pájaro', 'Gato', 'Ciervo',
            'Perro', 'Rana', 'Caballo', 'Barco', 'Camión'][label + 1] AS class_name,
       {_joined("pixels")} AS pixels
FROM rasters ORDER BY id LIMIT 25"""),
        "stratified_split": """
WITH sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
shares AS (
  SELECT label, n, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS wanted,
         CAST(sum(n) OVER () AS BIGINT) AS total FROM sizes),
floors AS (
  SELECT *, n * wanted // total AS low, n * wanted % total AS rest FROM shares),
quotas AS (
  SELECT label, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                             <= wanted - sum(low) OVER () THEN 1 ELSE 0 END AS quota
  FROM floors)
SELECT id, label, CASE WHEN r <= quota THEN 'validation' ELSE 'train' END AS split
FROM (SELECT vec_id AS id, label,
             row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS r
      FROM embeddings) JOIN quotas USING (label)""",
        "scaled_rasters": _with(RASTERS, f"""
SELECT id, {_milli("list_transform(pixels, lambda p: p / 255.0::DOUBLE)")} AS scaled_milli
FROM rasters"""),
        "centred_rasters": _with(RASTERS, f"""
SELECT id, {_milli('''flatten(list_transform(pixels, lambda p:
  [p // 2 - 103.939::DOUBLE, 255 - p - 116.779::DOUBLE, p - 123.68::DOUBLE]))''')}
  AS centred_milli
FROM rasters"""),
        "flip_horizontal": _with(RASTERS, f"""
SELECT id, {_joined(f'''CASE WHEN {_unit("flip")} < 0.5
  THEN list_transform(range(64), lambda i: pixels[(i // 8) * 8 + 7 - i % 8 + 1])
  ELSE list_transform(range(64), lambda i: pixels[i + 1]) END''')} AS pixels
FROM rasters"""),
        "shift_nearest": _with(RASTERS, f"""
SELECT id, {_milli('list(v ORDER BY i)')} AS pixels_milli
FROM (
  SELECT id, i,
         ({_pixel("t", "l")} * (1 - (x - l)) + {_pixel("t", "l + 1")} * (x - l)) * (1 - (y - t))
         + ({_pixel("t + 1", "l")} * (1 - (x - l)) + {_pixel("t + 1", "l + 1")} * (x - l))
           * (y - t) AS v
  FROM (
    SELECT *, floor(y) AS t, floor(x) AS l FROM (
      SELECT id, i, pixels,
             i // 8 - ({_unit("dy")} * 2 - 1) * 2.0::DOUBLE AS y,
             i % 8 - ({_unit("dx")} * 2 - 1) * 2.0::DOUBLE AS x
      FROM (SELECT id, pixels, unnest(range(64)) AS i FROM rasters))))
GROUP BY id"""),
        "upsample": _with(RASTERS, f"""
SELECT id, {_joined('''list_transform(range(576),
  lambda i: pixels[((i // 24) // 3) * 8 + (i % 24) // 3 + 1])''')} AS pixels
FROM rasters"""),
        "argmax_predictions": _with(
            PREDICTIONS, "SELECT model, id, label, prediction FROM predictions"
        ),
        "confusion_matrix": _with(PREDICTIONS, """
SELECT c AS label, count(*) FILTER (label = c AND prediction = 0) AS predicted_0,
       count(*) FILTER (label = c AND prediction = 1) AS predicted_1,
       count(*) FILTER (label = c AND prediction = 2) AS predicted_2,
       count(*) FILTER (label = c AND prediction NOT IN (0, 1, 2)) AS predicted_other
FROM predictions, (VALUES (0), (1), (2)) classes(c) WHERE model = 'long text' GROUP BY c"""),
        "classification_report": _with(PREDICTIONS, """,
rows_of AS (SELECT label, prediction FROM predictions WHERE model = 'long text'),
per AS (
  SELECT c, count(*) FILTER (label = c AND prediction = c) AS hits,
         count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted
  FROM (SELECT label, prediction, unnest([0, 1]) AS c FROM rows_of) GROUP BY c),
scores AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * hits / (support + predicted) END AS f
  FROM per)
SELECT CAST(c AS VARCHAR) AS class, round(p, 9) AS "precision", round(r, 9) AS recall,
       round(f, 9) AS f1_score, support FROM scores
UNION ALL
SELECT 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9),
       round(sum(hits) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL
SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9),
       CAST(sum(support) AS BIGINT) FROM scores
UNION ALL
SELECT 'weighted avg', round(sum(p * support) / sum(support), 9),
       round(sum(r * support) / sum(support), 9), round(sum(f * support) / sum(support), 9),
       CAST(sum(support) AS BIGINT) FROM scores""".lstrip()),
        "log_loss": _with(PREDICTIONS, """
SELECT round(avg(-ln(chosen)), 9) AS test_loss,
       round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 9) AS test_accuracy,
       count(*) AS n_rows
FROM predictions WHERE model = 'long text'"""),
        "model_comparison": _with(PREDICTIONS, """
SELECT model AS modelo, round(avg(-ln(chosen)), 9) AS test_loss,
       round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 9) AS test_accuracy,
       count(*) AS n_rows
FROM predictions GROUP BY model"""),
    }
