"""The registered queries as plain SQL, written against the definitions rather than the
Spark code: where Spark sums changes, these count by brute force."""

from __future__ import annotations

_ENC = """
enc AS (
  SELECT CAST(event_id AS VARCHAR) AS encounter_id, ts AS arrival_time,
         CAST(user_id AS VARCHAR) AS patient_id,
         CAST(props->>'$.k' AS INTEGER) % 5 + 1 AS triage_level,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, event_type AS sector_id
  FROM events)"""
_SPARSE = _ENC + """,
sparse AS (
  SELECT sector_id, CAST(date_trunc('hour', arrival_time) AS TIMESTAMP) AS window_start,
         count(*) AS arrivals_count, avg(triage_level) AS avg_triage_acuity
  FROM enc GROUP BY ALL)"""
_DENSE = _SPARSE + """,
spine AS (
  SELECT sector_id, unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 HOUR)) AS window_start
  FROM sparse GROUP BY sector_id),
dense AS (
  SELECT sector_id, window_start, coalesce(arrivals_count, 0) AS arrivals_count, avg_triage_acuity
  FROM spine LEFT JOIN sparse USING (sector_id, window_start))"""
_FILLED = _DENSE + """,
filled AS (
  SELECT sector_id, window_start, arrivals_count, avg_triage_acuity,
         CAST(window_start AS DATE) AS day,
         avg(arrivals_count) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rolling_avg_arrivals_4h,
         coalesce(lag(arrivals_count, 24) OVER w, 0) AS lag_arrivals_24h,
         lead(arrivals_count, 1) OVER w AS target_arrivals_h1,
         lead(arrivals_count, 4) OVER w AS target_arrivals_h4,
         lead(arrivals_count, 24) OVER w AS target_arrivals_h24
  FROM dense WINDOW w AS (PARTITION BY sector_id ORDER BY window_start))"""
_NAIVE = _FILLED + """,
naive AS (
  SELECT sector_id, window_start + INTERVAL 59 MINUTE AS prediction_ts,
         'naive-' || strftime(day, '%Y%m%d') || '0000' AS model_version,
         rolling_avg_arrivals_4h AS predicted_arrivals_h1,
         (rolling_avg_arrivals_4h + lag_arrivals_24h) / 2 AS predicted_arrivals_h4,
         CAST(arrivals_count AS DOUBLE) AS predicted_arrivals_h24, day
  FROM filled)"""
_PAIRS = _NAIVE + """,
longer AS (
  SELECT sector_id, prediction_ts, '+1h' AS horizon, 1 AS h, predicted_arrivals_h1 AS predicted_arrivals FROM naive
  UNION ALL SELECT sector_id, prediction_ts, '+4h', 4, predicted_arrivals_h4 FROM naive
  UNION ALL SELECT sector_id, prediction_ts, '+24h', 24, predicted_arrivals_h24 FROM naive),
pairs AS (
  SELECT l.sector_id, l.prediction_ts, l.horizon, d.window_start AS target_hour,
         l.predicted_arrivals, d.arrivals_count AS actual_arrivals
  FROM longer l JOIN dense d ON l.sector_id = d.sector_id
   AND d.window_start = date_trunc('hour', l.prediction_ts) + to_hours(l.h))"""
_STEPS = """
steps AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS encounter_id,
         CASE event_type WHEN 'view' THEN 'triage_start' WHEN 'click' THEN 'triage_end'
                         WHEN 'purchase' THEN 'care_start' ELSE 'discharge' END AS event_type,
         ts AS event_timestamp, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt
  FROM events WHERE event_type <> 'error')"""
_TIMELINE = _STEPS + """,
arrivals AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS encounter_id,
         ts AS arrival_time, CAST(user_id AS VARCHAR) AS patient_id,
         CAST(user_id % 5 + 1 AS INTEGER) AS triage_level,
         CAST(ts AS DATE) AS day, event_type AS sector_id
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_type) = 1),
timeline AS (
  SELECT a.*,
         (SELECT min(event_timestamp) FROM steps s WHERE s.encounter_id = a.encounter_id AND s.event_type = 'triage_start') AS triage_start,
         (SELECT min(event_timestamp) FROM steps s WHERE s.encounter_id = a.encounter_id AND s.event_type = 'triage_end') AS triage_end,
         (SELECT min(event_timestamp) FROM steps s WHERE s.encounter_id = a.encounter_id AND s.event_type = 'care_start') AS care_start,
         (SELECT min(event_timestamp) FROM steps s WHERE s.encounter_id = a.encounter_id AND s.event_type = 'discharge') AS discharge_time
  FROM arrivals a)"""
_WAITS = _TIMELINE + """,
raw AS (
  SELECT *, (epoch_us(triage_start) - epoch_us(arrival_time)) / 60000000.0 AS r1,
         (epoch_us(care_start) - epoch_us(coalesce(triage_end, arrival_time))) / 60000000.0 AS r2,
         (epoch_us(care_start) - epoch_us(arrival_time)) / 60000000.0 AS r3,
         (epoch_us(discharge_time) - epoch_us(arrival_time)) / 60000000.0 AS r4
  FROM timeline),
waits AS (
  SELECT *, CASE WHEN r1 >= 0 THEN r1 END AS wait_triage_min, CASE WHEN r2 >= 0 THEN r2 END AS wait_service_min,
         CASE WHEN r3 >= 0 THEN r3 END AS total_wait_min, CASE WHEN r4 >= 0 THEN r4 END AS los_min,
         CAST(coalesce(r1 < 0, false) AS INTEGER) + CAST(coalesce(r2 < 0, false) AS INTEGER)
         + CAST(coalesce(r3 < 0, false) AS INTEGER) + CAST(coalesce(r4 < 0, false) AS INTEGER) AS negative_durations
  FROM raw)"""
# Counted hour by hour: nobody in the load table knows of changes or running sums.
_LOAD = _WAITS + """,
stays AS (
  SELECT sector_id, arrival_time, care_start, wait_service_min,
         coalesce(care_start, CAST(day + INTERVAL 1 DAY AS TIMESTAMP)) AS leaves_queue,
         CASE WHEN care_start IS NOT NULL THEN
           CASE WHEN discharge_time >= care_start THEN discharge_time
                ELSE CAST(day + INTERVAL 1 DAY AS TIMESTAMP) END END AS leaves_bed
  FROM waits),
ends AS (
  SELECT sector_id, min(date_trunc('hour', arrival_time)) AS lo,
         greatest(max(date_trunc('hour', leaves_queue)),
                  max(CASE WHEN date_trunc('hour', leaves_bed) = leaves_bed THEN leaves_bed
                           ELSE date_trunc('hour', leaves_bed) + INTERVAL 1 HOUR END)) AS hi
  FROM stays GROUP BY sector_id),
grid AS (
  SELECT sector_id, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 HOUR)) AS h FROM ends),
load AS (
  SELECT g.sector_id, g.h AS window_start,
         count(*) FILTER (s.arrival_time >= g.h AND s.arrival_time < g.h + INTERVAL 1 HOUR) AS arrivals_count,
         avg(s.wait_service_min) FILTER (s.arrival_time >= g.h AND s.arrival_time < g.h + INTERVAL 1 HOUR) AS wait_avg_60m,
         count(*) FILTER (s.arrival_time < g.h + INTERVAL 1 HOUR AND s.leaves_queue >= g.h + INTERVAL 1 HOUR) AS queue_size,
         count(*) FILTER (s.care_start < g.h + INTERVAL 1 HOUR AND s.leaves_bed > g.h) AS occupied_beds
  FROM grid g JOIN stays s ON s.sector_id = g.sector_id GROUP BY ALL),
sectors(sector_id, manager, functional_capacity) AS (
  VALUES ('click', 'manager A', 6), ('error', 'manager B', 4), ('purchase', 'manager C', 5),
         ('signup', 'manager D', 3), ('view', 'manager E', 8)),
ops AS (
  SELECT l.*, c.functional_capacity, occupied_beds / CAST(c.functional_capacity AS DOUBLE) AS occupancy_rate
  FROM load l LEFT JOIN sectors c USING (sector_id))"""
# The same with stays that go on until they end, and every hour up to the end of the last day.
_LOAD_KEPT = (_LOAD.replace("coalesce(care_start, CAST(day + INTERVAL 1 DAY AS TIMESTAMP)) AS leaves_queue",
                            "coalesce(care_start, TIMESTAMP '2999-01-01') AS leaves_queue")
              .replace("ELSE CAST(day + INTERVAL 1 DAY AS TIMESTAMP) END END", "ELSE TIMESTAMP '2999-01-01' END END")
              .replace("lo AS TIMESTAMP), CAST(hi AS TIMESTAMP)",
                       "lo AS TIMESTAMP), (SELECT CAST(max(day) + INTERVAL 23 HOUR AS TIMESTAMP) FROM waits)"))
_CHUNKS = """
chunks AS (
  SELECT source || '/' || CAST(doc_id AS VARCHAR) AS source, CAST(i AS INTEGER) AS chunk_no,
         substring(text, CAST(i * 1000 + 1 AS BIGINT), 1000) AS text
  FROM documents, unnest(generate_series(0, (length(text) - 1) // 1000)) AS t(i)
  WHERE length(text) > 0)"""


def _word_counts(name: str, key: str, source: str) -> str:
    return f"""
{name}_words AS (
  SELECT {key} AS id, unnest(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+')) AS word FROM {source}),
{name} AS (
  SELECT id, CAST('0x' || substr(md5(word), 1, 4) AS INTEGER) % 256 AS slot, count(*) AS n
  FROM {name}_words WHERE word <> '' GROUP BY ALL)"""


_HITS = (_CHUNKS + "," + _word_counts("cw", "source || '#' || CAST(chunk_no AS VARCHAR)", "chunks")
         + "," + _word_counts("qw", "item_id", "benchmark") + """,
hits AS (
  SELECT q.id AS query_id, c.id AS corpus_id,
         round(sum(q.n * c.n) / (sqrt(any_value(qn.s)) * sqrt(any_value(cn.s))), 9) AS similarity
  FROM qw q JOIN cw c USING (slot)
  JOIN (SELECT id, sum(n * n) AS s FROM qw GROUP BY id) qn ON qn.id = q.id
  JOIN (SELECT id, sum(n * n) AS s FROM cw GROUP BY id) cn ON cn.id = c.id
  GROUP BY q.id, c.id),
top AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS INTEGER) AS rank
  FROM hits QUALIFY rank <= 3),
found AS (
  SELECT t.query_id, t.rank, c.source, c.text FROM top t
  JOIN chunks c ON t.corpus_id = c.source || '#' || CAST(c.chunk_no AS VARCHAR))""")
_MEANS = """
parts AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (
  SELECT label, list(m ORDER BY i) AS mean FROM (SELECT label, i, avg(x) AS m FROM parts GROUP BY ALL) GROUP BY label)"""

_QUALITY_SILVER = _ENC + """,
silver AS (
  SELECT encounter_id, CASE WHEN sector_id <> 'error' THEN arrival_time END AS arrival_time, triage_level,
         CAST(dt AS DATE) AS day
  FROM enc),
days AS (SELECT unnest(generate_series(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day FROM silver),
measured AS (
  SELECT d.day, count(s.day) AS row_count, count(s.day) FILTER (s.encounter_id IS NULL) AS no_id,
         count(s.day) FILTER (s.arrival_time IS NULL) AS no_time, count(s.day) FILTER (s.triage_level IS NULL) AS no_level,
         count(s.day) FILTER (s.arrival_time < TIMESTAMP '2024-01-03 00:00:00'
                              OR s.arrival_time > TIMESTAMP '2024-01-28 12:00:00') AS out_of_range
  FROM days d LEFT JOIN silver s USING (day) GROUP BY d.day),
judged AS (
  SELECT *, row_count > 0 AS has_rows, no_id + no_time + no_level AS null_count,
         greatest(no_id, no_time, no_level) / greatest(row_count, 1) <= 0.07 AS filled,
         concat_ws(', ', CASE WHEN no_id / greatest(row_count, 1) > 0.07 THEN 'encounter_id' END,
                   CASE WHEN no_time / greatest(row_count, 1) > 0.07 THEN 'arrival_time' END,
                   CASE WHEN no_level / greatest(row_count, 1) > 0.07 THEN 'triage_level' END) AS lacking,
         out_of_range = 0 AS in_range FROM measured)"""
_BINNED = _FILLED + """,
cut AS (SELECT max(day) - 6 AS c FROM filled),
val AS (
  SELECT 'arrivals_count' AS feature, CAST(arrivals_count AS DOUBLE) AS x, day < c AS base FROM filled, cut
  UNION ALL SELECT 'rolling_avg_arrivals_4h', rolling_avg_arrivals_4h, day < c FROM filled, cut
  UNION ALL SELECT 'lag_arrivals_24h', CAST(lag_arrivals_24h AS DOUBLE), day < c FROM filled, cut),
span AS (
  SELECT feature, min(x) AS lo, (max(x) - min(x)) / 10 AS width, count(*) AS bn FROM val WHERE base GROUP BY feature),
cur AS (SELECT feature, count(*) AS cn FROM val WHERE NOT base GROUP BY feature),
bin AS (
  SELECT feature, least(9, greatest(0, floor((x - lo) / width))) AS b, count(*) FILTER (base) AS nb,
         count(*) FILTER (NOT base) AS nc FROM val JOIN span USING (feature) GROUP BY ALL)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}

    out["scan_partition"] = _with(_ENC, "SELECT * FROM enc WHERE dt = '2024-01-15'")
    out["roundtrip_partitioned"] = _with(_ENC, """
        SELECT dt, sector_id, count(*) AS encounters, min(arrival_time) AS first_arrival,
               max(arrival_time) AS last_arrival, CAST(sum(triage_level) AS BIGINT) AS triage_sum
        FROM enc GROUP BY dt, sector_id""")
    out["append_bronze"] = _with(_STEPS, """
        SELECT dt, event_type, 2 * count(*) AS deliveries, count(*) AS event_ids FROM steps GROUP BY dt, event_type""")
    out["ingest_ledger"] = _with(_STEPS, """
        SELECT dt, count(*) AS row_count, count(DISTINCT event_id) AS event_ids FROM steps GROUP BY dt""")
    out["append_predictions"] = _with(_NAIVE, """
        SELECT CAST(day AS VARCHAR) AS dt, run_ts, count(*) AS predictions,
               round(sum(predicted_arrivals_h24), 6) AS sum_h24
        FROM naive, (VALUES ('202402010600'), ('202402010615')) AS runs(run_ts) GROUP BY ALL""")
    preview = """
        SELECT sector_id, strftime(prediction_ts, '%Y-%m-%d %H:%M:%S') AS prediction_ts, model_version,
               round_even(predicted_arrivals_h1, 2) AS predicted_arrivals_h1,
               round_even(predicted_arrivals_h4, 2) AS predicted_arrivals_h4,
               round_even(predicted_arrivals_h24, 2) AS predicted_arrivals_h24, CAST(day AS VARCHAR) AS dt
        FROM naive"""
    out["export_csv"] = out["predictions_preview"] = _with(_NAIVE, preview)
    status = """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity
        FROM sparse WHERE window_start BETWEEN TIMESTAMP '2024-01-15 13:30:00' AND TIMESTAMP '2024-01-15 15:30:00'"""
    out["external_tables"] = out["current_status"] = _with(_SPARSE, status)

    out["silver_encounters"] = _with(_ENC, """
        SELECT encounter_id, CASE WHEN sector_id <> 'error' THEN arrival_time END AS arrival_time, patient_id,
               triage_level, dt, sector_id FROM enc""")
    out["silver_rejects"] = _with(_ENC, """
        , reasoned AS (
          SELECT dt, CASE WHEN sector_id = 'signup' AND triage_level = 3 THEN 'no encounter_id'
                          WHEN sector_id = 'error' THEN 'arrival_time not readable' END AS reason FROM enc)
        SELECT dt, 'bronze_encounters' AS source_table, reason, 2 * count(*) AS deliveries, 2 * count(*) AS records
        FROM reasoned WHERE reason IS NOT NULL AND dt = '2024-01-15' GROUP BY dt, reason""")
    out["coerce_numeric"] = """
        SELECT event_type AS sector_id, count(*) AS texts,
               count(value) FILTER (event_type NOT IN ('error', 'view')) AS numbers,
               round(min(value) FILTER (event_type NOT IN ('error', 'view')), 6) AS smallest,
               round(max(value) FILTER (event_type NOT IN ('error', 'view')), 6) AS largest
        FROM events GROUP BY event_type"""
    out["dedup_encounters"] = _with(_ENC, "SELECT * FROM enc")
    out["dedup_events"] = out["stream_dedup"] = _with(_STEPS, "SELECT * FROM steps")
    out["encounter_timeline"] = _with(_TIMELINE, """
        SELECT encounter_id, arrival_time, patient_id, triage_level, CAST(day AS VARCHAR) AS dt, sector_id,
               triage_start, triage_end, care_start, discharge_time FROM timeline""")
    out["encounter_waits"] = _with(_WAITS, """
        SELECT encounter_id, sector_id, CAST(day AS VARCHAR) AS dt, round(wait_triage_min, 6) AS wait_triage_min,
               round(wait_service_min, 6) AS wait_service_min, round(total_wait_min, 6) AS total_wait_min,
               round(los_min, 6) AS los_min, negative_durations FROM waits""")
    out["sector_dim_join"] = _with(_SPARSE, """
        SELECT sector_id, window_start, arrivals_count,
               CASE sector_id WHEN 'click' THEN 'manager A' WHEN 'error' THEN 'manager B'
                 WHEN 'purchase' THEN 'manager C' WHEN 'signup' THEN 'manager D' WHEN 'view' THEN 'manager E' END AS manager,
               CASE sector_id WHEN 'click' THEN 6 WHEN 'error' THEN 4 WHEN 'purchase' THEN 5
                 WHEN 'signup' THEN 3 WHEN 'view' THEN 8 END AS functional_capacity
        FROM sparse""")
    out["dq_orphans"] = _with(_STEPS, """
        SELECT dt, event_type, count(*) AS orphans FROM steps s
        WHERE NOT EXISTS (SELECT 1 FROM steps t WHERE t.encounter_id = s.encounter_id AND t.event_type = 'triage_start')
        GROUP BY dt, event_type""")

    out["hourly_metrics_sparse"] = _with(_SPARSE, """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity,
               CAST(CAST(window_start AS DATE) AS VARCHAR) AS dt FROM sparse""")
    out["hourly_metrics_dense"] = _with(_DENSE, """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity,
               CAST(CAST(window_start AS DATE) AS VARCHAR) AS dt FROM dense""")
    out["wait_avg_hourly"] = _with(_WAITS, """
        SELECT sector_id, CAST(date_trunc('hour', arrival_time) AS TIMESTAMP) AS window_start,
               round(avg(wait_service_min), 4) AS wait_avg_60m, count(*) AS waits_count
        FROM waits WHERE wait_service_min IS NOT NULL GROUP BY ALL""")
    out["occupancy_hourly"] = _with(_LOAD, """
        SELECT sector_id, window_start, occupied_beds, functional_capacity,
               round(occupancy_rate, 6) AS occupancy_rate FROM ops""")
    out["queue_size"] = _with(_LOAD, "SELECT sector_id, window_start, queue_size FROM load")
    out["risk_hourly"] = _with(_LOAD, """
        SELECT window_start, CAST(hour(window_start) AS INTEGER) AS hour, arrivals_count,
               round(wait_avg_60m, 4) AS wait_avg_60m, queue_size, occupied_beds,
               round(occupancy_rate, 6) AS occupancy_rate,
               round(least(100, greatest(0, 60 * occupancy_rate + 40 * least(1, coalesce(wait_avg_60m, 0) / 60))), 4) AS risk_score,
               CAST(CAST(window_start AS DATE) AS VARCHAR) AS dt, sector_id
        FROM ops""")
    out["load_incremental"] = out["risk_hourly"].replace(_LOAD.strip(), _LOAD_KEPT.strip())
    out["external_forecast"] = out["forecast_today"] = _with(_NAIVE, """
        SELECT sector_id, round(predicted_arrivals_h1, 6) AS predicted_arrivals_h1, CAST(day AS VARCHAR) AS dt
        FROM naive WHERE day = DATE '2024-01-15'""")

    out["rolling_avg_4"] = _with(_SPARSE, """
        SELECT sector_id, window_start, arrivals_count,
               round(avg(arrivals_count) OVER (PARTITION BY sector_id ORDER BY window_start
                     ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_arrivals_4h
        FROM sparse""")
    out["lag_24"] = _with(_SPARSE, """
        SELECT sector_id, window_start, arrivals_count, lag(arrivals_count, 1) OVER w AS lag_arrivals_1h,
               lag(arrivals_count, 24) OVER w AS lag_arrivals_24h
        FROM sparse WINDOW w AS (PARTITION BY sector_id ORDER BY window_start)""")
    out["rolling_avg_4h_range"] = _with(_SPARSE, """
        SELECT s.sector_id, s.window_start, s.arrivals_count,
               round((SELECT avg(p.arrivals_count) FROM sparse p WHERE p.sector_id = s.sector_id
                      AND p.window_start BETWEEN s.window_start - INTERVAL 3 HOUR AND s.window_start), 6) AS rolling_avg_arrivals_4h,
               (SELECT max(p.arrivals_count) FROM sparse p WHERE p.sector_id = s.sector_id
                AND p.window_start = s.window_start - INTERVAL 24 HOUR) AS lag_arrivals_24h
        FROM sparse s""")

    def strict(source: str) -> str:
        return f""",
built AS (
  SELECT *, avg(arrivals_count) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rolling_avg_arrivals_4h,
         lag(arrivals_count, 24) OVER w AS lag_arrivals_24h
  FROM {source} WINDOW w AS (PARTITION BY sector_id ORDER BY window_start)),
kept AS (SELECT * FROM built WHERE lag_arrivals_24h IS NOT NULL)"""
    strict_body = """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity,
               round(rolling_avg_arrivals_4h, 6) AS rolling_avg_arrivals_4h, lag_arrivals_24h,
               lead(arrivals_count, 1) OVER w AS target_arrivals_h1, lead(arrivals_count, 4) OVER w AS target_arrivals_h4,
               lead(arrivals_count, 24) OVER w AS target_arrivals_h24,
               CAST(CAST(window_start AS DATE) AS VARCHAR) AS dt
        FROM kept WINDOW w AS (PARTITION BY sector_id ORDER BY window_start)"""
    out["features_strict"] = _with(_SPARSE + strict("sparse"), strict_body)
    out["features_strict_dense"] = _with(_DENSE + strict("dense"), strict_body)
    filled = """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity,
               round(rolling_avg_arrivals_4h, 6) AS rolling_avg_arrivals_4h, lag_arrivals_24h, target_arrivals_h1,
               target_arrivals_h4, target_arrivals_h24, CAST(day AS VARCHAR) AS dt FROM filled"""
    out["features_filled"] = _with(_FILLED, filled)
    out["features_of_day"] = _with(_FILLED, filled + " WHERE day = DATE '2024-01-15'")
    out["latest_per_sector"] = _with(_FILLED, """
        SELECT sector_id, window_start, round(rolling_avg_arrivals_4h, 6) AS rolling_avg_arrivals_4h, lag_arrivals_24h
        FROM filled f WHERE window_start = (SELECT max(window_start) FROM filled g WHERE g.sector_id = f.sector_id)""")

    out["predictions_long"] = _with(_NAIVE, """
        SELECT sector_id, prediction_ts, model_version, CAST(day AS VARCHAR) AS dt, round(v.p, 6) AS predicted_arrivals,
               v.h AS horizon_h, '+' || v.h || 'h' AS horizon
        FROM naive, LATERAL (VALUES (1, predicted_arrivals_h1), (4, predicted_arrivals_h4),
                                    (24, predicted_arrivals_h24)) AS v(h, p)""")
    out["pred_vs_actual"] = _with(_PAIRS, """
        SELECT sector_id, prediction_ts, horizon, CAST(target_hour AS TIMESTAMP) AS target_hour,
               round(predicted_arrivals, 6) AS predicted_arrivals, actual_arrivals FROM pairs""")
    out["pred_asof"] = _with(_NAIVE, """
        SELECT e.encounter_id, e.sector_id, e.arrival_time - INTERVAL 3 HOUR AS asked_at, n.prediction_ts,
               round(n.predicted_arrivals_h1, 6) AS predicted_arrivals_h1
        FROM enc e ASOF LEFT JOIN naive n
          ON e.sector_id = n.sector_id AND e.arrival_time - INTERVAL 3 HOUR >= n.prediction_ts""")
    out["forecast_mape"] = _with(_PAIRS, """
        SELECT sector_id, horizon, count(*) AS pairs, count(*) FILTER (actual_arrivals = 0) AS skipped_zero,
               round(avg(abs(actual_arrivals - predicted_arrivals)), 6) AS mae,
               round(sqrt(avg(power(actual_arrivals - predicted_arrivals, 2))), 6) AS rmse,
               round(avg(abs(actual_arrivals - predicted_arrivals) / actual_arrivals)
                     FILTER (actual_arrivals <> 0), 6) AS mape
        FROM pairs GROUP BY sector_id, horizon""")
    out["held_out_naive"] = _with(_FILLED, """
        SELECT o.origin, h.h AS horizon, count(*) AS pairs, round(avg(abs(t.arrivals_count - y.arrivals_count)), 6) AS naive_mae
        FROM (VALUES (TIMESTAMP '2024-01-16'), (TIMESTAMP '2024-01-20'), (TIMESTAMP '2024-01-24')) AS o(origin)
        CROSS JOIN (VALUES (1), (4), (24)) AS h(h)
        JOIN filled f ON f.window_start >= o.origin AND f.window_start < o.origin + INTERVAL 4 DAY
        JOIN filled t ON t.sector_id = f.sector_id AND t.window_start = f.window_start + to_hours(h.h)
        JOIN filled y ON y.sector_id = f.sector_id AND y.window_start = t.window_start - INTERVAL 24 HOUR
        GROUP BY ALL""")
    out["drift_psi"] = _with(_BINNED, """
        SELECT feature,
               round(sum((greatest(nc / cn::DOUBLE, 1e-6) - greatest(nb / bn::DOUBLE, 1e-6))
                     * ln(greatest(nc / cn::DOUBLE, 1e-6) / greatest(nb / bn::DOUBLE, 1e-6))), 6) AS psi,
               any_value(bn) AS baseline_rows, any_value(cn) AS current_rows
        FROM bin JOIN span USING (feature) JOIN cur USING (feature) GROUP BY feature""")

    out["drift_sketches"] = _with(_BINNED, """
        SELECT feature, true AS near, bn AS baseline_rows, cn AS current_rows FROM span JOIN cur USING (feature)""")

    out["dq_existence"] = _with(_ENC, """
        SELECT CAST(d.day AS VARCHAR) AS dt, count(e.dt) AS row_count,
               CASE WHEN count(e.dt) > 0 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day
              FROM events) d
        LEFT JOIN enc e ON e.dt = CAST(d.day AS VARCHAR) GROUP BY d.day""")
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM waits"
        for c in ("arrival_time", "wait_triage_min", "wait_service_min", "total_wait_min", "los_min"))
    out["dq_nulls"] = _with(_WAITS, f"""
        SELECT column_name, row_count, null_count, round(null_count / row_count::DOUBLE, 6) AS null_rate,
               CASE WHEN null_count / row_count::DOUBLE <= 0.7 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM ({parts})""")
    out["dq_ts_range"] = _with(_ENC, """
        SELECT dt, count(*) AS row_count, count(*) FILTER (o) AS out_of_range,
               CASE WHEN count(*) FILTER (o) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT dt, arrival_time NOT BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-28 12:00:00' AS o
              FROM enc) GROUP BY dt""")
    out["dq_report"] = _with(_QUALITY_SILVER, """
        SELECT CAST(day AS VARCHAR) AS dt,
               CASE WHEN has_rows AND filled AND in_range THEN 'PASSED' ELSE 'FAILED' END AS status,
               CASE WHEN NOT has_rows THEN 'no rows' WHEN NOT filled THEN 'too many nulls: ' || lacking
                    WHEN NOT in_range THEN 'time out of range' END AS reason,
               concat_ws('|', CASE WHEN has_rows THEN 'existence' END, CASE WHEN has_rows AND filled THEN 'nulls' END,
                         CASE WHEN has_rows AND in_range THEN 'time_range' END) AS checks,
               row_count, null_count, out_of_range
        FROM judged""")

    out["text_rejects"] = """
        SELECT origin, count(*) FILTER (text <> '') AS accepted,
               count(*) FILTER (text IS NULL OR text = '') AS rejected
        FROM (SELECT 'documents' AS origin, text FROM documents
              UNION ALL SELECT 'conversations', text FROM conversations
              UNION ALL SELECT 'events', CASE WHEN event_type <> 'error' THEN props ELSE '' END FROM events)
        GROUP BY origin"""
    out["kb_chunks"] = out["stream_kb_chunks"] = _with(_CHUNKS, "SELECT source, chunk_no, text FROM chunks")
    out["stream_score_latest"] = _with(_FILLED, """
        SELECT sector_id, CAST(max(window_start) AS TIMESTAMP) AS prediction_ts, '202401300000' AS model_version,
               CAST(CAST(max(window_start) AS DATE) AS VARCHAR) AS dt, CAST(1 AS BIGINT) AS runs, true AS scored
        FROM filled GROUP BY sector_id""")
    out["kb_replaced_document"] = _with(_CHUNKS.replace("FROM documents,", """
  FROM (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN substring(text, 1, 1500) ELSE text END AS text
        FROM documents WHERE doc_id % 7 <> 0),"""), "SELECT source, chunk_no, text FROM chunks")
    out["kb_embed_hashing"] = _with(_CHUNKS + "," + _word_counts("cw", "source || '#' || CAST(chunk_no AS VARCHAR)", "chunks"), """
        SELECT c.source, c.chunk_no, CAST(coalesce(sum(w.n), 0) AS BIGINT) AS words, CAST(count(w.slot) AS INTEGER) AS slots,
               round(coalesce(sqrt(sum(w.n * w.n)), 0), 6) AS length
        FROM chunks c LEFT JOIN cw w ON w.id = c.source || '#' || CAST(c.chunk_no AS VARCHAR) GROUP BY c.source, c.chunk_no""")
    out["cosine_pairs"] = _with(_MEANS, """
        SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], mean), 6) AS similarity
        FROM embeddings JOIN means USING (label)""")
    out["knn_top3"] = _with(_MEANS + """,
scored AS (
  SELECT CAST(m.label AS BIGINT) AS query_id, e.vec_id AS corpus_id,
         round(list_cosine_similarity(e.embedding::DOUBLE[], m.mean), 9) AS similarity
  FROM embeddings e, means m)""", """
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS INTEGER) AS rank,
               corpus_id, round(similarity, 6) AS similarity
        FROM scored QUALIFY rank <= 3""")
    out["kb_top3"] = _with(_HITS, "SELECT query_id, rank, corpus_id, round(similarity, 6) AS similarity FROM top")
    out["kb_context"] = _with(_HITS, """
        SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM found GROUP BY query_id""")
    out["kb_citations"] = _with(_HITS, """
        SELECT query_id, string_agg(source, '|' ORDER BY rank) AS citations
        FROM (SELECT query_id, source, min(rank) AS rank FROM found GROUP BY ALL) GROUP BY query_id""")
    records = """
records AS (
  SELECT CASE WHEN k = 13 THEN 'category missing' WHEN severity = 'Severe' THEN 'severity not allowed'
              WHEN k = 7 THEN 'action missing' WHEN value / 20 NOT BETWEEN 0 AND 1 THEN 'confidence out of range'
              ELSE 'none' END AS problem, severity, value / 20 AS confidence, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt
  FROM (SELECT CAST(props->>'$.k' AS INTEGER) AS k, value, ts,
               ['Low', 'Medium', 'High', 'Critical', 'Severe'][CAST(props->>'$.k' AS INTEGER) % 5 + 1] AS severity
        FROM events))"""
    out["classify_validate"] = _with(records, """
        SELECT problem, severity, count(*) AS records FROM records GROUP BY problem, severity""")
    out["append_classifications"] = _with(records, """
        SELECT dt, severity, count(*) AS records, round(max(confidence), 6) AS top_confidence
        FROM records WHERE problem = 'none' GROUP BY dt, severity""")
    out["stream_hourly"] = _with(_SPARSE, """
        SELECT sector_id, window_start, arrivals_count, round(avg_triage_acuity, 6) AS avg_triage_acuity,
               CAST(CAST(window_start AS DATE) AS VARCHAR) AS dt
        FROM sparse WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
    return out
