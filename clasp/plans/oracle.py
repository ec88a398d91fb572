"""DuckDB SQL equal to each registered query (same keys, same column
names). The driver's views ``documents``, ``labels``, ``events`` ... are
assumed registered."""

from __future__ import annotations

from clasp.functions.stopwords import ENGLISH_STOP_WORDS
from clasp.plans.queries import ODD_EVERY, ODD_SCALARS, SEARCH_PATTERN, TEXT_TRAIN_PCT

RT = """rt AS (
  SELECT d.doc_id, d.text AS texto, l.quality AS etiqueta,
         CAST(d.n_chars >= 500 AS INTEGER) AS prediction, d.lang, d.source, d.n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

RTAB = """rtab AS (
  SELECT event_id, ts AS fecha_proceso, user_id, event_type, value, props,
         CAST(value > 100 AS INTEGER) AS prediction,
         CAST(event_type = 'error' AS INTEGER) AS label
  FROM events)"""

DM = """dm AS (
  SELECT CAST(fecha_proceso AS DATE) AS day,
         CASE WHEN count(*) > 0
              THEN round_even(CAST(count_if(label = prediction) AS DOUBLE) / count(*) * 100, 2)
              ELSE 0 END AS accuracy,
         count(*) AS n, max(fecha_proceso) AS fecha
  FROM rtab GROUP BY 1)"""


def _bucket(col: str) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 8))::BIGINT % 100 AS INTEGER)"


def _split(col: str, pct: int) -> str:
    return f"CASE WHEN {_bucket(col)} < {pct} THEN 'train' ELSE 'test' END"


WS = r"'[ \t\n\x0B\f\r]'"
STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
TOKENS = f"unnest(string_split_regex(lower(coalesce(text, '')), {WS}))"


def _pct(num: str, den: str, digits: int) -> str:
    return (f"CASE WHEN ({den}) > 0 THEN round_even(CAST({num} AS DOUBLE) / ({den}) * 100, {digits}) "
            f"ELSE 0 END")


def _resample(width: int) -> str:
    return f"""WITH {RTAB},
b AS (SELECT CAST(CAST(min(fecha_proceso) AS DATE) AS TIMESTAMP) AS o, min(fecha_proceso) AS mn,
             max(fecha_proceso) AS mx
      FROM rtab WHERE fecha_proceso IS NOT NULL),
c AS (SELECT CAST(floor(epoch(rtab.fecha_proceso - b.o) / {width}) AS BIGINT) AS idx,
             count(prediction) AS n
      FROM rtab, b WHERE rtab.fecha_proceso IS NOT NULL GROUP BY 1),
s AS (SELECT unnest(range(CAST(floor(epoch(b.mn - b.o) / {width}) AS BIGINT),
                          CAST(floor(epoch(b.mx - b.o) / {width}) AS BIGINT) + 1)) AS idx FROM b)
SELECT b.o + to_seconds(s.idx * {width}) AS bucket_start, coalesce(c.n, 0) AS n
FROM s CROSS JOIN b LEFT JOIN c ON s.idx = c.idx"""


LABELLED_SPLIT = f"""s AS (SELECT *, {_split('texto', TEXT_TRAIN_PCT)} AS split
                     FROM rt WHERE etiqueta IS NOT NULL)"""

METRICS_SQL = f"""SELECT {_pct("CAST(count_if(split = 'test' AND etiqueta IS NOT DISTINCT FROM prediction) AS BIGINT)",
                           "CAST(count_if(split = 'test') AS BIGINT)", 2)} AS accuracy,
       CAST(count_if(split = 'train') AS BIGINT) AS train_size, CAST(count_if(split = 'test') AS BIGINT) AS test_size
FROM s"""


ORACLE: dict[str, str] = {
    "table_scan": "SELECT * FROM events",
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    # inferred from the text: ids fit in 32 bits, so they come back as int
    "csv_inferred": """SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id,
       event_type, value, props FROM events""",
    "sink_overwrite": f"WITH {RT} SELECT doc_id, etiqueta, prediction FROM rt",
    "to_json_rows": "SELECT * FROM customer",
    "run_counters": f"""WITH {RT}, s AS (SELECT {_split('texto', TEXT_TRAIN_PCT)} AS split FROM rt)
SELECT count(*) AS processed, CAST(count_if(split = 'train') AS BIGINT) AS train, CAST(count_if(split = 'test') AS BIGINT) AS test FROM s""",
    "metrics_row": f"""WITH {RT}, {LABELLED_SPLIT}
SELECT accuracy, train_size, test_size, true AS stamped FROM ({METRICS_SQL})""",
    "project_rename": f"""WITH {RTAB}
SELECT event_type AS category, event_id, prediction, label AS heart_disease_label, fecha_proceso FROM rtab""",
    "json_decode": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""",
    "json_corrupt": """SELECT event_id,
       CASE WHEN event_id % 5 <> 0 THEN TRY_CAST(json_extract_string(CASE WHEN event_id % 5 <> 0 THEN props END, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 5 = 0 THEN 'broken ' || event_id END AS corrupt FROM events""",
    "stamp_rows": f"WITH {RT} SELECT doc_id, prediction, 'batch' AS pipeline, true AS stamped FROM rt",
    "typed_cast": """SELECT event_id, TRY_CAST(trunc(value) AS INTEGER) AS value_int,
       TRY_CAST(event_type AS INTEGER) AS event_type_int, props AS props_text FROM events""",
    "map_values": f"""WITH {RTAB}
SELECT event_id, prediction, event_type,
       CASE prediction WHEN 0 THEN 'Sano' WHEN 1 THEN 'Riesgo' END AS prediction_label,
       CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'v' END AS event_code
FROM rtab""",
    "ensure_columns": """SELECT doc_id, lang, 'desconocido' AS prediction,
       CAST(NULL AS TIMESTAMP) AS fecha_proceso FROM documents""",
    "stringify_ts": """WITH e AS (SELECT event_id, ts + to_microseconds((event_id % 3) * 123456) AS ts FROM events)
SELECT event_id,
       CASE WHEN ts IS NULL THEN NULL
            WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text
FROM e""",
    "parse_ts": """SELECT event_id,
       TRY_CAST(CASE WHEN event_type = 'error' THEN 'not a date' ELSE CAST(ts AS VARCHAR) END
                AS TIMESTAMP) AS parsed
FROM events""",
    "row_id": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS id FROM events",
    "infer_types": f"""WITH r AS (
  SELECT event_id,
         CASE WHEN event_id % {ODD_EVERY} < {len(ODD_SCALARS)} THEN {ODD_SCALARS!r}[event_id % {ODD_EVERY} + 1]
              WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR)
              WHEN event_type = 'view' THEN CAST(value AS VARCHAR)
              ELSE event_type END AS raw
  FROM events),
k AS (SELECT *, replace(trim(raw), '_', '') AS plain,
        CASE WHEN raw IS NULL THEN 'null'
             WHEN regexp_full_match(raw, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*') THEN 'int'
             WHEN regexp_full_match(lower(raw), '\\s*[+-]?(inf|infinity|nan|([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?)\\s*') THEN 'double'
             ELSE 'string' END AS kind FROM r)
SELECT event_id, kind,
       CASE WHEN kind = 'int' THEN CAST(CAST(plain AS HUGEINT) AS VARCHAR) END AS as_int,
       CASE WHEN kind IN ('int', 'double') AND lower(trim(raw)) <> 'nan' THEN CAST(plain AS DOUBLE) END AS as_double,
       raw AS as_text
FROM k""",
    "sorted_random_ts": """WITH draws AS (
  SELECT ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT % 7948801 AS off, doc_id FROM documents),
o AS (SELECT off, row_number() OVER (ORDER BY off, doc_id) AS k FROM draws),
d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS k FROM documents)
SELECT d.doc_id, d.lang, TIMESTAMP '2025-11-01' + to_seconds(o.off) AS fecha FROM d JOIN o USING (k)""",
    "filter_label_text": f"""WITH {RT}
SELECT count(*) AS n FROM rt WHERE typeof(etiqueta) = 'VARCHAR' AND CAST(etiqueta AS VARCHAR) = '1'""",
    "first_metrics": f"""WITH {RTAB}, {DM} SELECT day, accuracy, n, fecha FROM dm ORDER BY day LIMIT 1""",
    "truncated_table": "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after, 'event_id,event_type' AS columns FROM events",
    "required_rows": "SELECT count(*) AS n, true AS refused FROM events",
    "optional_enrichment": """WITH f AS (SELECT DISTINCT text FROM documents)
SELECT CAST(count_if(f.text IS NOT NULL) AS BIGINT) AS enriched, count(*) AS enriched_rows,
       CAST(0 AS BIGINT) AS left_alone, count(*) AS left_alone_rows
FROM conversations c LEFT JOIN f ON c.text = f.text""",
    "coerce_columns": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props
FROM events""",
    "guessed_json_rows": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props
FROM events""",
    "drop_incomplete": f"""WITH {RT}
SELECT doc_id, etiqueta, prediction FROM rt
WHERE doc_id IS NOT NULL AND etiqueta IS NOT NULL AND prediction IS NOT NULL""",
    "filter_label": f"WITH {RT} SELECT doc_id, etiqueta, prediction FROM rt WHERE etiqueta = 1",
    "filter_risk": f"WITH {RTAB} SELECT event_id, prediction FROM rtab WHERE prediction = 1",
    "count_correct": f"""WITH {RT}
SELECT CAST(count_if(etiqueta IS NOT DISTINCT FROM prediction) AS BIGINT) AS correct_store,
       CAST(count_if(etiqueta = prediction) AS BIGINT) AS correct_pandas FROM rt""",
    "search_text": f"WITH {RT} SELECT doc_id FROM rt WHERE regexp_matches(texto, '{SEARCH_PATTERN}', 'i')",
    "explore_counts": f"""WITH {RT}
SELECT CAST(count_if(coalesce(prediction = 1, false)
                AND coalesce(regexp_matches(texto, '{SEARCH_PATTERN}', 'i'), false)) AS BIGINT) AS shown,
       count(*) AS total FROM rt""",
    "dedup_first": """SELECT md5(text) AS text_md5, doc_id, lang FROM (
  SELECT doc_id, text, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""",
    "merge_coalesce": """WITH f AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text)
SELECT c.conv_id, c.turn, coalesce(f.doc_id, c.conv_id * 1000 + c.turn) AS ref
FROM conversations c LEFT JOIN f ON c.text = f.text""",
    "label_distribution": f"WITH {RT} SELECT etiqueta, count(*) AS total FROM rt GROUP BY etiqueta",
    "risk_distribution": f"""WITH {RTAB}
SELECT coalesce(CAST(prediction AS VARCHAR), 'None') AS prediction, count(*) AS total FROM rtab GROUP BY 1""",
    "value_counts": f"""WITH {RT}
SELECT etiqueta, count(*) AS count FROM rt WHERE etiqueta IS NOT NULL GROUP BY etiqueta""",
    "confusion_matrix": f"""WITH {RT}
SELECT etiqueta, prediction, count(*) AS n FROM rt
WHERE etiqueta IS NOT NULL AND prediction IS NOT NULL GROUP BY 1, 2""",
    "risk_by_category": f"""WITH {RTAB}, m AS (
  SELECT event_type, CASE prediction WHEN 0 THEN 'Sano' WHEN 1 THEN 'Riesgo' END AS prediction_label
  FROM rtab)
SELECT event_type, prediction_label, count(*) AS n FROM m
WHERE event_type IS NOT NULL AND prediction_label IS NOT NULL GROUP BY 1, 2""",
    "risk_summary": f"""WITH {RTAB}, {DM}
SELECT count(*) AS total, CAST(count_if(prediction = 1) AS BIGINT) AS high, CAST(count_if(prediction = 0) AS BIGINT) AS low,
       {_pct("CAST(count_if(prediction = 1) AS BIGINT)", "count(*)", 2)} AS high_pct,
       CAST(coalesce((SELECT arg_max(accuracy, fecha) FROM dm), 0) AS DOUBLE) AS model_accuracy
FROM rtab""",
    "label_stats": f"""WITH {RT},
per AS (SELECT etiqueta, count(*) AS n, CAST(count_if(etiqueta IS NOT DISTINCT FROM prediction) AS BIGINT) AS c
        FROM rt GROUP BY etiqueta),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(c) AS BIGINT) AS correct FROM per)
SELECT per.etiqueta, per.n, per.c AS class_correct, tot.total, tot.correct,
       {_pct("tot.correct", "tot.total", 2)} AS accuracy
FROM per, tot""",
    "risk_stats": f"""WITH {RTAB},
per AS (SELECT coalesce(CAST(prediction AS VARCHAR), 'None') AS prediction, count(*) AS n,
               CAST(count_if(label IS NOT DISTINCT FROM prediction) AS BIGINT) AS c
        FROM rtab GROUP BY 1),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(c) AS BIGINT) AS correct FROM per)
SELECT per.prediction, per.n, per.c AS class_correct, tot.total, tot.correct,
       {_pct("tot.correct", "tot.total", 2)} AS accuracy
FROM per, tot""",
    "kpi_row": f"""WITH {RTAB}, m AS (
  SELECT CASE prediction WHEN 0 THEN 'Sano' WHEN 1 THEN 'Riesgo' END AS pl FROM rtab)
SELECT count(*) AS total, CAST(count_if(pl = 'Riesgo') AS BIGINT) AS n_riesgo, CAST(count_if(pl = 'Sano') AS BIGINT) AS n_sano,
       {_pct("CAST(count_if(pl = 'Riesgo') AS BIGINT)", "count(*)", 1)} AS pct_riesgo,
       {_pct("CAST(count_if(pl = 'Sano') AS BIGINT)", "count(*)", 1)} AS pct_sano
FROM m""",
    "class_share": f"""WITH {RTAB},
vc AS (SELECT event_type, count(*) AS n FROM rtab WHERE event_type IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS tot FROM vc)
SELECT event_type, n, {_pct("n", "t.tot", 1)} AS pct FROM vc, t""",
    "append_ids": """SELECT row_number() OVER (ORDER BY event_id % 3, ts, event_id) AS id, event_id FROM events""",
    "running_counts": """SELECT CAST(s.step AS INTEGER) AS step, event_type, count(*) AS n
FROM events JOIN (SELECT unnest([0, 1, 2]) AS step) s ON event_id % 3 <= s.step GROUP BY 1, 2""",
    "running_buckets": _resample(420),
    "running_labels": """WITH c AS (SELECT CAST(quality AS VARCHAR) AS label, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS label_index FROM c""",
    "running_idf": f"""WITH m AS (SELECT count(*) AS m FROM documents),
t AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, {TOKENS} AS term FROM documents) WHERE term <> '' AND term NOT IN ({STOP})),
f AS (SELECT term, count(*) AS doc_freq FROM t GROUP BY term)
SELECT term, doc_freq, round(ln((m.m + 1) / (doc_freq + 1)), 6) AS idf FROM f, m""",
    "resample_7d": _resample(604800),
    "resample_1min": _resample(60),
    "holdout_accuracy": f"""WITH {RT}, {LABELLED_SPLIT}
SELECT CAST(count_if(etiqueta = prediction) AS DOUBLE) / count(*) AS accuracy, count(*) AS n
FROM s WHERE split = 'test'""",
    "accuracy_fallback": f"""WITH {RT}, {LABELLED_SPLIT},
m AS ({METRICS_SQL}),
c AS (SELECT {_pct("CAST(count_if(etiqueta = prediction) AS BIGINT)", "count(*)", 1)} AS computed FROM rt)
SELECT CAST(coalesce(m.accuracy, c.computed) AS DOUBLE) AS accuracy,
       CASE WHEN m.accuracy IS NOT NULL THEN 'metrics' ELSE 'computed' END AS source,
       c.computed AS computed_accuracy
FROM c LEFT JOIN m ON true""",
    "list_labelled": f"""WITH {RT}
SELECT doc_id, etiqueta, prediction, lang FROM rt WHERE etiqueta = 1
ORDER BY doc_id DESC LIMIT 50""",
    "latest_n": f"""WITH {RTAB}
SELECT event_id, fecha_proceso, event_type, prediction FROM rtab
ORDER BY fecha_proceso DESC NULLS LAST, event_id LIMIT 50""",
    "latest_by_risk": f"""WITH {RTAB}
SELECT event_id, fecha_proceso, prediction FROM rtab WHERE prediction = 1
ORDER BY fecha_proceso DESC NULLS LAST, event_id LIMIT 100""",
    "latest_metrics": f"""WITH {RTAB}, {DM}
SELECT day, accuracy, n, fecha FROM dm ORDER BY fecha DESC, day DESC LIMIT 1""",
    "token_counts": f"""SELECT token, count(*) AS n FROM (SELECT {TOKENS} AS token FROM documents)
WHERE token <> '' GROUP BY token""",
    "token_counts_nostop": f"""SELECT token, count(*) AS n FROM (SELECT {TOKENS} AS token FROM documents)
WHERE token <> '' AND token NOT IN ({STOP}) GROUP BY token""",
    "term_idf": f"""WITH m AS (SELECT count(*) AS m FROM documents),
t AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, {TOKENS} AS term FROM documents)
      WHERE term <> '' AND term NOT IN ({STOP})),
f AS (SELECT term, count(*) AS doc_freq FROM t GROUP BY term)
SELECT term, doc_freq, round(ln((m.m + 1) / (doc_freq + 1)), 6) AS idf FROM f, m""",
    "tfidf_top_terms": f"""WITH m AS (SELECT count(*) AS m FROM documents),
tok AS (SELECT doc_id, {TOKENS} AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok
       WHERE term <> '' AND term NOT IN ({STOP}) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS doc_freq FROM tf GROUP BY term),
sc AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * ln((m.m + 1) / (f.doc_freq + 1)) AS score
       FROM tf JOIN f ON tf.term = f.term, m),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank FROM sc)
SELECT doc_id, term, tf, round(score, 6) AS tfidf, rank FROM r WHERE rank <= 3""",
    "label_index": """WITH c AS (
  SELECT CAST(l.quality AS VARCHAR) AS label, count(*) AS n
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE l.quality IS NOT NULL GROUP BY 1)
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS label_index FROM c""",
    "label_index_tab": """WITH c AS (
  SELECT o.o_orderstatus AS label, count(*) AS n
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus IS NOT NULL GROUP BY 1)
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS label_index FROM c""",
    "hash_split": f"""WITH {RT}
SELECT doc_id, {_bucket('texto')} AS bucket, {_split('texto', TEXT_TRAIN_PCT)} AS split FROM rt""",
}
