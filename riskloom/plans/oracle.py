"""The registered queries as plain SQL, for comparison with another engine."""

from __future__ import annotations

from riskloom.constants import SPLIT_SEED, TRAIN_FRACTION

FACTS = """
WITH facts AS (
  SELECT n.n_name AS state, s.s_name AS county, CAST(l.l_shipdate AS DATE) AS date,
         CAST(FLOOR(l.l_extendedprice) AS INT)
           * CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN -1 ELSE 1 END AS cases,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS deaths,
         CASE WHEN l.l_linenumber = 1 THEN l.l_linestatus END AS note
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  JOIN nation n ON s.s_nationkey = n.n_nationkey),
scored AS (
  SELECT f.*, CAST(cases AS BIGINT) + CAST(deaths AS BIGINT) * 10 AS risk_score
  FROM facts f WHERE state IS NOT NULL AND county IS NOT NULL AND date IS NOT NULL
                 AND cases IS NOT NULL AND deaths IS NOT NULL),
preds AS (
  SELECT state, county, date, risk_score,
    CASE WHEN risk_score < 0 THEN 0 WHEN risk_score < 1000 THEN 1 WHEN risk_score < 10000 THEN 2
         WHEN risk_score < 100000 THEN 3 ELSE 4 END AS risk_category,
    CASE WHEN cases < 0 THEN 0 WHEN cases < 1000 THEN 1 WHEN cases < 10000 THEN 2
         WHEN cases < 100000 THEN 3 ELSE 4 END AS predicted_risk_category
  FROM scored),
labels5 AS (SELECT * FROM (VALUES (0,'Very Low'),(1,'Low'),(2,'Medium'),(3,'High'),
                                  (4,'Very High')) AS t(code, label)),
codes AS (SELECT n_name AS state, 'N' || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code
          FROM nation WHERE n_nationkey < 20)
"""

# The hash of a report's text decides its side.
SIDES = f"""
    SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', '{SPLIT_SEED}', state, county,
        CAST(date AS VARCHAR), CAST(cases AS VARCHAR), CAST(deaths AS VARCHAR))), 1, 8) AS BIGINT)
        % 10000 < {int(TRAIN_FRACTION * 10000)} THEN 'train' ELSE 'held_out' END AS side,
      CASE WHEN risk_score < 0 THEN 0 WHEN risk_score < 1000 THEN 1
           WHEN risk_score < 10000 THEN 2 WHEN risk_score < 100000 THEN 3
           ELSE 4 END AS risk_category
    FROM (SELECT * EXCLUDE (note) FROM scored)"""

HELD_OUT = f"""
    SELECT state, county, date, risk_category, TRUE AS accurate FROM ({SIDES})
    WHERE side = 'held_out'"""

# Usable reports with the counts of the report before in the county.
PREVIOUS = """
    SELECT state, county, date, cases, deaths,
           lag(cases) OVER county_order AS previous_cases,
           lag(deaths) OVER county_order AS previous_deaths
    FROM facts WHERE cases >= 0 AND deaths >= 0
    WINDOW county_order AS (PARTITION BY state, county ORDER BY date, cases, deaths)"""

# Arrivals of reports, the watermark at each, and whether a report is late for it: the end of
# its day has been passed by the latest day of the arrivals before, less 200 days.
ARRIVALS = """
    SELECT s.*, latest, CASE WHEN risk_score < 0 THEN 0 WHEN risk_score < 1000 THEN 1
             WHEN risk_score < 10000 THEN 2 WHEN risk_score < 100000 THEN 3 ELSE 4 END AS risk_category,
           coalesce(date + 1 <= latest - 200, FALSE) AS late
    FROM (SELECT *, CAST(YEAR(date) + CASE WHEN cases % 11 = 0 THEN 2 WHEN cases % 7 = 0 THEN 1
                         ELSE 0 END AS INT) AS arrival FROM scored) s
    JOIN (SELECT arrival, MAX(MAX(date)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING) AS latest
          FROM (SELECT date, CAST(YEAR(date) + CASE WHEN cases % 11 = 0 THEN 2
                       WHEN cases % 7 = 0 THEN 1 ELSE 0 END AS INT) AS arrival FROM scored)
          GROUP BY arrival) w USING (arrival)"""

PREDICTED_ROWS = """
    SELECT state, county, date, risk_category, predicted_risk_category FROM preds"""

ON_FACTS = {
    "risk_score": "SELECT state, county, date, cases, deaths, risk_score FROM scored",
    "risk_bucketize": """
        SELECT risk_category, COUNT(*) AS n, MIN(risk_score) AS lo, MAX(risk_score) AS hi
        FROM preds GROUP BY risk_category""",
    "ingest_partition_columns": """
        SELECT CAST(YEAR(date) AS VARCHAR) AS annee,
               LPAD(CAST(MONTH(date) AS VARCHAR), 2, '0') AS mois,
               LPAD(CAST(DAY(date) AS VARCHAR), 2, '0') AS jour, COUNT(*) AS n
        FROM facts GROUP BY 1, 2, 3""",
    "year_slice": "SELECT state, county, date, cases, deaths FROM facts WHERE YEAR(date) = 2000",
    "non_null_counts": """
        SELECT COUNT(*) AS total_rows, COUNT(cases) AS cases, COUNT(deaths) AS deaths,
               COUNT(note) AS note FROM facts""",
    "sparse_columns_dropped": "SELECT state, county, date, cases, deaths FROM facts",
    "drop_incomplete": """
        SELECT state, county, date, cases, deaths FROM facts WHERE deaths IS NOT NULL""",
    "quarantine_counts": """
        SELECT CASE WHEN cases < 0 OR deaths IS NULL THEN 'bad' ELSE 'good' END AS bin,
               COUNT(*) AS n FROM facts GROUP BY 1""",
    "quarantine_reasons": """
        SELECT CASE WHEN deaths IS NULL THEN 'missing_count' ELSE 'negative_count' END AS reason,
               COUNT(*) AS n
        FROM facts WHERE deaths IS NULL OR cases < 0 GROUP BY 1""",
    "latest_reports": """
        SELECT state, county, date, cases, deaths, copies FROM (
          SELECT state, county, date, cases, deaths,
                 COUNT(*) OVER (PARTITION BY state, county, date) AS copies,
                 ROW_NUMBER() OVER (PARTITION BY state, county, date
                                    ORDER BY cases DESC, deaths DESC) AS pos
          FROM facts WHERE deaths IS NOT NULL AND cases >= 0) ranked
        WHERE pos = 1""",
    "category_labels": """
        SELECT p.state, p.county, p.date, a.label AS risk_category_text,
               b.label AS predicted_risk_category_text
        FROM preds p LEFT JOIN labels5 a ON p.risk_category = a.code
                     LEFT JOIN labels5 b ON p.predicted_risk_category = b.code""",
    "state_codes": """
        SELECT DISTINCT p.state, c.state_code
        FROM preds p LEFT JOIN codes c ON p.state = c.state""",
    "unmatched_states": """
        SELECT p.state, COUNT(*) AS n FROM preds p LEFT JOIN codes c ON p.state = c.state
        WHERE c.state_code IS NULL GROUP BY p.state""",
    "enriched_predictions": """
        SELECT p.state, p.county, p.date, p.risk_category, p.predicted_risk_category,
               '2024-01-01 00:00:00' AS timestamp, a.label AS risk_category_text,
               b.label AS predicted_risk_category_text, c.state_code
        FROM preds p JOIN labels5 a ON p.risk_category = a.code
                     JOIN labels5 b ON p.predicted_risk_category = b.code
                     LEFT JOIN codes c ON p.state = c.state""",
    "report_summary": """
        SELECT p.state, c.state_code, date, risk_category, predicted_risk_category,
               COUNT(*) AS report_rows
        FROM preds p LEFT JOIN codes c ON p.state = c.state GROUP BY ALL""",
    "category_distribution": """
        SELECT label AS risk_category_text, COUNT(*) AS n
        FROM preds JOIN labels5 ON risk_category = code GROUP BY label""",
    "actual_vs_predicted": """
        SELECT risk_category, predicted_risk_category, COUNT(*) AS n FROM preds GROUP BY 1, 2""",
    "confusion_matrix": """
        SELECT risk_category,
               COUNT(*) FILTER (WHERE predicted_risk_category = 0) AS predicted_0,
               COUNT(*) FILTER (WHERE predicted_risk_category = 1) AS predicted_1,
               COUNT(*) FILTER (WHERE predicted_risk_category = 2) AS predicted_2,
               COUNT(*) FILTER (WHERE predicted_risk_category = 3) AS predicted_3,
               COUNT(*) FILTER (WHERE predicted_risk_category = 4) AS predicted_4
        FROM preds GROUP BY 1""",
    "risk_over_time": """
        SELECT date, label AS risk_category_text, COUNT(*) AS n
        FROM preds JOIN labels5 ON risk_category = code GROUP BY date, label""",
    "mean_risk_by_state": """
        SELECT p.state, c.state_code, AVG(p.risk_category) AS risk_level
        FROM preds p JOIN codes c ON p.state = c.state GROUP BY p.state, c.state_code""",
    "mean_risk_by_state_nocode": """
        SELECT state, AVG(risk_category) AS risk_level FROM preds GROUP BY state""",
    "top_high_risk_states": """
        SELECT state, COUNT(*) AS high_risk_rows FROM preds WHERE risk_category >= 3
        GROUP BY state ORDER BY 2 DESC, 1 LIMIT 10""",
    "top_high_risk_states_distinct": """
        SELECT state, COUNT(DISTINCT county) AS high_risk_counties FROM preds
        WHERE risk_category >= 3 GROUP BY state ORDER BY 2 DESC, 1 LIMIT 10""",
    "high_risk_table": """
        SELECT state AS "State", county AS "County", date AS "Date", label AS "Risk Category"
        FROM preds JOIN labels5 ON risk_category = code WHERE risk_category >= 3""",
    "filter_options": """
        SELECT MIN(date) AS min_date, MAX(date) AS max_date, COUNT(DISTINCT state) AS states,
               COUNT(DISTINCT risk_category) AS categories FROM preds""",
    "state_options": "SELECT DISTINCT state FROM preds WHERE state IS NOT NULL",
    "category_options": """
        SELECT DISTINCT label AS risk_category_text
        FROM preds JOIN labels5 ON risk_category = code""",
    "date_bounds": "SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM preds",
    "filtered_predictions": """
        SELECT state AS "State", county AS "County", date AS "Date",
               a.label AS "Risk Category", b.label AS "Predicted Risk"
        FROM preds p JOIN labels5 a ON p.risk_category = a.code
                     JOIN labels5 b ON p.predicted_risk_category = b.code
        WHERE state = 'NATION_3' AND a.label = 'High'
          AND date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""",
    "filtered_count": """
        SELECT COUNT(*) AS n FROM preds
        WHERE risk_category = 4 AND date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""",
    "dashboard_from_summary": """
        SELECT state, AVG(risk_category) AS risk_level,
               NULLIF(COUNT(*) FILTER (WHERE risk_category >= 3), 0) AS high_risk_rows
        FROM preds GROUP BY state""",
    "display_view": """
        SELECT state AS "State", county AS "County", date AS "Date",
               a.label AS "Risk Category", b.label AS "Predicted Risk"
        FROM preds p JOIN labels5 a ON p.risk_category = a.code
                     JOIN labels5 b ON p.predicted_risk_category = b.code""",
    "profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT({c}) AS filled_rows,
                   CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value,
                   ROUND(AVG({c}), 6) AS mean_value, ROUND(STDDEV({c}), 6) AS stddev_value
            FROM (SELECT cases, deaths, CAST(cases AS BIGINT) + CAST(deaths AS BIGINT) * 10
                         AS risk_score FROM facts) q"""
        for c in ("cases", "deaths", "risk_score")
    ),
    "correlations": " UNION ALL ".join(
        f"""SELECT '{a}' AS left_column, '{b}' AS right_column,
                   ROUND(CORR({a}, {b}), 6) AS correlation FROM scored"""
        for a, b in (("cases", "deaths"), ("cases", "risk_score"), ("deaths", "risk_score"))
    ),
    "union_feeds": """
        SELECT state, county, date, cases, deaths, 'lines' AS source FROM facts
        UNION ALL
        SELECT n_name, c_name, CAST(o_orderdate AS DATE), CAST(FLOOR(o_totalprice) AS INT),
               CAST(NULL AS INT), 'orders'
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        """,
    "csv_ingest": """
        SELECT state, county, date, cases, deaths, CAST(MONTH(date) AS INT) AS mois,
               CAST(DAY(date) AS INT) AS jour FROM facts""",
    "partitioned_year": """
        SELECT state, county, date, cases, deaths, CAST(MONTH(date) AS INT) AS mois,
               CAST(DAY(date) AS INT) AS jour FROM facts WHERE YEAR(date) = 2000""",
    "ingest_report": """
        SELECT COUNT(*) AS read_rows, COUNT(*) AS written_rows, 8 AS n_columns, 0 AS dropped,
               CAST(0 AS BIGINT) AS unparsed_dates, CAST(0 AS BIGINT) AS unreadable_lines
        FROM facts""",
    "export_csv": """
        SELECT state AS "State", county AS "County", date AS "Date",
               a.label AS "Risk Category", b.label AS "Predicted Risk"
        FROM preds p JOIN labels5 a ON p.risk_category = a.code
                     JOIN labels5 b ON p.predicted_risk_category = b.code""",
    "message_text": """
        SELECT '{"state":"' || state || '","county":"' || county || '","date":"'
               || CAST(date AS VARCHAR) || '","cases":' || CAST(cases AS VARCHAR)
               || ',"deaths":' || CAST(deaths AS VARCHAR)
               || ',"mois":' || CAST(MONTH(date) AS VARCHAR)
               || ',"jour":' || CAST(DAY(date) AS VARCHAR) || '}' AS value
        FROM scored""",
    "json_round_trip": """
        SELECT state, county, date, cases, deaths, CAST(MONTH(date) AS INT) AS mois,
               CAST(DAY(date) AS INT) AS jour FROM scored""",
    "stream_scoring": PREDICTED_ROWS,
    "stream_to_files": PREDICTED_ROWS,
    "stream_restarted": PREDICTED_ROWS,
    "live_distribution_of_risk": """
        SELECT date AS day, risk_category, COUNT(*) AS n FROM preds GROUP BY 1, 2""",
    "feature_rows": """
        SELECT state, county, date, CAST(MONTH(date) AS DOUBLE) AS mois,
               CAST(DAY(date) AS DOUBLE) AS jour, CAST(risk_score AS DOUBLE) AS risk_score,
               CAST(risk_category AS DOUBLE) AS risk_category
        FROM preds""",
    "training_weights": """
        SELECT CAST(MONTH(date) AS INT) AS mois, CAST(DAY(date) AS INT) AS jour, risk_score,
               CAST(risk_category AS DOUBLE) AS risk_category, CAST(COUNT(*) AS DOUBLE) AS weight
        FROM preds GROUP BY 1, 2, 3, 4""",
    "train_test_split": SIDES,
    "model_train_predict": HELD_OUT,
    "model_unweighted_forest": HELD_OUT,
    "model_logistic": HELD_OUT,
    "model_svm": HELD_OUT,
    "model_folds": f"""
        SELECT fold, state, COUNT(*) AS n, CAST(SUM(cases) AS BIGINT) AS cases,
               MIN(county) AS first_county, MAX(date) AS last_date
        FROM (SELECT *, CAST(CAST('0x' || substr(md5(concat_ws('|', '{SPLIT_SEED}', state, county,
                CAST(date AS VARCHAR), CAST(cases AS VARCHAR), CAST(deaths AS VARCHAR))), 9, 8)
                AS BIGINT) % 3 AS INT) AS fold FROM ({SIDES}) WHERE side = 'train')
        GROUP BY fold, state""",
    "model_selection": f"""
        SELECT candidate, candidate = 'logistic' AS chosen, TRUE AS accurate,
               (SELECT COUNT(*) FROM ({SIDES}) WHERE side = 'train') AS judged_rows
        FROM (VALUES ('forest'), ('shallow_forest'), ('logistic'), ('svm')) AS c(candidate)""",
    "model_evaluate": f"""
        SELECT COUNT(*) AS scored_rows, TRUE AS accuracy, TRUE AS weighted_precision,
               TRUE AS weighted_recall, TRUE AS f1 FROM ({HELD_OUT})""",
    "model_stream_scoring": """
        SELECT risk_category, COUNT(*) AS agreeing FROM preds GROUP BY risk_category""",
    "quantile_ranks": """
        SELECT column_name, quantile, TRUE AS within
        FROM (VALUES ('cases'), ('deaths'), ('risk_score')) AS c(column_name),
             (VALUES ('p25'), ('p50'), ('p75')) AS q(quantile)""",
    "ingest_latest": """
        SELECT state, county, date, cases, deaths, CAST(MONTH(date) AS INT) AS mois,
               CAST(DAY(date) AS INT) AS jour
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY state, county, date
                                           ORDER BY cases DESC, deaths DESC) AS place
              FROM facts WHERE cases >= 0 AND deaths >= 0) WHERE place = 1""",
    "distinct_counts": """
        SELECT column_name, COUNT(value) AS filled_rows, COUNT(DISTINCT value) AS distinct_values,
               TRUE AS within
        FROM (SELECT 'state' AS column_name, state AS value FROM facts
              UNION ALL SELECT 'county', county FROM facts
              UNION ALL SELECT 'date', CAST(date AS VARCHAR) FROM facts
              UNION ALL SELECT 'cases', CAST(cases AS VARCHAR) FROM facts
              UNION ALL SELECT 'deaths', CAST(deaths AS VARCHAR) FROM facts)
        GROUP BY column_name""",
    "frequent_values": """
        SELECT column_name, value, COUNT(*) AS n
        FROM (SELECT 'state' AS column_name, state AS value FROM facts
              UNION ALL SELECT 'county', county FROM facts
              UNION ALL SELECT 'deaths', CAST(deaths AS VARCHAR) FROM facts
              UNION ALL SELECT 'cases', CAST(cases AS VARCHAR) FROM facts
              UNION ALL SELECT 'note', note FROM facts)
        WHERE value IS NOT NULL GROUP BY column_name, value
        HAVING COUNT(*) > 0.005 * (SELECT COUNT(*) FROM facts)""",
    "falling_reports": f"""
        SELECT *, 'falling_count' AS reason FROM ({PREVIOUS})
        WHERE cases < previous_cases OR deaths < previous_deaths""",
    "rising_reports": f"""
        SELECT state, COUNT(*) AS n, CAST(SUM(cases) AS BIGINT) AS cases FROM ({PREVIOUS})
        WHERE NOT coalesce(cases < previous_cases OR deaths < previous_deaths, FALSE)
        GROUP BY state""",
    "stream_deduplicated": """
        SELECT state, county, date, risk_category, predicted_risk_category
        FROM (SELECT DISTINCT * EXCLUDE (note),
                CASE WHEN risk_score < 0 THEN 0 WHEN risk_score < 1000 THEN 1
                     WHEN risk_score < 10000 THEN 2 WHEN risk_score < 100000 THEN 3
                     ELSE 4 END AS risk_category,
                CASE WHEN cases < 0 THEN 0 WHEN cases < 1000 THEN 1 WHEN cases < 10000 THEN 2
                     WHEN cases < 100000 THEN 3 ELSE 4 END AS predicted_risk_category
              FROM scored)""",
    "live_finished_days": f"""
        SELECT date AS day, risk_category, COUNT(*) AS n,
               date + 1 <= (SELECT MAX(date) - 200 FROM scored) AS finished
        FROM ({ARRIVALS}) WHERE NOT late GROUP BY date, risk_category""",
    "live_late_reports": f"""
        SELECT arrival, COUNT(*) AS usable_rows,
               COUNT(DISTINCT CASE WHEN late THEN date || '/' || risk_category END) AS late_groups,
               (SELECT COUNT(*) FROM ({ARRIVALS}) WHERE NOT late) AS held_rows
        FROM ({ARRIVALS}) GROUP BY arrival""",
    "summary_followed": """
        SELECT p.state, c.state_code, date, risk_category, predicted_risk_category,
               COUNT(*) AS report_rows
        FROM preds p LEFT JOIN codes c ON p.state = c.state GROUP BY ALL""",
    "stream_compacted": PREDICTED_ROWS,
    "feeds_resolved": """
        , feeds AS (
          SELECT n_name AS state, c_name AS county, CAST(o_orderdate AS DATE) AS date,
                 CAST(FLOOR(o_totalprice) AS INT) AS cases, CAST(NULL AS INT) AS deaths,
                 'orders' AS source, 0 AS place
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          UNION ALL SELECT state, county, date, cases, deaths, 'lines', 1 FROM facts),
        weeks AS (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week FROM feeds),
        found AS (
          SELECT state, week, COUNT(*) AS reports,
                 CASE WHEN MAX(place) = 0 THEN 'orders' WHEN MIN(place) = 1 THEN 'lines'
                      ELSE 'orders,lines' END AS sources,
                 concat_ws(',', CASE WHEN MIN(county) <> MAX(county) THEN 'county' END,
                                CASE WHEN MIN(cases) <> MAX(cases) THEN 'cases' END,
                                CASE WHEN MIN(deaths) <> MAX(deaths) THEN 'deaths' END) AS differing
          FROM weeks GROUP BY state, week)
        SELECT w.state, w.county, w.date, w.cases, w.deaths, w.source, w.week, f.reports,
               f.sources, f.differing
        FROM weeks w JOIN found f USING (state, week)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY state, week ORDER BY place, date DESC, county DESC,
                                   cases DESC NULLS LAST, deaths DESC NULLS LAST) = 1""",
    "ingest_arrivals": """
        SELECT state, county, date, cases, deaths, CAST(MONTH(date) AS INT) AS mois,
               CAST(DAY(date) AS INT) AS jour FROM facts""",
    "ingest_arrival_counts": """
        SELECT CAST(((coalesce(cases, 0) % 3) + 3) % 3 AS INT) AS arrival, COUNT(*) AS read_rows,
               CAST(0 AS BIGINT) AS unparsed_dates, CAST(0 AS BIGINT) AS unreadable_lines
        FROM facts GROUP BY 1""",
    "message_quality": """
        SELECT COUNT(*) AS messages,
               COUNT(*) FILTER (WHERE NOT gone AND cases >= 0 AND deaths IS NOT NULL) AS good,
               COUNT(*) FILTER (WHERE gone) AS undecodable,
               COUNT(*) FILTER (WHERE NOT gone AND cases < 0) AS bad_date,
               COUNT(*) FILTER (WHERE NOT gone AND cases >= 0 AND deaths IS NULL)
                 AS missing_count,
               CAST(0 AS BIGINT) AS missing_key
        FROM (SELECT *, coalesce(note = 'F', FALSE) AS gone FROM facts)""",
    "evaluation_metrics": """
        , pairs AS (SELECT risk_category AS a, predicted_risk_category AS p, COUNT(*) AS n
                    FROM preds GROUP BY 1, 2),
        by_label AS (
          SELECT code, COALESCE(SUM(n) FILTER (WHERE a = code), 0) AS support,
                 COALESCE(SUM(n) FILTER (WHERE p = code), 0) AS claimed,
                 COALESCE(SUM(n) FILTER (WHERE a = code AND p = code), 0) AS hits
          FROM labels5 JOIN pairs ON a = code OR p = code GROUP BY code)
        SELECT CAST(SUM(support) AS BIGINT) AS scored_rows,
               ROUND(SUM(hits) / SUM(support), 10) AS accuracy,
               ROUND(SUM(CASE WHEN claimed > 0 THEN CAST(support AS DOUBLE) * hits / claimed
                              ELSE 0 END) / SUM(support), 10) AS weighted_precision,
               ROUND(SUM(hits) / SUM(support), 10) AS weighted_recall,
               ROUND(SUM(CAST(support AS DOUBLE) * 2 * hits / (support + claimed))
                     / SUM(support), 10) AS f1
        FROM by_label""",
}

ON_TABLES = {
    "json_decode_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
    "live_distribution_of_events": """
        SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2""",
}


def statements() -> dict[str, str]:
    return {**{name: FACTS + sql for name, sql in ON_FACTS.items()}, **ON_TABLES}
