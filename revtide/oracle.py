"""The registered queries in SQL for DuckDB, written independently of the operators.

``CTES`` repeats the definitions of ``fixtures.py``; a query lists the ones it reads and gets them,
with what they need, as its WITH clause.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_raw": ((), """
        SELECT CASE WHEN event_id % 211 = 0 THEN '' WHEN event_id % 223 = 0 THEN NULL
                    ELSE event_type || '_' || CAST(user_id AS VARCHAR) END AS series_id,
          CASE WHEN event_id % 307 = 0 THEN '2024-1-5' WHEN event_id % 313 = 0 THEN '2024-13-01'
               WHEN event_id % 401 = 0 THEN NULL
               ELSE strftime(date_trunc('week', ts), '%Y-%m-%d') END AS date,
          CASE WHEN event_id % 29 = 0 THEN '.' WHEN event_id % 101 = 0 THEN NULL
               WHEN event_id % 103 = 0 THEN '' WHEN event_id % 251 = 0 THEN 'n/a'
               WHEN event_id % 503 = 0 THEN '99999.5' ELSE CAST(value AS VARCHAR) END AS value,
          CAST(floor(user_id / 10) + 9 + CASE WHEN event_type = 'purchase' AND event_id % 2 = 1
               THEN 100000 ELSE 0 END AS INTEGER) AS release_id,
          CASE event_id % 4 WHEN 0 THEN '2024-02-01' WHEN 1 THEN '2024-02-08'
               WHEN 2 THEN '2024-02-15' ELSE '2024-02-22' END AS vintage_date,
          strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS collected_at
        FROM events"""),
    "fx_typed": (("fx_raw",), """
        SELECT series_id, date AS date_str, value AS value_str, release_id, collected_at,
          CASE WHEN regexp_matches(date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
               THEN TRY_CAST(date AS DATE) END AS date,
          CASE WHEN value <> '.' THEN TRY_CAST(value AS DOUBLE) END AS value,
          CAST(vintage_date AS DATE) AS vintage_date
        FROM fx_raw"""),
    "fx_snapshots": (("fx_typed",), """
        SELECT series_id, date, value, value_str, vintage_date, release_id FROM (
          SELECT *, row_number() OVER (PARTITION BY release_id, series_id, date, vintage_date
                                       ORDER BY value_str DESC NULLS LAST) AS rn
          FROM fx_typed WHERE series_id <> '' AND date IS NOT NULL)
        WHERE rn = 1"""),
    "fx_ingested": (("fx_typed",), """
        SELECT series_id, date, value, value_str, vintage_date, release_id FROM (
          SELECT *, row_number() OVER (PARTITION BY release_id, series_id, date, vintage_date
            ORDER BY collected_at DESC NULLS LAST, value_str DESC NULLS LAST) AS rn
          FROM fx_typed WHERE series_id IS NOT NULL AND date IS NOT NULL)
        WHERE rn = 1"""),
    "fx_snapshots_big": ((), """
        SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id,
          CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
          CASE l_linenumber % 4 WHEN 0 THEN DATE '2002-01-01' WHEN 1 THEN DATE '2002-02-01'
               WHEN 2 THEN DATE '2002-03-01' ELSE DATE '2002-04-01' END AS vintage_date,
          CAST(floor(l_suppkey / 25) + 9 AS INTEGER) AS release_id,
          max(l_extendedprice) AS value
        FROM lineitem GROUP BY ALL"""),
    "fx_unchanged": (("fx_snapshots_big",), """
        SELECT * FROM fx_snapshots_big WHERE vintage_date <= DATE '2002-02-01'
        UNION ALL BY NAME SELECT * REPLACE (DATE '2002-03-01' AS vintage_date) FROM fx_snapshots_big
        WHERE vintage_date = DATE '2002-01-01'"""),
    "fx_metadata": ((), """
        SELECT min(event_type) || '_' || CAST(user_id AS VARCHAR) AS series_id,
          min(event_type) AS title, 'W' AS frequency, 'index' AS units,
          CAST(floor(user_id / 10) + 9 AS INTEGER) AS release_id
        FROM events GROUP BY user_id"""),
    "fx_metadata_new": ((), """
        SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS series_id,
          'new ' || event_type AS title, 'W' AS frequency, 'index' AS units,
          CAST(floor(user_id / 10) + 9 AS INTEGER) AS release_id
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn = 1"""),
    "fx_releases": ((), """
        SELECT CAST(id AS INTEGER) AS release_id, 'Release ' || CAST(id AS VARCHAR) AS release_name,
          'https://example.org/' || CAST(id AS VARCHAR) AS link,
          0 AS observations_count, 'pending' AS collection_status
        FROM (SELECT c_custkey AS id FROM customer
              UNION ALL SELECT -2 * s_suppkey - 2 FROM supplier)"""),
    "fx_releases_new": ((), """
        SELECT CAST(id AS INTEGER) AS release_id, CAST(count(*) AS INTEGER) AS observations_count,
          'Updated ' || CAST(id AS VARCHAR) AS release_name, 'success' AS collection_status
        FROM (SELECT o_custkey AS id FROM orders UNION ALL SELECT -1 - n_nationkey FROM nation)
        GROUP BY id"""),
    "fx_attempts": ((), """
        SELECT CAST(o_custkey AS INTEGER) AS release_id, o_orderkey AS attempt,
          CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status,
          CAST(floor(o_totalprice / 100) AS BIGINT) AS observations,
          o_orderkey % 50 + 1 AS series, o_orderkey % 4 + 1 AS api_calls,
          o_totalprice < 400000 AS qc_valid, o_orderkey % 5 AS qc_warnings,
          CASE WHEN o_totalprice < 400000 THEN 0 ELSE o_orderkey % 3 + 1 END AS qc_errors,
          CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error
        FROM orders"""),
    "fx_outcomes": (("fx_attempts",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY release_id ORDER BY attempt DESC) AS rn,
            count(*) OVER (PARTITION BY release_id) AS attempts
          FROM fx_attempts)
        WHERE rn = 1"""),
    "fx_totals": (("fx_outcomes",), """
        SELECT count(*) AS total_releases,
          count(*) FILTER (WHERE status = 'success') AS successful,
          count(*) FILTER (WHERE status <> 'success') AS failed,
          CAST(coalesce(sum(observations) FILTER (WHERE status = 'success'), 0) AS BIGINT)
            AS total_observations,
          CAST(coalesce(sum(series) FILTER (WHERE status = 'success'), 0) AS BIGINT)
            AS total_series,
          CAST(coalesce(sum(api_calls), 0) AS BIGINT) AS api_calls,
          count(*) FILTER (WHERE status = 'success' AND qc_valid) AS qc_passed,
          count(*) FILTER (WHERE status = 'success' AND NOT qc_valid) AS qc_failed,
          CAST(coalesce(sum(qc_warnings) FILTER (WHERE status = 'success'), 0) AS BIGINT)
            AS qc_warnings,
          CAST(coalesce(sum(qc_errors) FILTER (WHERE status = 'success'), 0) AS BIGINT)
            AS qc_errors,
          CAST(coalesce(sum(attempts - 1), 0) AS BIGINT) AS retries_attempted,
          count(*) FILTER (WHERE attempts > 1 AND status = 'success') AS retries_succeeded
        FROM fx_outcomes"""),
    "fx_runs": ((), """
        SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS etl_run_id,
          CAST(o_orderkey % 10 + 9 AS INTEGER) AS release_id, o_orderdate AS started_at,
          CAST(NULL AS TIMESTAMP) AS completed_at, 'running' AS status,
          CAST(NULL AS DOUBLE) AS duration_seconds
        FROM orders
        UNION ALL
        SELECT 'run-' || CAST(o_orderkey AS VARCHAR), CAST(o_orderkey % 10 + 9 AS INTEGER),
          o_orderdate, o_orderdate + to_seconds(o_orderkey % 3600 + 1),
          CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END,
          CAST(o_orderkey % 3600 + 1 AS DOUBLE)
        FROM orders WHERE o_orderstatus <> 'P'"""),
    "fx_run_status": (("fx_runs",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY etl_run_id, release_id
            ORDER BY coalesce(completed_at, started_at) DESC, completed_at DESC NULLS LAST) AS rn
          FROM fx_runs)
        WHERE rn = 1"""),
    "fx_dedup": (("fx_raw",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY series_id, date
            ORDER BY collected_at DESC NULLS LAST, release_id, vintage_date DESC NULLS LAST,
              value DESC NULLS LAST) AS rn
          FROM fx_raw)
        WHERE rn = 1"""),
    "fx_points": (("fx_raw",), """
        SELECT release_id, series_id, date, count(*) AS n,
          count(*) FILTER (WHERE value IS NULL OR value = '') AS null_values
        FROM fx_raw GROUP BY release_id, series_id, date"""),
    "fx_limits": (("fx_typed",), """
        SELECT release_id, CASE WHEN count(value) > 10
          THEN abs(avg(value)) + 5 * stddev_samp(value) END AS outlier_limit
        FROM fx_typed GROUP BY release_id"""),
    "fx_outliers": (("fx_typed", "fx_limits"), """
        SELECT t.release_id,
          count(*) FILTER (WHERE abs(t.value) > l.outlier_limit) AS value_outliers
        FROM fx_typed t JOIN fx_limits l ON t.release_id = l.release_id GROUP BY t.release_id"""),
    "fx_expected": (("fx_raw", "fx_releases"), """
        SELECT release_id FROM fx_raw UNION SELECT release_id FROM fx_releases"""),
    "fx_quality": (("fx_raw", "fx_points", "fx_outliers", "fx_metadata", "fx_expected"), """
        SELECT *, qc_errors = 0 AND null_values < obs_count * 0.1 AS is_valid FROM (
          SELECT *,
            empty_series_ids + invalid_dates + CASE WHEN obs_count = 0 THEN 1 ELSE 0 END
              AS qc_errors,
            null_values + duplicate_observations + series_without_metadata
              + CASE WHEN value_outliers > 0 THEN 1 ELSE 0 END
              + CASE WHEN metadata_count = 0 THEN 1 ELSE 0 END AS qc_warnings
          FROM (
            SELECT e.release_id,
              coalesce(r.obs_count, 0) AS obs_count, coalesce(r.series_count, 0) AS series_count,
              coalesce(r.empty_series_ids, 0) AS empty_series_ids,
              coalesce(r.invalid_dates, 0) AS invalid_dates,
              coalesce(r.null_values, 0) AS null_values,
              coalesce(d.duplicates, 0) AS duplicate_observations,
              coalesce(m.missing, 0) AS series_without_metadata,
              coalesce(o.value_outliers, 0) AS value_outliers,
              coalesce(k.metadata_count, 0) AS metadata_count
            FROM fx_expected e
            LEFT JOIN (
              SELECT release_id, count(*) AS obs_count,
                count(DISTINCT coalesce(series_id, '<null>')) AS series_count,
                count(*) FILTER (WHERE series_id IS NULL OR series_id = '') AS empty_series_ids,
                count(*) FILTER (WHERE date IS NULL OR date = '') AS invalid_dates,
                count(*) FILTER (WHERE value IS NULL OR value = '') AS null_values
              FROM fx_raw GROUP BY release_id) r ON r.release_id = e.release_id
            LEFT JOIN (SELECT release_id, CAST(sum(n - 1) AS BIGINT) AS duplicates
                       FROM fx_points GROUP BY release_id) d ON d.release_id = e.release_id
            LEFT JOIN (
              SELECT release_id, count(*) AS missing
              FROM (SELECT DISTINCT release_id, series_id FROM fx_raw) s
              WHERE NOT EXISTS (SELECT 1 FROM fx_metadata m WHERE m.series_id = s.series_id)
              GROUP BY release_id) m ON m.release_id = e.release_id
            LEFT JOIN fx_outliers o ON o.release_id = e.release_id
            LEFT JOIN (SELECT release_id, count(*) AS metadata_count
                       FROM fx_metadata GROUP BY release_id) k ON k.release_id = e.release_id))"""),
    "fx_issues": (("fx_points", "fx_raw", "fx_outliers", "fx_metadata", "fx_expected"), """
        SELECT release_id, series_id, date, 'error' AS kind, 'empty_series_id' AS issue,
          n AS occurrences FROM fx_points WHERE series_id IS NULL OR series_id = ''
        UNION ALL SELECT release_id, series_id, date, 'error', 'missing_date', n
          FROM fx_points WHERE date IS NULL OR date = ''
        UNION ALL SELECT release_id, series_id, date, 'warning', 'null_value', null_values
          FROM fx_points WHERE null_values > 0
        UNION ALL SELECT release_id, series_id, date, 'warning', 'duplicate', n - 1
          FROM fx_points WHERE n > 1
        UNION ALL SELECT release_id, series_id, NULL, 'warning', 'no_metadata', 1
          FROM (SELECT DISTINCT release_id, series_id FROM fx_raw) s
          WHERE NOT EXISTS (SELECT 1 FROM fx_metadata m WHERE m.series_id = s.series_id)
        UNION ALL SELECT release_id, NULL, NULL, 'warning', 'outliers', value_outliers
          FROM fx_outliers WHERE value_outliers > 0
        UNION ALL SELECT release_id, NULL, NULL, 'error', 'no_observations', 1
          FROM fx_expected WHERE release_id NOT IN (SELECT release_id FROM fx_raw)
        UNION ALL SELECT release_id, NULL, NULL, 'warning', 'no_metadata_at_all', 1
          FROM fx_expected WHERE release_id NOT IN (SELECT release_id FROM fx_metadata)"""),
}


# The findings on rows of which some have no release; null is a release like any other.
for _name, _text in {
    "raw": "SELECT * REPLACE (CASE WHEN release_id % 7 <> 3 THEN release_id END AS release_id) FROM fx_raw",
    "typed": "SELECT * REPLACE (CASE WHEN release_id % 7 <> 3 THEN release_id END AS release_id) FROM fx_typed",
    "points": CTES["fx_points"][1].replace("fx_raw", "fx_open_raw"),
    "limits": CTES["fx_limits"][1].replace("fx_typed", "fx_open_typed"),
    "outliers": CTES["fx_outliers"][1].replace("fx_typed", "fx_open_typed").replace("fx_limits", "fx_open_limits")
        .replace("t.release_id = l.release_id", "t.release_id IS NOT DISTINCT FROM l.release_id"),
    "issues": CTES["fx_issues"][1].split("UNION ALL SELECT release_id, NULL, NULL, 'error', 'no_observations'")[0]
        .replace("fx_points", "fx_open_points").replace("fx_raw", "fx_open_raw")
        .replace("fx_outliers", "fx_open_outliers") + """
        UNION ALL SELECT release_id, NULL, NULL, 'warning', 'no_metadata_at_all', 1
          FROM (SELECT DISTINCT release_id FROM fx_open_raw) r WHERE NOT EXISTS (
            SELECT 1 FROM fx_metadata m WHERE m.release_id IS NOT DISTINCT FROM r.release_id)""",
}.items():
    _needs = {"raw": ("fx_raw",), "typed": ("fx_typed",), "points": ("fx_open_raw",), "limits": ("fx_open_typed",),
              "outliers": ("fx_open_typed", "fx_open_limits"),
              "issues": ("fx_open_points", "fx_open_raw", "fx_open_outliers", "fx_metadata")}
    CTES[f"fx_open_{_name}"] = (_needs[_name], _text)


def _log(snapshots: str) -> str:
    """Change log over all vintages of a snapshot view."""
    return f"""
        SELECT release_id, series_id, date, vintage_date, value, value_str,
          CASE WHEN pix IS NULL OR pix <> ix - 1 THEN 'insert' ELSE 'update' END AS _change_type
        FROM {snapshots}_steps
        WHERE pix IS NULL OR pix <> ix - 1 OR pval IS DISTINCT FROM value
        UNION ALL
        SELECT k.release_id, k.series_id, k.date, c.vintage_date, CAST(NULL AS DOUBLE),
          CAST(NULL AS VARCHAR), 'delete'
        FROM {snapshots}_steps k
        JOIN {snapshots}_cal c ON c.release_id = k.release_id AND c.ix = k.ix + 1
        WHERE k.nix IS NULL OR k.nix <> k.ix + 1"""


def _latest(log: str) -> str:
    """Newest live value per (series, date) of a change log view."""
    return f"""
        SELECT series_id, date, vintage_date, value, release_id FROM (
          SELECT *, row_number() OVER (PARTITION BY series_id, date
                                       ORDER BY vintage_date DESC, release_id) AS rn
          FROM (SELECT *, row_number() OVER (PARTITION BY release_id, series_id, date
                                             ORDER BY vintage_date DESC) AS newest FROM {log})
          WHERE newest = 1 AND _change_type <> 'delete')
        WHERE rn = 1"""


for _name, _log_name, _text in (
    ("fx_snapshots", "fx_changes", "value_str"),
    ("fx_ingested", "fx_ingested_changes", "value_str"),
    ("fx_snapshots_big", "fx_changes_big", "CAST(NULL AS VARCHAR)"),
    ("fx_unchanged", "fx_unchanged_changes", "CAST(NULL AS VARCHAR)"),
):
    CTES[f"{_name}_cal"] = ((_name,), f"""
        SELECT release_id, vintage_date,
          row_number() OVER (PARTITION BY release_id ORDER BY vintage_date) AS ix
        FROM (SELECT DISTINCT release_id, vintage_date FROM {_name})""")
    CTES[f"{_name}_steps"] = ((_name, f"{_name}_cal"), f"""
        SELECT o.release_id, o.series_id, o.date, o.vintage_date, o.value, {_text} AS value_str,
          c.ix, lag(c.ix) OVER w AS pix, lead(c.ix) OVER w AS nix, lag(o.value) OVER w AS pval
        FROM {_name} o
        JOIN {_name}_cal c ON o.release_id = c.release_id AND o.vintage_date = c.vintage_date
        WINDOW w AS (PARTITION BY o.release_id, o.series_id, o.date ORDER BY c.ix)""")
    CTES[_log_name] = ((f"{_name}_steps", f"{_name}_cal"), _log(_name))
    CTES[f"{_log_name}_latest"] = ((_log_name,), _latest(_log_name))


def _with(needs: tuple[str, ...]) -> list[str]:
    """Names of the needed CTEs, each after the ones it reads."""
    names: list[str] = []
    for need in needs:
        for name in [*_with(CTES[need][0]), need]:
            if name not in names:
                names.append(name)
    return names


def sql(body: str, *needs: str) -> str:
    """A query with the CTEs it needs."""
    if not needs:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in _with(needs)) + "\n" + body
