"""DuckDB SQL oracles, one per SQL-expressible query key.

Each statement recomputes the query's result from the raw tables with plain
SQL (window functions over whole tables are fine here: the oracle is a
single-node check at small scale).  Column names match the Spark results.
"""

from __future__ import annotations

U52 = "4503599627370496.0::DOUBLE"


def md5_u(text_sql: str) -> str:
    """SQL for the md5 uniform used by ``functions.exprs.md5_uniform``."""
    return f"(('0x' || substr(md5({text_sql}), 1, 13))::BIGINT / {U52})"


def md5_u_open(text_sql: str) -> str:
    return f"((('0x' || substr(md5({text_sql}), 1, 13))::BIGINT + 0.5::DOUBLE) / {U52})"


def md5_normal(seed_sql: str, row_sql: str) -> str:
    u1 = md5_u_open(f"{seed_sql} || ':n1:' || ({row_sql})::VARCHAR")
    u2 = md5_u_open(f"{seed_sql} || ':n2:' || ({row_sql})::VARCHAR")
    return f"(sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {u2}))"


def jstr(e: str) -> str:
    return f"coalesce('\"' || ({e}) || '\"', 'null')"


def jnum(e: str) -> str:
    return f"coalesce(({e})::VARCHAR, 'null')"


def event_record_json(height: str = "value", weight: str = "user_id::DOUBLE") -> str:
    fields = [
        ("Height", jnum(height)), ("Weight", jnum(weight)), ("Universe", jstr("event_type")),
        ("Identity", jstr("case when user_id % 3 = 0 then 'Public' when user_id % 3 = 1 then 'Secret' end")),
        ("Gender", jstr("case when value < 30 then 'Male' when value < 60 then 'Female' end")),
        ("Marital_Status", jstr("case when user_id % 2 = 0 then 'Single' else 'Married' end")),
        ("Teams", jnum("(user_id % 2)::INT")), ("Origin", jstr("'origin-' || (user_id % 4)::VARCHAR")),
        ("Magic", jnum("(value > 90)::INT")), ("Mutant", jnum("(value < 5)::INT")),
    ]
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields) + " || '}'"


EVENT_FEATURES = """
    value AS Height, user_id::DOUBLE AS Weight, event_type AS Universe,
    case when user_id % 3 = 0 then 'Public' when user_id % 3 = 1 then 'Secret' end AS Identity,
    case when value < 30 then 'Male' when value < 60 then 'Female' end AS Gender,
    case when user_id % 2 = 0 then 'Single' else 'Married' end AS Marital_Status,
    (user_id % 2)::VARCHAR AS Teams, 'origin-' || (user_id % 4)::VARCHAR AS Origin,
    (value > 90)::INT::VARCHAR AS Magic, (value < 5)::INT::VARCHAR AS Mutant"""

# Expected parse of the events payload: one row per (request, record).
PAYLOAD_RECORDS = f"""
payload_req AS (
  SELECT *, 'req-' || event_id::VARCHAR AS databricks_request_id, user_id % 10 AS bucket,
         (value > 50)::INT AS p,
         CASE WHEN event_type = 'error' AND user_id % 10 = 1 THEN 'unparsable'
              WHEN event_type = 'click' AND user_id % 10 = 2 THEN 'empty'
              WHEN event_type = 'view' AND user_id % 10 = 0 THEN 'bad_height'
              WHEN event_type = 'signup' THEN 'two' ELSE 'one' END AS req_kind,
         CASE WHEN event_type = 'error' THEN 'label'
              WHEN event_type = 'purchase' AND user_id % 10 = 3 THEN 'oops'
              WHEN event_type = 'view' AND user_id % 10 = 4 THEN 'empty'
              WHEN event_type = 'signup' THEN 'two' ELSE 'one' END AS resp_kind
  FROM events),
payload_resp AS (
  SELECT *,
    CASE resp_kind WHEN 'label' THEN 1 WHEN 'oops' THEN NULL WHEN 'empty' THEN 0 WHEN 'two' THEN 2 ELSE 1 END AS n_predictions,
    CASE resp_kind WHEN 'oops' THEN NULL WHEN 'empty' THEN NULL ELSE p END AS pred0,
    CASE WHEN resp_kind IN ('one', 'two') THEN databricks_request_id END AS served_request_id
  FROM payload_req),
payload_rows AS (
  SELECT r.*, pos::INT AS record_pos,
    CASE WHEN req_kind = 'bad_height' THEN NULL WHEN pos = 1 THEN value + 1.0::DOUBLE ELSE value END AS Height,
    CASE WHEN pos = 1 THEN (user_id + 1)::DOUBLE ELSE user_id::DOUBLE END AS Weight,
    event_type AS Universe,
    case when user_id % 3 = 0 then 'Public' when user_id % 3 = 1 then 'Secret' end AS Identity,
    case when value < 30 then 'Male' when value < 60 then 'Female' end AS Gender,
    case when user_id % 2 = 0 then 'Single' else 'Married' end AS Marital_Status,
    (user_id % 2)::VARCHAR AS Teams, 'origin-' || (user_id % 4)::VARCHAR AS Origin,
    (value > 90)::INT::VARCHAR AS Magic, (value < 5)::INT::VARCHAR AS Mutant,
    CASE WHEN resp_kind = 'two' AND pos = 1 THEN 1 - p ELSE pred0 END AS aligned_prediction
  FROM payload_resp r,
       (SELECT unnest(range(2)) AS pos) k
  WHERE req_kind NOT IN ('unparsable', 'empty') AND (pos = 0 OR req_kind = 'two')),
monitor AS (
  SELECT ts AS "timestamp", (epoch_us(ts) // 1000000) * 1000 AS timestamp_ms, databricks_request_id,
         floor(value * 10)::BIGINT AS execution_duration_ms, record_pos, Height, Weight, Universe, Identity,
         Gender, Marital_Status, Teams, Origin, Magic, Mutant, pred0 AS prediction,
         'tidemark-model' AS model_name
  FROM payload_rows)"""

SCORED_DOCS = """
scored AS (
  SELECT l.doc_id, l.quality AS y, d.n_chars,
         floor(100.0::DOUBLE * d.n_chars::DOUBLE / (d.n_chars::DOUBLE + 1000.0::DOUBLE)) / 100.0::DOUBLE AS score_a,
         floor(100.0::DOUBLE * 1000.0::DOUBLE / (d.n_chars::DOUBLE + 1000.0::DOUBLE)) / 100.0::DOUBLE AS score_b
  FROM labels l JOIN documents d USING (doc_id)),
preds AS (SELECT *, (score_a >= 0.5)::INT AS pred_a, (score_b >= 0.5)::INT AS pred_b FROM scored)"""


def cm_sql(pred: str) -> str:
    return f"""count(*) FILTER (WHERE y = 1 AND {pred} = 1) AS tp, count(*) FILTER (WHERE y = 0 AND {pred} = 1) AS fp,
      count(*) FILTER (WHERE y = 0 AND {pred} = 0) AS tn, count(*) FILTER (WHERE y = 1 AND {pred} = 0) AS fn,
      count(*) AS n"""


RATES = """tp, fp, tn, fn, n,
      (tp + tn)::DOUBLE / (tp + fp + tn + fn)::DOUBLE AS accuracy,
      tp::DOUBLE / nullif(tp + fp, 0)::DOUBLE AS precision,
      tp::DOUBLE / nullif(tp + fn, 0)::DOUBLE AS recall,
      2.0::DOUBLE * tp / nullif(2.0::DOUBLE * tp + fp + fn, 0) AS f1"""

CURVE = """
st AS (SELECT score_a AS score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
       FROM preds GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
               sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
        FROM st)"""

WIN = "time_bucket(INTERVAL '30 minutes', ts)"
MONITOR_BASE = f"""
mbase AS (SELECT {WIN} AS window_start, event_type AS model, value::DOUBLE AS value,
                 (value > 50)::INT AS prediction, 's' || (user_id % 4)::VARCHAR AS category FROM events)"""

RAW_CHARACTERS = """
raw AS (
  SELECT o.o_orderkey AS PageID,
    CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o.o_totalprice / 100000.0::DOUBLE END AS height,
    c.c_acctbal AS weight,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL
         ELSE n.n_name || CASE WHEN o.o_orderkey % 100 = 0 THEN '-variant' ELSE '' END END AS universe,
    CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c.c_mktsegment END AS teams,
    (['Human', 'Inhuman', 'Human mutant', 'Mutate', 'Asgardian', 'Alien', 'Symbiote', 'Robot', 'Cosmic Being',
      'Magic user', 'God', NULL])[(o.o_orderkey % 12) + 1] AS origin,
    (['Public', 'Secret', NULL, 'No Dual'])[(o.o_custkey % 4) + 1] AS identity,
    (['Male', 'Female', NULL, 'Agender', 'Male'])[(c.c_nationkey % 5) + 1] AS gender,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Single' WHEN '2-HIGH' THEN 'Married' WHEN '3-MEDIUM' THEN 'Widow'
         WHEN '5-LOW' THEN 'Divorced' END AS marital,
    CASE o.o_orderstatus WHEN 'F' THEN 'Alive' WHEN 'O' THEN 'Dead' END AS alive
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

ORDERS_VERSIONS = """
v1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
v2 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 1.1::DOUBLE ELSE o_totalprice END AS o_totalprice,
              o_orderpriority FROM orders WHERE o_orderstatus <> 'O')"""

METRIC_ROWS = """
m AS (SELECT l_orderkey AS run_id, 'quantity' AS key, l_quantity AS value, l_linenumber AS step FROM lineitem
      UNION ALL SELECT l_orderkey, 'discount', l_discount, l_linenumber FROM lineitem)"""


def _synth_categorical(col: str, n: int, seed: str = "42", p: str = "") -> str:
    return f"""
{p}cat_counts AS (SELECT {col} AS category, count(*) AS n FROM events GROUP BY 1),
{p}cat_tab AS (SELECT category,
                   (sum(n) OVER (ORDER BY category ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n)
                     / sum(n) OVER () AS lo,
                   sum(n) OVER (ORDER BY category ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     / sum(n) OVER () AS hi FROM {p}cat_counts),
{p}cat_draws AS (SELECT range AS row_id, {md5_u(f"'{seed}:{col}:' || range::VARCHAR")} AS u FROM range({n}))"""


def _numeric_draw(col: str, n_rows_sql: str, seed: str = "42", floor: bool = True, factor: str = "") -> str:
    value = f"(s.m + s.s * {md5_normal(repr(seed + ':' + col).replace(chr(34), chr(39)), n_rows_sql)})"
    return f"round(greatest(0.1::DOUBLE, {value}){factor}, 6)" if floor else f"round({value}{factor}, 6)"


def _ts_draw(col: str, seed: str = "42") -> str:
    u = md5_u(f"'{seed}:{col}:' || row_id::VARCHAR")
    return f"make_timestamp(t.lo + floor({u} * (t.hi - t.lo))::BIGINT)"


def _bootstrap_rows(table: str, key: str, seed: str, n: int, p: str = "") -> str:
    return f"""
{p}br AS (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || {key}::VARCHAR), {key}) - 1 AS idx FROM {table}),
{p}bn AS (SELECT count(*) AS total FROM {table}),
{p}bd AS (SELECT range AS draw_id, floor({md5_u(f"'{seed}:draw:' || range::VARCHAR")} * {p}bn.total)::BIGINT AS idx
       FROM range({n}), {p}bn)"""


def _synth_events(drift: bool, p: str = "") -> str:
    """The synthetic events table of ``queries._synth_events`` (1,000 rows, seed 42) as CTE ``{p}synth``."""
    value = _numeric_draw("value", "r.row_id", factor=" * 1.5::DOUBLE" if drift else "")
    if drift:
        cat = f"""(SELECT w.category FROM (VALUES ('click', 0.0::DOUBLE, 0.7::DOUBLE), ('view', 0.7::DOUBLE, 1.0::DOUBLE)) w(category, lo, hi)
                   WHERE {md5_u("'42:drift:event_type:' || r.row_id::VARCHAR")} >= w.lo
                     AND {md5_u("'42:drift:event_type:' || r.row_id::VARCHAR")} < w.hi)"""
    else:
        cat = "c.category"
    return f"""
{_synth_categorical('event_type', 1000, p=p)},
{p}num AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events),
{p}tsr AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
{_bootstrap_rows('events', 'event_id', '42:user_id', 1000, p=p)},
{p}boot AS (SELECT {p}bd.draw_id AS row_id, {p}br.user_id FROM {p}bd JOIN {p}br USING (idx)),
{p}synth AS (
  SELECT r.row_id, {value} AS value,
         make_timestamp(tsr.lo + floor({md5_u("'42:ts:' || r.row_id::VARCHAR")} * (tsr.hi - tsr.lo))::BIGINT) AS ts,
         {cat} AS event_type, boot.user_id, (1700000000000 + r.row_id)::VARCHAR AS Id
  FROM {p}cat_draws r
  JOIN {p}cat_tab c ON r.u >= c.lo AND r.u < c.hi
  JOIN {p}boot boot ON boot.row_id = r.row_id, {p}num s, {p}tsr tsr)"""


def drift_categorical_body(base: str) -> str:
    """Categorical drift over ``base(model, window_start, category)`` (see ``monitor_drift_categorical``)."""
    return f"""WITH counts AS (SELECT model, window_start, category, count(*) AS n FROM {base} GROUP BY ALL),
        totals AS (SELECT model, window_start, sum(n) AS total FROM counts GROUP BY ALL),
        shares AS (SELECT c.model, c.window_start, c.category, c.n, c.n / t.total AS share
                   FROM counts c JOIN totals t USING (model, window_start)),
        chain AS (SELECT model, window_start, lag(window_start) OVER (PARTITION BY model ORDER BY window_start) AS prev_start
                  FROM (SELECT DISTINCT model, window_start FROM counts)),
        cur AS (SELECT s.model, s.window_start, ch.prev_start, s.category, s.n AS n_cur, s.share AS p
                FROM shares s JOIN chain ch USING (model, window_start) WHERE ch.prev_start IS NOT NULL),
        prv AS (SELECT s.model, ch.window_start, ch.prev_start, s.category, s.share AS q
                FROM shares s JOIN chain ch ON s.model = ch.model AND s.window_start = ch.prev_start),
        pairs AS (SELECT coalesce(cur.model, prv.model) AS model, coalesce(cur.window_start, prv.window_start) AS window_start,
                         coalesce(cur.prev_start, prv.prev_start) AS prev_start, coalesce(cur.n_cur, 0) AS n_cur,
                         coalesce(cur.p, 0.0) AS p, coalesce(prv.q, 0.0) AS q
                  FROM cur FULL OUTER JOIN prv ON cur.model = prv.model AND cur.window_start = prv.window_start
                       AND cur.prev_start = prv.prev_start AND cur.category = prv.category),
        pt AS (SELECT pairs.*, t.total AS n_window, greatest(p, 1e-4) AS pf, greatest(q, 1e-4) AS qf, (p + q) / 2.0 AS mm
               FROM pairs JOIN totals t USING (model, window_start)),
        m AS (SELECT model, window_start, prev_start,
                     sum(abs(p - q) / 2.0) AS total_variation,
                     sum(((CASE WHEN p > 0 THEN p * ln(p / mm) ELSE 0.0 END)
                          + (CASE WHEN q > 0 THEN q * ln(q / mm) ELSE 0.0 END)) / 2.0) AS js_divergence,
                     sum((pf - qf) * ln(pf / qf)) AS psi,
                     sum(pow(n_cur - n_window * qf, 2) / (n_window * qf)) AS chi2
              FROM pt GROUP BY ALL)
        SELECT model, window_start, prev_start, round(total_variation, 6) AS total_variation,
               round(js_divergence, 6) AS js_divergence, round(psi, 6) AS psi, round(chi2, 6) AS chi2 FROM m
        UNION ALL
        SELECT model, window_start, prev_start, NULL, NULL, NULL, NULL FROM chain WHERE prev_start IS NULL"""


def drift_numeric_body(base: str) -> str:
    """Numeric drift over ``base(model, window_start, value)`` (see ``monitor_drift_numeric``)."""
    return f"""WITH base AS (SELECT model, window_start, value AS v FROM {base} WHERE value IS NOT NULL),
        stats AS (SELECT model, window_start, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std FROM base GROUP BY ALL),
        chain AS (SELECT model, window_start, lag(window_start) OVER (PARTITION BY model ORDER BY window_start) AS prev_start
                  FROM stats),
        hist AS (SELECT model, window_start, v, count(*) AS c FROM base GROUP BY ALL),
        nxt AS (SELECT * FROM chain WHERE prev_start IS NOT NULL),
        merged AS (SELECT model, window_start, v, sum(c_cur) AS c_cur, sum(c_prev) AS c_prev FROM (
                     SELECT h.model, h.window_start, h.v, h.c AS c_cur, 0 AS c_prev FROM hist h JOIN nxt USING (model, window_start)
                     UNION ALL
                     SELECT h.model, nxt.window_start, h.v, 0, h.c FROM hist h
                     JOIN nxt ON h.model = nxt.model AND h.window_start = nxt.prev_start) GROUP BY ALL),
        cm AS (SELECT model, window_start,
                      sum(c_cur) OVER w AS cc, sum(c_prev) OVER w AS cp,
                      sum(c_cur) OVER (PARTITION BY model, window_start) AS nc,
                      sum(c_prev) OVER (PARTITION BY model, window_start) AS np
               FROM merged WINDOW w AS (PARTITION BY model, window_start ORDER BY v
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        ks AS (SELECT model, window_start, max(abs(cc / nc - cp / np)) AS ks FROM cm GROUP BY ALL)
        SELECT s.model, s.window_start, ch.prev_start, round(s.mean, 6) AS mean_cur, round(p.mean, 6) AS mean_prev,
               round(s.mean - p.mean, 6) AS mean_shift, round(s.std, 6) AS std_cur, round(p.std, 6) AS std_prev,
               round(ks.ks, 6) AS ks
        FROM stats s JOIN chain ch USING (model, window_start)
        LEFT JOIN stats p ON p.model = s.model AND p.window_start = ch.prev_start
        LEFT JOIN ks ON ks.model = s.model AND ks.window_start = s.window_start"""


DRIFT_DEMO = f"""WITH {_synth_events(False, 'n_').strip()}, {_synth_events(True, 'd_').strip()},
    dd AS (SELECT 'synthetic' AS model,
                  time_bucket(INTERVAL '30 minutes', TIMESTAMP '2024-02-01 00:00:00' + to_seconds(row_id)) AS window_start,
                  value, event_type AS category FROM n_synth
           UNION ALL
           SELECT 'synthetic', time_bucket(INTERVAL '30 minutes', TIMESTAMP '2024-02-01 00:30:00' + to_seconds(row_id)),
                  value, event_type FROM d_synth)
    SELECT n.model, n.window_start, n.prev_start, n.mean_shift, n.ks, c.total_variation, c.psi,
           (n.ks > 0.1 OR c.psi > 0.2) AS drift_flag
    FROM ({drift_numeric_body('dd')}) n JOIN ({drift_categorical_body('dd')}) c USING (model, window_start, prev_start)
    WHERE n.prev_start IS NOT NULL"""


ORACLE_SQL: dict[str, str] = {
    # ---------------------------------------------------------------- projections
    "rename_select": "SELECT value AS Value, event_type AS Event_Type, event_id::VARCHAR AS Id FROM events",
    "fill_unknown": "SELECT event_id, coalesce(nullif(event_type, 'error'), 'Unknown') AS event_type FROM events",
    "replace_value": "SELECT event_id, CASE WHEN event_type = 'view' THEN 'page_view' ELSE event_type END AS event_type FROM events",
    "presence_flag": "SELECT event_id, (nullif(event_type, 'error') IS NOT NULL)::INT AS has_type FROM events",
    "whitelist_other": """SELECT event_id, CASE WHEN coalesce(nullif(event_type, 'error'), 'Unknown') IN ('click', 'view')
                          THEN event_type ELSE 'Other' END AS event_type FROM events""",
    "in_list_filter": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase', 'signup')",
    "binary_target": "SELECT event_id, coalesce((nullif(event_type, 'error') = 'purchase')::INT, 0) AS target FROM events",
    "cast_columns": """SELECT event_id::VARCHAR AS Id, floor(value)::INT AS value_int, user_id::DOUBLE AS user_id_double,
                       TRY_CAST(regexp_extract(props, '(-?\\d+)', 1) AS INT) AS k, TRY_CAST(props AS INT) AS props_int
                       FROM events""",
    "epoch_ms": "SELECT event_id, (epoch_us(ts) // 1000000) * 1000 AS timestamp_ms FROM events",
    "clip_scale": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                     ELSE greatest(0.1::DOUBLE, value - 30.0::DOUBLE) * 1.5::DOUBLE END AS scaled FROM events""",
    "label_text": "SELECT event_id, CASE WHEN (value > 50)::INT = 1 THEN 'alive' ELSE 'dead' END AS label FROM events",
    # ---------------------------------------------------------------- keyword features
    "keyword_flag": """SELECT doc_id, contains(lower(text), 'license')::INT AS has_license,
                       contains(lower(text), '@')::INT AS has_at, contains(lower(text), 'magic')::INT AS Magic,
                       (contains(lower(text), 'mutate') OR contains(lower(text), 'mutant'))::INT AS Mutant
                       FROM documents""",
    "keyword_category": """SELECT p_partkey, CASE WHEN contains(lower(p_name), 'hot') THEN 'Hot'
                           WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'gear') THEN 'Round'
                           WHEN contains(lower(p_name), 'rod') OR contains(lower(p_name), 'bolt') THEN 'Long'
                           WHEN contains(lower(p_name), 'plate') THEN 'Flat'
                           WHEN contains(lower(p_name), 'widget') OR contains(lower(p_name), 'gizmo') THEN 'Device'
                           ELSE 'Other' END AS category FROM part""",
    # ---------------------------------------------------------------- categories
    "value_counts": "SELECT source || '_' || lang AS category, count(*) AS count FROM documents GROUP BY 1",
    "value_shares": """SELECT category, count, count / sum(count) OVER () AS share FROM
                       (SELECT source || '_' || lang AS category, count(*) AS count FROM documents GROUP BY 1)""",
    "distinct_values": "SELECT DISTINCT source || '_' || lang AS category FROM documents",
    "rare_to_other": """WITH d AS (SELECT doc_id, source || '_' || lang AS category FROM documents),
                        c AS (SELECT category, count(*) AS n FROM d GROUP BY 1)
                        SELECT d.doc_id, CASE WHEN c.n < 20 THEN 'Other' ELSE d.category END AS category
                        FROM d JOIN c USING (category)""",
    "clean_table": f"""WITH {RAW_CHARACTERS},
        u AS (SELECT *, coalesce(universe, 'Unknown') AS universe_f FROM raw),
        rare AS (SELECT universe_f FROM u GROUP BY 1 HAVING count(*) < 50),
        f AS (SELECT *, coalesce(identity, 'Unknown') AS identity_f, coalesce(gender, 'Unknown') AS gender_f,
                     CASE WHEN coalesce(marital, 'Unknown') = 'Widow' THEN 'Widowed' ELSE coalesce(marital, 'Unknown') END AS marital_f,
                     lower(coalesce(origin, 'Unknown')) AS origin_l
              FROM u)
        SELECT height AS Height, weight AS Weight,
               CASE WHEN universe_f IN (SELECT universe_f FROM rare) THEN 'Other' ELSE universe_f END AS Universe,
               identity_f AS Identity,
               CASE WHEN gender_f IN ('Male', 'Female') THEN gender_f ELSE 'Other' END AS Gender,
               marital_f AS Marital_Status, (teams IS NOT NULL)::INT AS Teams,
               CASE WHEN contains(origin_l, 'human') THEN 'Human'
                    WHEN contains(origin_l, 'mutate') OR contains(origin_l, 'mutant') THEN 'Mutant'
                    WHEN contains(origin_l, 'asgardian') THEN 'Asgardian' WHEN contains(origin_l, 'alien') THEN 'Alien'
                    WHEN contains(origin_l, 'symbiote') THEN 'Symbiote' WHEN contains(origin_l, 'robot') THEN 'Robot'
                    WHEN contains(origin_l, 'cosmic being') THEN 'Cosmic Being' ELSE 'Other' END AS Origin,
               contains(origin_l, 'magic')::INT AS Magic,
               (contains(origin_l, 'mutate') OR contains(origin_l, 'mutant'))::INT AS Mutant,
               (alive = 'Alive')::INT AS Alive, PageID::VARCHAR AS Id
        FROM f
        WHERE identity_f IN ('Public', 'Secret', 'Unknown')
          AND marital_f IN ('Single', 'Married', 'Widowed', 'Engaged', 'Unknown')
          AND alive IN ('Alive', 'Dead')""",
    "csv_scan": """SELECT n_nationkey, CASE WHEN n_regionkey IN (0, 1) THEN NULL ELSE n_name END AS n_name,
                   'He said "' || n_name || '", then,' || chr(10) || 'left' AS quoted,
                   CASE WHEN n_regionkey = 4 THEN NULL ELSE n_regionkey END AS n_regionkey FROM nation""",
    # ---------------------------------------------------------------- profiles
    "numeric_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "table_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_non_null, count(DISTINCT {c}) AS n_distinct FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")),
    "date_range": """SELECT 'l_shipdate' AS column_name, min(l_shipdate) AS min_value, max(l_shipdate) AS max_value FROM lineitem
                     UNION ALL SELECT 'o_orderdate', min(o_orderdate), max(o_orderdate) FROM orders""",
    "stage_counts": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT (SELECT count(*) FROM events) AS n_read, count(*) AS n_exploded,
               count(*) FILTER (WHERE prediction IS NOT NULL) AS n_valid,
               CASE WHEN count(*) FILTER (WHERE prediction IS NOT NULL) > 0
                    THEN count(*) FILTER (WHERE prediction IS NOT NULL) ELSE count(*) END AS n_final
        FROM monitor""",
    # ---------------------------------------------------------------- payload
    "build_request": f"""SELECT 'req-' || event_id::VARCHAR AS databricks_request_id,
                         '{{"dataframe_records":[' || {event_record_json()} || ']}}' AS request FROM events""",
    "parse_request": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, CASE req_kind WHEN 'unparsable' THEN NULL WHEN 'empty' THEN 0
               WHEN 'two' THEN 2 ELSE 1 END AS n_records FROM payload_req""",
    "parse_response": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, n_predictions, pred0 AS first_prediction, served_request_id FROM payload_resp""",
    "explode_records": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, record_pos, Height, Weight, Universe FROM payload_rows""",
    "first_prediction": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, record_pos, pred0 AS prediction FROM payload_rows""",
    "align_predictions": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, record_pos, aligned_prediction AS prediction FROM payload_rows""",
    "flatten_record": f"WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor",
    "quarantine": f"""WITH {PAYLOAD_RECORDS.strip()}
        SELECT databricks_request_id, NULL::INT AS record_pos, 'rejected' AS status,
               CASE req_kind WHEN 'unparsable' THEN 'unparsable_request' ELSE 'no_records' END AS reason
        FROM payload_req WHERE req_kind IN ('unparsable', 'empty')
        UNION ALL
        SELECT databricks_request_id, record_pos,
               CASE WHEN req_kind = 'bad_height' THEN 'rejected' ELSE 'valid' END,
               CASE WHEN req_kind = 'bad_height' THEN 'bad_type:Height' END
        FROM payload_rows""",
    "drop_null_prediction": f"WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor WHERE prediction IS NOT NULL",
    "valid_or_all": f"""WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor
        WHERE prediction IS NOT NULL OR NOT EXISTS (SELECT 1 FROM monitor WHERE prediction IS NOT NULL)""",
    "payload_to_monitor": f"""WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor
        WHERE prediction IS NOT NULL OR NOT EXISTS (SELECT 1 FROM monitor WHERE prediction IS NOT NULL)""",
    "monitor_append": f"""WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor
        WHERE prediction IS NOT NULL OR NOT EXISTS (SELECT 1 FROM monitor WHERE prediction IS NOT NULL)""",
    "score_and_log": f"""WITH {_bootstrap_rows('events', 'event_id', '42', 1000).strip()}
        SELECT e.ts AS request_time, 'draw-' || bd.draw_id::VARCHAR AS databricks_request_id,
               0::BIGINT AS execution_duration_ms,
               '{{"dataframe_records":[' || {event_record_json()} || ']}}' AS request,
               '{{"predictions":[' || (e.value > 50)::INT::VARCHAR || '],"databricks_output":{{"trace":null,"databricks_request_id":"draw-'
                 || bd.draw_id::VARCHAR || '"}}}}' AS response
        FROM bd JOIN br e USING (idx)""",
    # ---------------------------------------------------------------- monitoring
    "monitor_profile": f"""WITH {MONITOR_BASE.strip()},
        lng AS (SELECT window_start, model, 'value' AS column_name, value AS v FROM mbase
                UNION ALL SELECT window_start, model, 'prediction', prediction::DOUBLE FROM mbase)
        SELECT window_start, window_start + INTERVAL '30 minutes' AS window_end, model, column_name,
               count(*) AS n_rows, count(*) FILTER (WHERE v IS NULL) AS n_null, count(DISTINCT v) AS n_distinct,
               round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min_value, max(v) AS max_value,
               round(quantile_cont(v, 0.5), 6) AS median
        FROM lng GROUP BY window_start, model, column_name""",
    "monitor_profile_categorical": f"""WITH {MONITOR_BASE.strip()},
        lng AS (SELECT window_start, model, 'segment' AS column_name, category AS v FROM mbase
                UNION ALL SELECT window_start, model, 'prediction', prediction::VARCHAR FROM mbase),
        c AS (SELECT window_start, model, column_name, v, count(*) AS c FROM lng GROUP BY ALL),
        top AS (SELECT window_start, model, column_name, v AS top_value, c AS top_count FROM (
                  SELECT *, row_number() OVER (PARTITION BY window_start, model, column_name ORDER BY c DESC, v DESC) AS rn
                  FROM c WHERE v IS NOT NULL) WHERE rn = 1),
        g AS (SELECT window_start, model, column_name, sum(c)::BIGINT AS n_rows,
                     coalesce(sum(c) FILTER (WHERE v IS NULL), 0)::BIGINT AS n_null, count(v) AS n_distinct FROM c GROUP BY ALL)
        SELECT g.window_start, g.window_start + INTERVAL '30 minutes' AS window_end, g.model, g.column_name,
               n_rows, n_null, n_distinct, top_value, top_count,
               round(top_count / nullif(n_rows - n_null, 0), 6) AS top_share
        FROM g LEFT JOIN top USING (window_start, model, column_name)""",
    "monitor_prediction_mix": f"""WITH {MONITOR_BASE.strip()},
        c AS (SELECT window_start, model, prediction, count(*) AS n FROM mbase GROUP BY ALL)
        SELECT window_start, window_start + INTERVAL '30 minutes' AS window_end, model, prediction, n,
               n / sum(n) OVER (PARTITION BY window_start, model) AS share FROM c""",
    "monitor_drift_categorical": f"""WITH {MONITOR_BASE.strip()}
        SELECT * FROM ({drift_categorical_body('mbase')})""",
    "monitor_drift_numeric": f"""WITH {MONITOR_BASE.strip()}
        SELECT * FROM ({drift_numeric_body('mbase')})""",
    # ---------------------------------------------------------------- metrics
    "confusion_matrix": f"WITH {SCORED_DOCS.strip()} SELECT {cm_sql('pred_a')} FROM preds",
    "classification_metrics": f"WITH {SCORED_DOCS.strip()}, cm AS (SELECT {cm_sql('pred_a')} FROM preds) SELECT {RATES} FROM cm",
    "log_loss": f"""WITH {SCORED_DOCS.strip()},
        c AS (SELECT y::DOUBLE AS y, least(greatest(score_a, 1e-15), 1.0::DOUBLE - 1e-15) AS p FROM preds)
        SELECT round(avg(-(y * ln(p) + (1.0::DOUBLE - y) * ln(1.0::DOUBLE - p))), 9) AS log_loss FROM c""",
    "roc_auc": f"""WITH {SCORED_DOCS.strip()}, {CURVE.strip()}
        SELECT round(sum(neg * (cum_pos - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 9) AS roc_auc FROM cum""",
    "pr_auc": f"""WITH {SCORED_DOCS.strip()}, {CURVE.strip()}
        SELECT round(sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos)::DOUBLE, 9) AS pr_auc FROM cum""",
    "champion_challenger": f"""WITH {SCORED_DOCS.strip()},
        a AS (SELECT {RATES} FROM (SELECT {cm_sql('pred_a')} FROM preds)),
        b AS (SELECT {RATES} FROM (SELECT {cm_sql('pred_b')} FROM preds)),
        la AS (UNPIVOT (SELECT accuracy, precision, recall, f1 FROM a) ON accuracy, precision, recall, f1
               INTO NAME metric VALUE champion),
        lb AS (UNPIVOT (SELECT accuracy, precision, recall, f1 FROM b) ON accuracy, precision, recall, f1
               INTO NAME metric VALUE challenger),
        j AS (SELECT la.metric, la.champion, lb.challenger FROM la JOIN lb USING (metric))
        SELECT metric, champion, challenger,
               (SELECT challenger >= champion OR champion IS NULL FROM j WHERE metric = 'f1') AS promote FROM j""",
    "ab_summary": f"""WITH {SCORED_DOCS.strip()},
        r AS (SELECT *, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 32, 1))::INT % 2 = 1 THEN 'A' ELSE 'B' END AS arm FROM preds),
        s AS (SELECT *, 'Model ' || arm AS model, CASE WHEN arm = 'A' THEN pred_a ELSE pred_b END AS prediction FROM r),
        g AS (SELECT model, {cm_sql('prediction')}, avg(prediction::DOUBLE) AS positive_share FROM s GROUP BY model)
        SELECT model, n AS n_rows, positive_share, 2.0::DOUBLE * tp / nullif(2.0::DOUBLE * tp + fp + fn, 0) AS f1 FROM g""",
    "ab_route": """SELECT c_custkey, CASE WHEN ('0x' || substr(md5(c_custkey::VARCHAR), 32, 1))::INT % 2 = 1
                   THEN 'A' ELSE 'B' END AS arm FROM customer""",
    # ---------------------------------------------------------------- splits, samples
    "stable_split": f"""SELECT c_custkey, CASE WHEN {md5_u("'42:' || c_custkey::VARCHAR")} < 0.2 THEN 'test' ELSE 'train' END AS split
                        FROM customer""",
    "exact_split": """SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || c_custkey::VARCHAR), c_custkey)
                      <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM customer""",
    "bootstrap_sample": f"""WITH {_bootstrap_rows('customer', 'c_custkey', '42', 1000).strip()}
        SELECT bd.draw_id, br.c_custkey, br.c_name, br.c_nationkey, br.c_acctbal, br.c_mktsegment
        FROM bd JOIN br USING (idx)""",
    # ---------------------------------------------------------------- coding
    "category_codes": """WITH train AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'),
        cp AS (SELECT category, (dense_rank() OVER (ORDER BY category) - 1)::INT AS code
               FROM (SELECT DISTINCT o_orderpriority AS category FROM train)),
        cs AS (SELECT category, (dense_rank() OVER (ORDER BY category) - 1)::INT AS code
               FROM (SELECT DISTINCT o_orderstatus AS category FROM train))
        SELECT o.o_orderkey, coalesce(cp.code, -1) AS o_orderpriority, coalesce(cs.code, -1) AS o_orderstatus
        FROM orders o LEFT JOIN cp ON cp.category = o.o_orderpriority LEFT JOIN cs ON cs.category = o.o_orderstatus""",
    # ---------------------------------------------------------------- snapshots
    "snapshot_overwrite": f"""WITH {ORDERS_VERSIONS.strip()}
        SELECT *, TIMESTAMP '2024-02-02 00:00:00' AS update_timestamp_utc FROM v2""",
    "read_version": f"WITH {ORDERS_VERSIONS.strip()} SELECT * FROM v1",
    "latest_version": f"WITH {ORDERS_VERSIONS.strip()} SELECT 2 AS latest_version, count(*) AS n_rows FROM v2",
    "change_feed": f"""WITH {ORDERS_VERSIONS.strip()},
        j AS (SELECT v1.o_orderkey,
                     v1.o_custkey AS c1, v1.o_orderstatus AS s1, v1.o_totalprice AS t1, v1.o_orderpriority AS p1,
                     v2.o_custkey AS c2, v2.o_orderstatus AS s2, v2.o_totalprice AS t2, v2.o_orderpriority AS p2
              FROM v1 JOIN v2 USING (o_orderkey)
              WHERE v1.o_custkey IS DISTINCT FROM v2.o_custkey OR v1.o_orderstatus IS DISTINCT FROM v2.o_orderstatus
                 OR v1.o_totalprice IS DISTINCT FROM v2.o_totalprice OR v1.o_orderpriority IS DISTINCT FROM v2.o_orderpriority)
        SELECT *, 'insert' AS _change_type FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1)
        UNION ALL SELECT *, 'delete' FROM v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v2)
        UNION ALL SELECT o_orderkey, c1, s1, t1, p1, 'update_preimage' FROM j
        UNION ALL SELECT o_orderkey, c2, s2, t2, p2, 'update_postimage' FROM j""",
    # ---------------------------------------------------------------- runs
    "run_search": f"""WITH {METRIC_ROWS.strip()},
        ms AS (SELECT *, max(step) OVER (PARTITION BY run_id, key) AS top FROM m),
        latest AS (SELECT run_id, key, max(value) FILTER (WHERE step = top) AS value FROM ms GROUP BY ALL),
        runs AS (SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING'
                        ELSE 'FAILED' END AS status, o_orderdate AS start_time, o_orderpriority AS run_name,
                        CASE WHEN o_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS segment FROM orders)
        SELECT run_id, run_name, start_time, status FROM runs
        WHERE status = 'FINISHED' AND start_time > TIMESTAMP '1995-01-01 00:00:00' AND run_name LIKE '%URGENT%'
          AND segment = 'even' AND run_id IN (SELECT run_id FROM latest WHERE key = 'quantity' AND value > 25.0)
          AND run_id IN (SELECT run_id FROM latest WHERE key = 'discount' AND value <= 0.06)""",
    "runs_json_scan": """SELECT o_orderkey AS run_id, 'totalprice' AS key, o_totalprice AS value FROM orders
                         UNION ALL SELECT o_orderkey, 'custkey', o_custkey::DOUBLE FROM orders""",
    "latest_per_model": """SELECT p_brand, max(p_partkey) AS latest_version, arg_max(p_name, p_partkey) AS p_name,
                           arg_max(p_retailprice, p_partkey) AS p_retailprice FROM part GROUP BY p_brand""",
    "metric_steps": f"""WITH {METRIC_ROWS.strip()}
        , ms AS (SELECT *, max(step) OVER (PARTITION BY run_id, key) AS top FROM m)
        SELECT run_id, key, max(value) FILTER (WHERE step = top) AS value, max(step) AS step FROM ms GROUP BY ALL""",
    "metrics_unnest": """SELECT o_orderkey AS run_id, 'totalprice' AS key, o_totalprice AS value FROM orders
                         UNION ALL SELECT o_orderkey, 'custkey', o_custkey::DOUBLE FROM orders""",
    # ---------------------------------------------------------------- synthesis
    "synth_categorical": f"""WITH {_synth_categorical('event_type', 1000).strip()}
        SELECT r.row_id, c.category AS event_type FROM cat_draws r JOIN cat_tab c ON r.u >= c.lo AND r.u < c.hi""",
    "synth_numeric": f"""WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
        SELECT range AS row_id, {_numeric_draw('value', 'range')} AS value FROM range(1000), s""",
    "synth_timestamp": f"""WITH t AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
        r AS (SELECT range AS row_id FROM range(1000))
        SELECT row_id, {_ts_draw('ts')} AS ts FROM r, t""",
    "synth_bootstrap": f"""WITH {_bootstrap_rows('events', 'event_id', '42:user_id', 1000).strip()}
        SELECT bd.draw_id AS row_id, br.user_id FROM bd JOIN br USING (idx)""",
    "synth_ids": "SELECT range AS row_id, (1700000000000 + range)::VARCHAR AS Id FROM range((SELECT count(*) FROM events))",
    "synth_table": f"WITH {_synth_events(False).strip()} SELECT * FROM synth",
    "inject_drift": f"WITH {_synth_events(True).strip()} SELECT * FROM synth",
    "drift_demo": DRIFT_DEMO,
    # ---------------------------------------------------------------- features
    "feature_vector": f"""WITH {SCORED_DOCS.strip()},
        ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS rn,
                          count(*) OVER () AS n FROM scored JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id)),
        train AS (SELECT * FROM ranked WHERE rn > ceil(0.2 * n)),
        cl AS (SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS code FROM (SELECT DISTINCT lang AS category FROM train WHERE source <> 'src1')),
        cs AS (SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS code FROM (SELECT DISTINCT source AS category FROM train WHERE source <> 'src1'))
        SELECT t.doc_id, coalesce(cl.code, -1)::DOUBLE AS f_lang__code, coalesce(cs.code, -1)::DOUBLE AS f_source__code,
               t.n_chars::DOUBLE AS f_n_chars
        FROM ranked t LEFT JOIN cl ON cl.category = t.lang LEFT JOIN cs ON cs.category = t.source""",
    # ---------------------------------------------------------------- streaming
    "stream_ingest": f"WITH {PAYLOAD_RECORDS.strip()} SELECT * FROM monitor WHERE prediction IS NOT NULL",
    "stream_window_profile": f"""WITH w AS (
          SELECT {WIN} AS window_start, event_type AS model, value FROM events)
        SELECT window_start, window_start + INTERVAL '30 minutes' AS window_end, model, count(*) AS n_rows,
               count(*) FILTER (WHERE value IS NULL) AS n_null, round(avg(value), 6) AS mean,
               round(stddev_samp(value), 6) AS std, min(value) AS min_value, max(value) AS max_value
        FROM w
        WHERE window_start + INTERVAL '30 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'
        GROUP BY window_start, model""",
}

ORACLE_SQL["monitor_refresh"] = ORACLE_SQL["monitor_profile"]
# Windows that a watermark of one hour has closed by the end of the events.
_CLOSED = "window_start + INTERVAL '30 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'"
ORACLE_SQL["stream_drift_categorical"] = f"""WITH {MONITOR_BASE.strip()}
    SELECT * FROM ({drift_categorical_body('mbase')}) WHERE {_CLOSED}"""
ORACLE_SQL["stream_drift_numeric"] = f"""WITH {MONITOR_BASE.strip()}
    SELECT * FROM ({drift_numeric_body('mbase')}) WHERE {_CLOSED}"""
_CURRENT = "mbase AS (SELECT window_start, CASE WHEN model <> 'error' THEN model END AS model, value, prediction, category FROM named)"
ORACLE_SQL["monitor_quality"] = f"""WITH {MONITOR_BASE.strip()},
    cm AS (SELECT window_start, window_start + INTERVAL '30 minutes' AS window_end, model, {cm_sql('prediction')}
           FROM (SELECT *, (value > 40)::INT AS y FROM mbase) GROUP BY ALL)
    SELECT window_start, window_end, model, {RATES} FROM cm"""
ORACLE_SQL["monitor_drift_null_model"] = f"""WITH {MONITOR_BASE.strip().replace('mbase AS', 'named AS', 1)}, {_CURRENT},
    shown AS (SELECT * REPLACE (coalesce(model, '') AS model) FROM mbase)
    SELECT * REPLACE (nullif(model, '') AS model) FROM ({drift_numeric_body('shown')})"""
ORACLE_SQL["monitor_drift_baseline"] = f"""WITH {MONITOR_BASE.strip()},
    b AS (SELECT event_type AS model, 's' || (user_id % 4)::VARCHAR AS category, count(*) AS n FROM events WHERE user_id % 3 = 0 GROUP BY ALL),
    bs AS (SELECT model, category, n / sum(n) OVER (PARTITION BY model) AS q FROM b),
    c AS (SELECT model, window_start, category, count(*) AS n FROM mbase GROUP BY ALL),
    w AS (SELECT model, window_start, sum(n) AS total FROM c GROUP BY ALL),
    keys AS (SELECT model, window_start, category FROM c
             UNION SELECT w.model, w.window_start, bs.category FROM w JOIN bs USING (model)),
    pairs AS (SELECT k.model, k.window_start, w.total::DOUBLE AS total, coalesce(c.n, 0)::DOUBLE AS n, coalesce(c.n, 0)::DOUBLE / w.total AS p,
                     coalesce(bs.q, 0)::DOUBLE AS q
              FROM keys k JOIN w USING (model, window_start) LEFT JOIN c USING (model, window_start, category)
              LEFT JOIN bs ON bs.model = k.model AND bs.category = k.category
              WHERE k.model IN (SELECT model FROM bs)),
    f AS (SELECT *, greatest(p, 1e-4) AS pf, greatest(q, 1e-4) AS qf, (p + q) / 2 AS m FROM pairs),
    d AS (SELECT model, window_start, sum(abs(p - q) / 2) AS tv,
                 sum((CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2) AS js,
                 sum((pf - qf) * ln(pf / qf)) AS psi, sum(pow(n - total * qf, 2) / (total * qf)) AS chi2 FROM f GROUP BY ALL)
    SELECT w.model, w.window_start, NULL::TIMESTAMP AS prev_start, round(tv, 6) AS total_variation, round(js, 6) AS js_divergence,
           round(psi, 6) AS psi, round(chi2, 6) AS chi2 FROM w LEFT JOIN d USING (model, window_start)"""
ORACLE_SQL["train_test_tables"] = f"""SELECT Id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || Id), Id) <= ceil(0.2 * count(*) OVER ())
    THEN 'test' ELSE 'train' END AS side, TIMESTAMP '2024-02-01 00:00:00' AS update_timestamp_utc FROM ({ORACLE_SQL['clean_table']})"""
_TEST_DOCS = f"""WITH {SCORED_DOCS.strip()}, r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS rn,
    count(*) OVER () AS n FROM preds), t AS (SELECT doc_id FROM r WHERE rn <= ceil(0.2 * n))"""
ORACLE_SQL["batch_score_check"] = f"{_TEST_DOCS} SELECT doc_id, TRUE AS consistent FROM t"
ORACLE_SQL["model_roundtrip"] = f"{_TEST_DOCS} SELECT doc_id, TRUE AS same FROM t"
ORACLE_SQL["ab_score_check"] = f"""{_TEST_DOCS} SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 32, 1))::INT % 2 = 1
    THEN 'Model A' ELSE 'Model B' END AS model FROM t"""
ORACLE_SQL["train_stump"] = f"""WITH {SCORED_DOCS.strip()},
    ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS rn, count(*) OVER () AS n
               FROM scored JOIN (SELECT doc_id, lang FROM documents) USING (doc_id))
    SELECT (lang = 'en')::INT AS is_en, round(avg(2.0::DOUBLE * y - 1), 9) AS leaf_value FROM ranked WHERE rn > ceil(0.2 * n) GROUP BY 1"""
ORACLE_SQL["evaluate_scores"] = f"""WITH {SCORED_DOCS.strip()}, cm AS (SELECT {cm_sql('pred_a')} FROM preds),
    r AS (SELECT tp::DOUBLE AS tp, fp::DOUBLE AS fp, tn::DOUBLE AS tn, fn::DOUBLE AS fn, n::DOUBLE AS n, accuracy, precision, recall, f1 FROM (SELECT {RATES} FROM cm))
    SELECT metric, round(value, 9) AS value FROM (UNPIVOT r ON tp, fp, tn, fn, n, accuracy, precision, recall, f1 INTO NAME metric VALUE value)
    UNION ALL SELECT 'log_loss', log_loss FROM ({ORACLE_SQL['log_loss']})
    UNION ALL SELECT 'roc_auc', roc_auc FROM ({ORACLE_SQL['roc_auc']})
    UNION ALL SELECT 'pr_auc', pr_auc FROM ({ORACLE_SQL['pr_auc']})"""


def _boosted_level(rows: str, name: str) -> str:
    """Best split of every node of ``rows`` (doc_id, node, g, h) and the children its rows go to."""
    return f"""
    {name}_t AS (SELECT node, sum(g)::DOUBLE / 16777216 AS g, sum(h)::DOUBLE / 16777216 AS h, count(*) AS n FROM {rows} GROUP BY node),
    {name}_h AS (SELECT node, f, bin, sum(g)::DOUBLE / 16777216 AS g, sum(h)::DOUBLE / 16777216 AS h, count(*) AS n FROM {rows} JOIN long USING (doc_id) GROUP BY ALL),
    {name}_o AS (SELECT node, f, bin, row_number() OVER w AS k, count(*) OVER (PARTITION BY node, f) AS bins, sum(g) OVER w AS g, sum(h) OVER w AS h, sum(n) OVER w AS n
                 FROM {name}_h WHERE bin > 0 WINDOW w AS (PARTITION BY node, f ORDER BY CASE WHEN f < 2 THEN g / (h + 10) ELSE bin END, bin)),
    {name}_c AS (SELECT o.node, o.f, o.k, s.side, o.g + if(s.side, coalesce(m.g, 0), 0) AS gl, o.h + if(s.side, coalesce(m.h, 0), 0) AS hl, o.n + if(s.side, coalesce(m.n, 0), 0) AS nl, m.n IS NULL AS complete
                 FROM {name}_o o LEFT JOIN {name}_h m ON m.node = o.node AND m.f = o.f AND m.bin = 0 JOIN (VALUES (TRUE), (FALSE)) s(side)
                   ON CASE WHEN m.n IS NULL THEN s.side AND o.k < o.bins ELSE NOT s.side OR o.k < o.bins END),
    {name}_b AS (SELECT c.node, c.f, c.k, CASE WHEN complete THEN 2 * nl >= t.n ELSE side END AS side,
                        gl * gl / hl + (t.g - gl) * (t.g - gl) / (t.h - hl) - t.g * t.g / t.h AS gain
                 FROM {name}_c c JOIN {name}_t t USING (node)
                 WHERE nl >= 20 AND t.n - nl >= 20 AND hl >= 0.001 AND t.h - hl >= 0.001 AND gl * gl / hl + (t.g - gl) * (t.g - gl) / (t.h - hl) - t.g * t.g / t.h > 0
                 QUALIFY row_number() OVER (PARTITION BY c.node ORDER BY gain DESC, c.f, c.side DESC, c.k) = 1),
    {name}_n AS (SELECT r.doc_id, CASE WHEN b.node IS NULL THEN r.node WHEN if(l.bin = 0, b.side, o.k <= b.k) THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node, r.g, r.h
                 FROM {rows} r LEFT JOIN {name}_b b USING (node) LEFT JOIN long l ON l.doc_id = r.doc_id AND l.f = b.f LEFT JOIN {name}_o o ON o.node = r.node AND o.f = b.f AND o.bin = l.bin)"""


def _boosted_tree(scores: str, name: str) -> str:
    """Gradients at ``scores`` (doc_id, y, score), two levels of splits, all nodes, and the scores after the tree."""
    return f"""
    {name}_r AS (SELECT doc_id, 0 AS node, floor((1 / (1 + exp(-score)) - y) * 16777216 + 0.5)::BIGINT AS g,
                        floor(1 / (1 + exp(-score)) * (1 - 1 / (1 + exp(-score))) * 16777216 + 0.5)::BIGINT AS h FROM {scores}),
    {_boosted_level(f"{name}_r", f"{name}_0")}, {_boosted_level(f"{name}_0_n", f"{name}_1")},
    {name}_leaf AS (SELECT node, -0.1 * (sum(g)::DOUBLE / 16777216) / (sum(h)::DOUBLE / 16777216) AS value FROM {name}_1_n GROUP BY node),
    {name}_all AS (SELECT node, -0.1 * g / h AS value, n FROM {name}_0_t UNION
                   SELECT node, -0.1 * g / h, n FROM {name}_1_t UNION
                   SELECT node, value, count(*) FROM {name}_1_n JOIN {name}_leaf USING (node) WHERE node > 2 GROUP BY ALL),
    {name}_nodes AS (SELECT a.node, ['lang', 'source', 'n_chars'][b.f + 1] AS feature, b.gain, a.n, b.side, a.value
                     FROM {name}_all a LEFT JOIN (SELECT * FROM {name}_0_b UNION ALL SELECT * FROM {name}_1_b WHERE node > 0) b USING (node)),
    {name}_s AS (SELECT doc_id, y, score + value AS score FROM {scores} JOIN {name}_1_n USING (doc_id) JOIN {name}_leaf USING (node))"""


ORACLE_SQL["boosted_trees"] = f"""WITH {SCORED_DOCS.strip()},
    ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS rn, count(*) OVER () AS n
               FROM scored JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id)),
    train AS (SELECT doc_id, y, if(doc_id % 7 <> 0, lang, NULL) AS lang, source, if(doc_id % 11 <> 0, n_chars, NULL) AS n_chars FROM ranked WHERE rn > ceil(0.2 * n)),
    lengths AS (SELECT n_chars, dense_rank() OVER (ORDER BY floor((cum - c) * 255 / total)) AS bin
                FROM (SELECT n_chars, count(*) AS c, sum(count(*)) OVER (ORDER BY n_chars) AS cum, sum(count(*)) OVER () AS total FROM train WHERE n_chars IS NOT NULL GROUP BY 1)),
    langs AS (SELECT lang, least(row_number() OVER (ORDER BY lang), 255) AS bin FROM (SELECT DISTINCT lang FROM train WHERE lang IS NOT NULL)),
    sources AS (SELECT source, least(row_number() OVER (ORDER BY source), 255) AS bin FROM (SELECT DISTINCT source FROM train WHERE source IS NOT NULL)),
    long AS (SELECT doc_id, 0 AS f, coalesce(bin, 0) AS bin FROM train LEFT JOIN langs USING (lang) UNION ALL
             SELECT doc_id, 1, coalesce(bin, 0) FROM train LEFT JOIN sources USING (source) UNION ALL
             SELECT doc_id, 2, coalesce(bin, 0) FROM train LEFT JOIN lengths USING (n_chars)),
    s0 AS (SELECT doc_id, y, ln(avg(y) OVER () / (1 - avg(y) OVER ())) AS score FROM train),
    {_boosted_tree("s0", "a")}, {_boosted_tree("a_s", "b")}
    SELECT 0 AS tree, node::INT AS node, feature, round(gain, 6) AS gain, n AS n_rows, CASE WHEN feature IS NOT NULL THEN side END AS missing_left, round(value, 9) AS value FROM a_nodes
    UNION ALL
    SELECT 1, node::INT, feature, round(gain, 6), n, CASE WHEN feature IS NOT NULL THEN side END, round(value, 9) FROM b_nodes"""

ORACLE_SQL["change_history"] = """WITH v(n, before) AS (VALUES (1, NULL), (2, 1), (4, 2), (7, 4), (8, 7)),
    s AS (SELECT v.n, o_orderkey, o_custkey, CASE WHEN NOT (o_orderkey % 6 = 0 AND v.n = 7) THEN o_orderstatus END AS o_orderstatus,
                 CASE WHEN o_orderpriority = '1-URGENT' AND v.n >= 4 THEN o_totalprice * 1.1::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderpriority
          FROM orders, v WHERE NOT (o_orderkey % 9 = v.n OR (o_custkey % 5 = 0 AND v.n IN (2, 4)))),
    old AS (SELECT v.n AS since, s.* EXCLUDE (n) FROM s JOIN v ON s.n = v.before),
    new AS (SELECT n AS since, s.* EXCLUDE (n) FROM s WHERE n > 1),
    gone AS (SELECT * FROM old EXCEPT SELECT * FROM new),
    come AS (SELECT * FROM new EXCEPT SELECT * FROM old)
    SELECT gone.* EXCLUDE (since), CASE WHEN EXISTS (SELECT 1 FROM new WHERE new.since = gone.since AND new.o_orderkey = gone.o_orderkey)
           THEN 'update_preimage' ELSE 'delete' END AS _change_type, since AS _version FROM gone
    UNION ALL
    SELECT come.* EXCLUDE (since), CASE WHEN EXISTS (SELECT 1 FROM old WHERE old.since = come.since AND old.o_orderkey = come.o_orderkey)
           THEN 'update_postimage' ELSE 'insert' END, since FROM come"""
ORACLE_SQL["best_descendants"] = f"""WITH RECURSIVE {METRIC_ROWS.strip()},
    q AS (SELECT run_id, max(value) AS value FROM (SELECT *, max(step) OVER (PARTITION BY run_id) AS top FROM m WHERE key = 'quantity')
          WHERE step = top GROUP BY 1),
    r0 AS (SELECT o_orderkey AS run_id, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey > 0 THEN 3 * ((o_orderkey // 3 - 1) // 2) END
             WHEN (o_orderkey // 3) % 21 <> 0 THEN o_orderkey - 3 END AS parent FROM orders),
    r AS (SELECT r0.run_id, r0.o_orderpriority, p.o_orderkey AS parent FROM r0 LEFT JOIN orders p ON p.o_orderkey = r0.parent),
    t AS (SELECT run_id, run_id AS root, 0 AS depth FROM r WHERE parent IS NULL
          UNION ALL SELECT r.run_id, t.root, t.depth + 1 FROM r JOIN t ON r.parent = t.run_id),
    placed AS (SELECT t.*, r.o_orderpriority, q.value FROM t JOIN r USING (run_id) LEFT JOIN q USING (run_id)),
    best AS (SELECT * FROM placed WHERE depth > 0 AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY root ORDER BY value DESC, run_id) = 1)
    SELECT s.root, s.n_runs, s.max_depth, b.run_id AS best_run, b.value AS best_value, b.o_orderpriority
    FROM (SELECT root, count(*) AS n_runs, max(depth) AS max_depth FROM placed GROUP BY 1) s LEFT JOIN best b USING (root)"""
ORACLE_SQL["run_loads"] = """WITH used AS (SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE 't' || (o_custkey % 20)::VARCHAR END AS table_name,
           o_orderdate AS start_time FROM orders),
    loads AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE 't' || (l_suppkey % 20)::VARCHAR END AS table_name, l_shipdate AS load_time,
                     max(l_orderkey * 10 + l_linenumber) AS load_id FROM lineitem GROUP BY 1, 2)
    SELECT u.run_id, u.table_name, u.start_time, l.load_time, l.load_id
    FROM used u ASOF LEFT JOIN loads l ON u.table_name = l.table_name AND u.start_time >= l.load_time"""
_LOOSE = """loose AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 100 = 2 THEN 'oops' WHEN o_orderkey % 100 = 3 THEN '[1]' ELSE
    '{"id":' || o_orderkey::VARCHAR || ',"price":'
    || CASE WHEN o_orderkey % 10 = 0 AND o_orderstatus = 'O' THEN '"n/a"' WHEN o_orderkey % 10 = 1 THEN o_custkey::VARCHAR || '.5' ELSE o_custkey::VARCHAR END
    || CASE WHEN o_orderkey % 10 = 4 THEN '' ELSE ',"status":"' || o_orderstatus || '"' END
    || CASE WHEN o_orderkey % 10 = 5 AND o_orderstatus <> 'O' THEN ',"note":null' WHEN o_orderkey % 10 = 6 THEN ',"tags":["a",1]' ELSE '' END
    || CASE WHEN o_orderstatus = 'O' THEN ',"open":true' ELSE ',"rank":7' END || '}' END AS record FROM orders)"""


def _signature(where: str) -> str:
    return f"""(WITH o AS (SELECT record::JSON AS j FROM loose WHERE json_valid(record) AND {where}),
      objects AS (SELECT j FROM o WHERE json_type(j) = 'OBJECT'),
      kv AS (SELECT key AS field, json_type(json_extract(j, '$.' || key)) AS raw FROM (SELECT j, unnest(json_keys(j)) AS key FROM objects)),
      k AS (SELECT field, CASE raw WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                          WHEN 'NULL' THEN NULL ELSE lower(raw) END AS kind FROM kv)
      SELECT field, CASE WHEN count(DISTINCT kind) = 0 THEN 'void' WHEN count(DISTINCT kind) = 1 THEN max(kind)
                         WHEN count(DISTINCT kind) = 2 AND min(kind) = 'bigint' AND max(kind) = 'double' THEN 'double' ELSE 'mixed' END AS type,
             count(*) AS n_present, count(*) - count(kind) AS n_null, (SELECT count(*) FROM objects) AS n_records,
             count(*) = (SELECT count(*) FROM objects) AS required
      FROM k GROUP BY field)"""


ORACLE_SQL["learn_signature"] = f"WITH {_LOOSE} SELECT * FROM {_signature('true')}"
ORACLE_SQL["compare_signatures"] = f"""WITH {_LOOSE}, e AS {_signature("o_orderstatus <> 'O'")}, a AS {_signature("o_orderstatus = 'O'")},
    j AS (SELECT field, e.type AS old, a.type AS new, e.required AS must, a.required AS still FROM e FULL JOIN a USING (field))
    SELECT field, old AS expected_type, new AS actual_type,
           CASE WHEN new IS NULL THEN 'missing' WHEN old IS NULL THEN 'unknown' WHEN old = new AND must = still THEN 'same'
                WHEN old = new AND must THEN 'widened' WHEN old = new THEN 'narrowed'
                WHEN new = 'mixed' OR old = 'void' OR (new = 'double' AND old = 'bigint') THEN 'widened'
                WHEN old = 'mixed' OR new = 'void' OR (old = 'double' AND new = 'bigint') THEN 'narrowed' ELSE 'changed' END AS change
    FROM j"""
