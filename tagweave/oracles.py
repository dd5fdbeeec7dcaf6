"""The registered queries once more, as SQL for DuckDB."""

from __future__ import annotations

CUSTOMER_CELLS = """
    SELECT c_custkey::VARCHAR AS rowkey, 'detail' AS family, 'c_custkey' AS qualifier,
           c_custkey::VARCHAR AS value FROM customer
    UNION ALL SELECT c_custkey::VARCHAR, 'detail', 'c_mktsegment', c_mktsegment FROM customer
    UNION ALL SELECT c_custkey::VARCHAR, 'detail', 'c_name', c_name FROM customer
    UNION ALL SELECT c_custkey::VARCHAR, 'detail', 'c_nationkey', c_nationkey::VARCHAR FROM customer
"""

RFM = """
    SELECT o_custkey AS "userId",
           date_diff('day', max(o_orderdate)::DATE, DATE '2001-08-02') AS recency,
           count(o_orderkey) AS frequency,
           sum(o_totalprice::DECIMAL(10,2)) AS monetary
    FROM orders GROUP BY o_custkey
"""

RFE = """
    SELECT user_id AS "userId",
           date_diff('day', max(ts)::DATE, DATE '2024-05-10' - 100) AS recency,
           count(props) AS frequency,
           count(DISTINCT props) AS engagements
    FROM events GROUP BY user_id
"""

RFM_SCALED = f"""
    SELECT "userId",
           CASE WHEN recency <= 30 THEN 5.0::DOUBLE WHEN recency <= 90 THEN 4 WHEN recency <= 180 THEN 3
                WHEN recency <= 365 THEN 2 ELSE 1 END AS r_score,
           CASE WHEN frequency >= 15 THEN 5.0::DOUBLE WHEN frequency >= 12 THEN 4 WHEN frequency >= 9 THEN 3
                WHEN frequency >= 6 THEN 2 ELSE 1 END AS f_score,
           CASE WHEN monetary >= 3000000 THEN 5.0::DOUBLE WHEN monetary >= 2500000 THEN 4
                WHEN monetary >= 2000000 THEN 3 WHEN monetary >= 1000000 THEN 2 ELSE 1 END AS m_score
    FROM ({RFM})
"""

RFE_SCALED = f"""
    SELECT "userId",
           CASE WHEN recency <= 1 THEN 5.0::DOUBLE WHEN recency <= 2 THEN 4 WHEN recency <= 3 THEN 3
                WHEN recency <= 4 THEN 2 ELSE 1 END AS r_score,
           CASE WHEN frequency >= 74 THEN 5.0::DOUBLE WHEN frequency >= 69 THEN 4 WHEN frequency >= 64 THEN 3
                WHEN frequency >= 58 THEN 2 ELSE 1 END AS f_score,
           CASE WHEN engagements >= 53 THEN 5.0::DOUBLE WHEN engagements >= 50 THEN 4
                WHEN engagements >= 48 THEN 3 WHEN engagements >= 45 THEN 2 ELSE 1 END AS e_score
    FROM ({RFE})
"""

# One measure ten thousand times ahead: its bands are the clusters, best first.
RFM_SEGMENTS = f"""
    SELECT "userId", r_score, f_score * 10000 AS f_score, m_score, (5 - f_score)::INTEGER AS rank,
           (['high', 'upper middle', 'middle', 'lower middle', 'low'])[(6 - f_score)::INTEGER] AS tag_name
    FROM ({RFM_SCALED})
"""

RFE_SEGMENTS = f"""
    SELECT *, (4 - e_score / 10000)::INTEGER AS rank,
           (['very active', 'active', 'inactive', 'very inactive'])[(5 - e_score / 10000)::INTEGER] AS tag_name
    FROM (
        SELECT "userId", r_score, f_score,
               CASE WHEN engagements >= 53 THEN 40000.0::DOUBLE WHEN engagements >= 49 THEN 30000
                    WHEN engagements >= 45 THEN 20000 ELSE 10000 END AS e_score
        FROM ({RFE_SCALED}) JOIN ({RFE}) USING ("userId"))
"""

TIME_KINDS = """
    (VALUES ('timestamp', 0::BIGINT, 1::BIGINT), ('unix text', 1, 0), ('date text', 1, 0)) AS k(times, unreadable_times, rows_without_time)
"""

JOB_RULES = """
    SELECT c_mktsegment AS rule, min(c_custkey) + 1000 AS tag_id,
           'job: ' || lower(c_mktsegment) AS tag_name
    FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' GROUP BY c_mktsegment
"""

JOB_LEFT = f"""
    SELECT c_custkey, c_mktsegment, tag_id, tag_name
    FROM customer LEFT JOIN ({JOB_RULES}) ON c_mktsegment = rule
"""

GENDER = """
    SELECT o_orderkey AS "userId", tag_id, tag_name
    FROM orders JOIN (
        SELECT o_orderstatus AS rule, min(o_orderkey) + 1000 AS tag_id,
               'gender: ' || lower(o_orderstatus) AS tag_name
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus
    ) ON o_orderstatus = rule
"""

TSV_FIELDS = """
    SELECT c_custkey::VARCHAR AS id, c_nationkey::VARCHAR AS nationkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS segment
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD')
"""

UPSERTED = """
    WITH old AS (
        SELECT c_custkey::VARCHAR AS "userId", c_mktsegment AS job, c_name AS nick_name FROM customer
    ), new AS (
        SELECT o_custkey::VARCHAR AS "userId",
               CASE WHEN count(o_orderkey) >= 12 THEN 'frequent buyer' END AS job,
               count(o_orderkey)::VARCHAR AS orders
        FROM orders GROUP BY o_custkey
    )
    SELECT coalesce(new."userId", old."userId") AS "userId", coalesce(new.job, old.job) AS job,
           old.nick_name, new.orders
    FROM old FULL JOIN new ON old."userId" = new."userId"
"""

WIDE = f"""
    WITH cells AS (
        SELECT c_custkey::VARCHAR AS "userId",
               CASE WHEN c_acctbal < 0 THEN 'owes' ELSE 'owns' END AS balance,
               NULL::VARCHAR AS job, NULL::VARCHAR AS rfm, NULL::VARCHAR AS rfe
        FROM customer
        UNION ALL SELECT c_custkey::VARCHAR, NULL, tag_name, NULL, NULL FROM ({JOB_LEFT})
        UNION ALL SELECT "userId"::VARCHAR, NULL, NULL,
                         (r_score + f_score + m_score)::INTEGER::VARCHAR, NULL FROM ({RFM_SCALED})
        UNION ALL SELECT "userId"::VARCHAR, NULL, NULL, NULL,
                         (r_score + f_score + e_score)::INTEGER::VARCHAR FROM ({RFE_SCALED})
    )
    SELECT "userId", max(balance) AS balance, max(job) AS job, max(rfm) AS rfm, max(rfe) AS rfe
    FROM cells GROUP BY "userId"
"""

# Vectors as one row per slot.
SLOTS = """
    SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS slot FROM embeddings
"""

ORACLES = {
    "tag_catalog": """
        SELECT n_nationkey::BIGINT AS id, n_name AS name,
               'inType=table' || chr(10) || ' table=orders ' || chr(10)
               || 'selectFieldNames=o_orderkey,o_custkey,o_orderstatus' || chr(10)
               || 'whereCondition=o_orderdate#year#3' AS rule, 4 AS level
        FROM nation WHERE n_nationkey = 7
        UNION SELECT c_custkey + 1000, c_name, c_custkey::VARCHAR, 5 FROM customer WHERE c_nationkey = 7
    """,
    "attribute_tags": """
        SELECT c_custkey::VARCHAR AS rule, c_custkey + 1000 AS tag_id, c_name AS tag_name FROM customer
    """,
    "business_scan": """
        SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus
        FROM orders
        WHERE o_orderdate::DATE BETWEEN DATE '2001-08-01' - 3 * 365 AND DATE '2001-08-01'
    """,
    "rows_to_cells": CUSTOMER_CELLS,
    "cells_to_rows": """
        SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment, c_nationkey::VARCHAR AS c_nationkey
        FROM customer
    """,
    "relative_window_scan": """
        SELECT event_id, user_id FROM events
        WHERE ts::DATE BETWEEN DATE '2024-01-19' - 10 AND DATE '2024-01-19'
    """,
    "csv_roundtrip": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer",
    "libsvm_roundtrip": f"""
        SELECT label::DOUBLE AS label, slot::INTEGER AS slot, round(sum(x), 6) AS total, count(x) AS n
        FROM ({SLOTS}) GROUP BY label, slot
    """,
    "tsv_parse": TSV_FIELDS,
    "tsv_rejects": """
        SELECT concat_ws(chr(9), c_custkey, c_nationkey, c_mktsegment, 'more') AS value, 4 AS found
        FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT concat_ws(chr(9), c_custkey, c_nationkey), 2
        FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
    """,
    "bulk_load_sorted": f"""
        SELECT id AS rowkey, 'detail' AS family, 'id' AS qualifier, id AS value FROM ({TSV_FIELDS})
        UNION ALL SELECT id, 'detail', 'nationkey', nationkey FROM ({TSV_FIELDS})
        UNION ALL SELECT id, 'detail', 'segment', segment FROM ({TSV_FIELDS})
    """,
    "bulk_load_twice": """
        SELECT c_custkey::VARCHAR AS id,
               CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || ' again' ELSE c_mktsegment END AS segment
        FROM customer WHERE c_nationkey >= 5
    """,
    "condition_text_filter": """
        SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey FROM orders
        WHERE o_totalprice >= 100000 AND o_orderdate::DATE <= DATE '1998-12-31'
          AND o_orderdate::DATE <> DATE '1998-12-30' AND o_orderstatus <> 'P' AND o_custkey > 99
    """,
    "profile_upsert": UPSERTED,
    "profile_store": UPSERTED,
    "copy_fields": "SELECT c_custkey::VARCHAR AS c_custkey, c_mktsegment FROM customer",
    "profile_wide": WIDE,
    "profile_by_tag": WIDE,
    "profile_saved_at_once": WIDE,
    "condition_filter": """
        SELECT 'eq' AS comparison, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'ne', count(*) FROM orders WHERE o_orderpriority <> '1-URGENT'
        UNION ALL SELECT 'gt', count(*) FROM orders WHERE o_totalprice > 250000
        UNION ALL SELECT 'lt', count(*) FROM orders WHERE o_totalprice < 50000.5
        UNION ALL SELECT 'ge', count(*) FROM orders WHERE o_orderdate::DATE >= DATE '1998-01-01'
        UNION ALL SELECT 'le', count(*) FROM orders WHERE o_orderdate::DATE <= DATE '1997-06-30'
    """,
    "condition_list_filter": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_totalprice >= 100000 AND o_orderdate::DATE <= DATE '1998-12-31' AND o_orderstatus <> 'P'
    """,
    "condition_parts": """
        SELECT p_partkey, 'p_size' AS field,
               (['eq', 'ne', 'gt', 'lt', 'ge', 'le'])[p_size % 6 + 1] AS compare,
               p_brand || '[x]' AS value
        FROM part
    """,
    "rule_map": """
        SELECT p_partkey, 'inType' AS key, 'table' AS value FROM part
        UNION ALL SELECT p_partkey, 'table', 'part' FROM part
        UNION ALL SELECT p_partkey, 'selectFieldNames', 'p_partkey,p_size' FROM part
        UNION ALL SELECT p_partkey, 'family', p_brand FROM part
        UNION ALL SELECT p_partkey, 'whereCondition', 'p_size#day#' || p_size || '=' FROM part
    """,
    "date_shift": """
        SELECT o_orderkey, '2001-08-02' AS today, strftime(o_orderdate, '%Y%m%d') AS compact,
               strftime(o_orderdate::DATE - 1, '%Y-%m-%d') AS day_before,
               strftime(o_orderdate::DATE + 100, '%Y-%m-%d') AS days_later,
               strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS moment_later
        FROM orders
    """,
    "date_parse": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
        FROM orders
    """,
    "decimal_clean_sum": """
        WITH texts AS (
            SELECT o_custkey, o_totalprice::DECIMAL(12,2)::VARCHAR AS text, o_orderpriority FROM orders
        ), amounts AS (
            SELECT o_custkey,
                   CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'n/a'
                        WHEN '1-URGENT' THEN '9999' || text ELSE text END AS amount
            FROM texts
        )
        SELECT o_custkey, sum(TRY_CAST(amount AS DECIMAL(10,2)))::DOUBLE AS total,
               count(*) FILTER (WHERE TRY_CAST(amount AS DECIMAL(10,2)) IS NULL) AS bad_amounts
        FROM amounts GROUP BY o_custkey
    """,
    "last_activity": """
        SELECT o_custkey::VARCHAR AS "userId",
               max(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) * 86400 + 43200 AS last_time
        FROM orders GROUP BY o_custkey
    """,
    "unix_recency": f"""SELECT "userId"::VARCHAR AS "userId", recency FROM ({RFM})""",
    "event_frequency": """
        SELECT user_id AS "userId", count(*) FILTER (WHERE event_type = 'view' AND props IS NOT NULL)
               AS frequency
        FROM events GROUP BY user_id
    """,
    "distinct_engagement": """
        SELECT user_id AS "userId", count(DISTINCT props) AS engagements FROM events GROUP BY user_id
    """,
    "rfm_raw": f"""
        SELECT "userId", recency, frequency, monetary::DOUBLE AS monetary FROM ({RFM})
    """,
    "rfe_raw": RFE,
    "rfm_score": f"""
        SELECT "userId",
               CASE WHEN recency <= 3 THEN 5.0::DOUBLE WHEN recency <= 6 THEN 4 WHEN recency <= 9 THEN 3
                    WHEN recency <= 15 THEN 2 ELSE 1 END AS r_score,
               CASE WHEN frequency >= 200 THEN 5.0::DOUBLE WHEN frequency >= 150 THEN 4
                    WHEN frequency >= 100 THEN 3 WHEN frequency >= 50 THEN 2 ELSE 1 END AS f_score,
               CASE WHEN monetary >= 200000 THEN 5.0::DOUBLE WHEN monetary >= 100000 THEN 4
                    WHEN monetary >= 50000 THEN 3 WHEN monetary >= 10000 THEN 2 ELSE 1 END AS m_score
        FROM ({RFM})
    """,
    "rfm_score_as_coded": f"""
        SELECT "userId",
               CASE WHEN recency BETWEEN 1 AND 3 THEN 5.0::DOUBLE WHEN recency BETWEEN 4 AND 6 THEN 4
                    WHEN recency BETWEEN 7 AND 9 THEN 3 WHEN recency BETWEEN 10 AND 15 THEN 2
                    WHEN recency >= 16 THEN 1 END AS r_score,
               CASE WHEN frequency BETWEEN 1 AND 49 THEN 1.0::DOUBLE WHEN frequency BETWEEN 50 AND 99 THEN 2
                    WHEN frequency BETWEEN 100 AND 149 THEN 3 WHEN frequency BETWEEN 150 AND 199 THEN 4
                    WHEN frequency >= 200 THEN 5 END AS f_score,
               CASE WHEN monetary < 10000 THEN 1.0::DOUBLE WHEN monetary BETWEEN 10000 AND 49999 THEN 2
                    WHEN monetary BETWEEN 50000 AND 99999 THEN 3
                    WHEN monetary BETWEEN 100000 AND 199999 THEN 4
                    WHEN monetary >= 200000 THEN 5 END AS m_score
        FROM ({RFM})
    """,
    "rfm_score_scaled": RFM_SCALED,
    "rfe_score": f"""
        SELECT "userId",
               CASE WHEN recency <= 15 THEN 5.0::DOUBLE WHEN recency <= 30 THEN 4 WHEN recency <= 45 THEN 3
                    WHEN recency <= 60 THEN 2 ELSE 1 END AS r_score,
               CASE WHEN frequency >= 400 THEN 5.0::DOUBLE WHEN frequency >= 300 THEN 4
                    WHEN frequency >= 200 THEN 3 WHEN frequency >= 100 THEN 2 ELSE 1 END AS f_score,
               CASE WHEN engagements >= 250 THEN 5.0::DOUBLE WHEN engagements >= 200 THEN 4
                    WHEN engagements >= 150 THEN 3 WHEN engagements >= 50 THEN 2 ELSE 1 END AS e_score
        FROM ({RFE})
    """,
    "rfe_score_as_coded": f"""
        SELECT "userId",
               CASE WHEN recency BETWEEN 1 AND 15 THEN 5.0::DOUBLE WHEN recency BETWEEN 16 AND 30 THEN 4
                    WHEN recency BETWEEN 31 AND 45 THEN 3 WHEN recency BETWEEN 46 AND 60 THEN 2
                    WHEN recency >= 61 THEN 1 END AS r_score,
               CASE WHEN frequency <= 99 THEN 1.0::DOUBLE WHEN frequency BETWEEN 100 AND 199 THEN 2
                    WHEN frequency BETWEEN 200 AND 299 THEN 3 WHEN frequency BETWEEN 300 AND 399 THEN 4
                    WHEN frequency >= 400 THEN 5 END AS f_score,
               CASE WHEN engagements < 49 THEN 1.0::DOUBLE WHEN engagements BETWEEN 50 AND 149 THEN 2
                    WHEN engagements BETWEEN 150 AND 199 THEN 3
                    WHEN engagements BETWEEN 200 AND 249 THEN 4
                    WHEN engagements >= 250 THEN 5 END AS e_score
        FROM ({RFE})
    """,
    "rfe_score_scaled": RFE_SCALED,
    "order_value_band": """
        SELECT CASE WHEN amount < 10000 THEN 1.0::DOUBLE WHEN amount BETWEEN 10000 AND 49999 THEN 2
                    WHEN amount BETWEEN 50000 AND 99999 THEN 3
                    WHEN amount BETWEEN 100000 AND 199999 THEN 4
                    WHEN amount >= 200000 THEN 5 END AS m_score, count(*) AS n
        FROM (SELECT o_totalprice::DECIMAL(10,2) AS amount FROM orders) GROUP BY 1
    """,
    "rule_match_inner": f"""
        SELECT c_custkey AS id, c_mktsegment AS job, tag_id, tag_name FROM ({JOB_LEFT})
        WHERE tag_id IS NOT NULL
    """,
    "rule_match_left": f"""
        SELECT c_custkey AS id, c_mktsegment AS job, tag_id, tag_name FROM ({JOB_LEFT})
    """,
    "unmatched_values": """
        SELECT c_mktsegment AS value, count(*) AS n FROM customer
        WHERE c_mktsegment = 'AUTOMOBILE' GROUP BY c_mktsegment
    """,
    "string_index": """
        WITH counted AS (SELECT c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1),
             ranked AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS i FROM counted)
        SELECT c_custkey, c_mktsegment, i::DOUBLE AS label FROM customer JOIN ranked ON v = c_mktsegment
    """,
    "assemble_features": f"""
        SELECT "userId", r_score AS x0, f_score AS x1, m_score AS x2 FROM ({RFM_SCALED})
    """,
    "l2_normalize": f"""
        WITH norms AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM ({SLOTS}) GROUP BY vec_id)
        SELECT vec_id, count(*)::INTEGER AS slots,
               round(max(CASE WHEN slot = 0 THEN x / norm END), 6) AS x0,
               round(max(CASE WHEN slot = 31 THEN x / norm END), 6) AS x31,
               round(max(CASE WHEN slot = 63 THEN x / norm END), 6) AS x63,
               round(sum(x / norm), 6) AS total
        FROM ({SLOTS}) JOIN norms USING (vec_id) GROUP BY vec_id
    """,
    "vector_index": """
        WITH raw AS (
            SELECT l_orderkey, l_partkey, l_linenumber::DOUBLE AS x0,
                   CASE l_returnflag WHEN 'A' THEN 2.0::DOUBLE WHEN 'R' THEN -1 ELSE 0 END AS x1,
                   CASE l_linestatus WHEN 'F' THEN 7.0::DOUBLE ELSE 3 END AS x2
            FROM lineitem
        ), kinds AS (
            SELECT count(DISTINCT x0) AS k0, count(DISTINCT x1) AS k1, count(DISTINCT x2) AS k2 FROM raw
        )
        SELECT l_orderkey, l_partkey,
               CASE WHEN k0 > 4 THEN x0
                    ELSE (dense_rank() OVER (ORDER BY x0 <> 0, x0) - 1)::DOUBLE END AS x0,
               CASE WHEN k1 > 4 THEN x1
                    ELSE (dense_rank() OVER (ORDER BY x1 <> 0, x1) - 1)::DOUBLE END AS x1,
               CASE WHEN k2 > 4 THEN x2
                    ELSE (dense_rank() OVER (ORDER BY x2 <> 0, x2) - 1)::DOUBLE END AS x2
        FROM raw, kinds
    """,
    "stable_split": """
        SELECT o_orderkey,
               CASE WHEN concat('0x', substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT < 3435973836
                    THEN 'train' ELSE 'test' END AS part
        FROM orders
    """,
    "cluster_score_range": f"""
        SELECT r_score::INTEGER AS cluster, max(r_score + f_score + m_score) AS max_score,
               min(r_score + f_score + m_score) AS min_score
        FROM ({RFM_SCALED}) GROUP BY 1
    """,
    "cluster_rank_labels": f"""
        WITH means AS (SELECT label, slot, avg(x) AS mean FROM ({SLOTS}) GROUP BY label, slot),
             sums AS (SELECT label, sum(mean) AS center_sum FROM means GROUP BY label),
             ranks AS (
                 SELECT label, center_sum, row_number() OVER (ORDER BY center_sum DESC) - 1 AS rank FROM sums
             )
        SELECT vec_id, rank::INTEGER AS rank,
               CASE WHEN rank < 9 THEN 'band ' || rank END AS tag_name,
               round(center_sum, 6) AS center_sum
        FROM embeddings JOIN ranks USING (label)
    """,
    "wssse_given_labels": f"""
        WITH means AS (SELECT label, slot, avg(x) AS mean FROM ({SLOTS}) GROUP BY label, slot)
        SELECT round(sum((x - mean) * (x - mean)), 6) AS wssse
        FROM ({SLOTS}) JOIN means USING (label, slot)
    """,
    "silhouette_given_labels": f"""
        WITH x AS (SELECT vec_id, label, slot, x FROM ({SLOTS})),
        means AS (SELECT label, slot, avg(x) AS mean FROM x GROUP BY label, slot),
        norms AS (SELECT vec_id, label, sum(x * x) AS xx FROM x GROUP BY vec_id, label),
        clusters AS (SELECT label, count(*)::DOUBLE AS n, avg(xx) AS q FROM norms GROUP BY label),
        dots AS (
            SELECT x.vec_id, means.label AS other, sum(x.x * means.mean) AS dot
            FROM x JOIN means USING (slot) GROUP BY ALL
        ),
        apart AS (
            SELECT vec_id, norms.label AS own, other, n, xx - 2 * dot + q AS d
            FROM dots JOIN norms USING (vec_id) JOIN clusters ON clusters.label = other
        ),
        parts AS (
            SELECT vec_id, max(CASE WHEN own = other THEN d * n / (n - 1) END) AS a,
                   min(CASE WHEN own <> other THEN d END) AS b
            FROM apart GROUP BY vec_id
        )
        SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM parts
    """,
    "rfm_segments": f"""
        SELECT "userId", r_score, f_score, m_score, rank::BIGINT AS cluster, rank FROM ({RFM_SEGMENTS})
    """,
    "rfe_segments": f"""
        SELECT "userId", r_score, f_score, e_score, rank::BIGINT AS cluster, rank FROM ({RFE_SEGMENTS})
    """,
    "tag_rfm": f"""SELECT "userId", 362 + rank::BIGINT AS tag_id, tag_name FROM ({RFM_SEGMENTS})""",
    "tag_rfe": f"""SELECT "userId", 368 + rank::BIGINT AS tag_id, tag_name FROM ({RFE_SEGMENTS})""",
    "run_value_tag": f"""
        SELECT times, "userId"::VARCHAR AS "userId", tag_name AS rfm, unreadable_times, rows_without_time,
               1::BIGINT AS users_without_scores
        FROM ({RFM_SEGMENTS}), {TIME_KINDS}
    """,
    "run_activity_tag": f"""
        SELECT times, "userId"::VARCHAR AS "userId", tag_name AS rfe, unreadable_times, rows_without_time,
               1::BIGINT AS users_without_scores
        FROM ({RFE_SEGMENTS}), {TIME_KINDS}
    """,
    "run_all_tags": f"""
        WITH cells AS (
            SELECT c_custkey::VARCHAR AS "userId", 'gender: owes' AS gender, NULL::VARCHAR AS job, NULL::VARCHAR AS rfm,
                   NULL::VARCHAR AS rfe
            FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT c_custkey::VARCHAR, NULL, tag_name, NULL, NULL FROM ({JOB_LEFT})
            UNION ALL SELECT "userId"::VARCHAR, NULL, NULL, tag_name, NULL FROM ({RFM_SEGMENTS})
            UNION ALL SELECT "userId"::VARCHAR, NULL, NULL, NULL, tag_name FROM ({RFE_SEGMENTS})
        )
        SELECT "userId", max(gender) AS gender, max(job) AS job, max(rfm) AS rfm, max(rfe) AS rfe
        FROM cells GROUP BY "userId"
    """,
    "accuracy_given_labels": """
        SELECT avg(CASE WHEN quality = toxic THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM labels
    """,
    "model_roundtrip": "SELECT vec_id, 1 AS same FROM embeddings",
    "tag_gender": GENDER,
    "tag_job": f"""SELECT c_custkey AS "userId", tag_id, tag_name FROM ({JOB_LEFT})""",
    "run_tag_models": f"""
        SELECT coalesce(g.id, j.id) AS "userId", g.tag_name AS gender, j.tag_name AS job
        FROM (SELECT "userId"::VARCHAR AS id, tag_name FROM ({GENDER})) g
        FULL JOIN (SELECT c_custkey::VARCHAR AS id, tag_name FROM ({JOB_LEFT})) j ON g.id = j.id
    """,
    "rfm_segment_checks": """
        SELECT count(DISTINCT o_custkey) AS users, 0::BIGINT AS split_points, 0::BIGINT AS misplaced,
               0::BIGINT AS unordered, 0::BIGINT AS clusters_too_many
        FROM orders
    """,
    "rfe_segment_checks": """
        SELECT count(DISTINCT user_id) AS users, 0::BIGINT AS split_points, 0::BIGINT AS misplaced,
               0::BIGINT AS unordered, 0::BIGINT AS clusters_too_many
        FROM events
    """,
    "prediction_checks": """
        SELECT unnest(['logistic', 'tree']) AS classifier, n, 0::BIGINT AS unknown FROM (
            SELECT count(*) AS n FROM embeddings
            WHERE concat('0x', substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT >= 3435973836
        )
    """,
    "logreg_predict": """
        SELECT vec_id, (label % 3)::DOUBLE AS label, (label % 3)::DOUBLE AS prediction FROM embeddings
        WHERE concat('0x', substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT >= 3435973836
    """,
    "dtree_predict": """
        SELECT vec_id, (label % 3)::DOUBLE AS label, (label % 3)::DOUBLE AS prediction FROM embeddings
        WHERE concat('0x', substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT >= 3435973836
    """,
    "pipeline_scores": """
        SELECT classifier, vec_id, 'kind ' || label % 3 AS predicted
        FROM embeddings, (VALUES ('logistic'), ('tree')) AS c(classifier)
        WHERE concat('0x', substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT >= 3435973836
    """,
    "measurement_classifier": """
        WITH counted AS (SELECT 'kind ' || label % 3 AS category, count(*) AS n FROM embeddings GROUP BY 1)
        SELECT category, n, (row_number() OVER (ORDER BY n DESC, category) - 1)::DOUBLE AS label, label AS prediction
        FROM counted
    """,
    "tree_classifier": """
        WITH rows AS (
            SELECT l_linenumber > 3 AS late,
                   '{"label":' || CASE WHEN l_linenumber > 3 THEN '1.0' ELSE '0.0' END || ',"_slots":['
                   || CASE l_returnflag WHEN 'A' THEN '2.0' WHEN 'R' THEN '1.0' ELSE '0.0' END || ','
                   || l_quantity::DOUBLE::VARCHAR || ',' || l_discount::DOUBLE::VARCHAR || ','
                   || l_linenumber::DOUBLE::VARCHAR || ']}' AS content
            FROM lineitem
        ), keyed AS (
            SELECT late, md5(content) || ':' || row_number() OVER (PARTITION BY content) AS key FROM rows
        ), places AS (
            SELECT late, row_number() OVER (ORDER BY count(*) DESC, late) - 1 AS place FROM rows GROUP BY late
        )
        SELECT late::INTEGER::DOUBLE AS label, place::DOUBLE AS index_label, place::DOUBLE AS prediction, count(*) AS n
        FROM keyed JOIN places USING (late)
        WHERE concat('0x', substr(md5(key), 1, 8))::BIGINT >= 3435973836 GROUP BY ALL
    """,
}
