"""Input tables for the jobs, projected from the provided tables.

The text runs unchanged on Spark SQL and on DuckDB. Every view reads its tables whole; rows that a
job should not find stay under values that match nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS = {
    "v_trips": """
        SELECT event_id AS trip_id, user_id AS taxi_id, ts AS trip_start_timestamp,
          ts + INTERVAL 15 MINUTES AS trip_end_timestamp,
          CAST(floor(value * 100) AS BIGINT) AS trip_seconds,
          CAST((event_id % 37) - 2 AS DOUBLE) AS trip_miles, value - 5 AS fare,
          CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) END AS tips,
          CASE WHEN event_id % 5 = 0 THEN NULL ELSE 1.5E0 END AS tolls,
          CASE WHEN event_id % 4 = 0 THEN NULL ELSE 0.25E0 END AS extras,
          event_type AS payment_type,
          CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('Company ', CAST(user_id % 9 AS STRING)) END AS company,
          CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id % 77 END AS pickup_community_area,
          CASE WHEN event_id % 10 = 0 THEN NULL ELSE (user_id * 7) % 77 END AS dropoff_community_area
        FROM events""",
    "v_supplier_ref": """
        SELECT s_suppkey AS ord, concat('M', CAST(s_suppkey % 90 AS STRING)) AS abbr,
          s_name AS manufacturer, concat(s_name, ' GmbH') AS legal_name
        FROM supplier""",
    "v_entities": """
        SELECT n_nationkey AS ord, CAST(n_nationkey AS STRING) AS be_id, r_name AS client, n_name AS be_name,
          concat(CAST(n_nationkey + 1 AS STRING), ',000') AS mm_total_rows
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_matched": """
        SELECT concat(CAST(c_nationkey + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1000 END AS STRING), '.0') AS splist_id,
          concat(' M', CAST(l_suppkey % 90 AS STRING)) AS abbr, CAST(count(*) AS STRING) AS cnt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY c_nationkey, l_linestatus, l_suppkey""",
    "v_unmatched": """
        SELECT CAST(c_nationkey + CASE WHEN l_linestatus = 'O' THEN 0 ELSE 2000 END AS STRING) AS splist_id,
          CASE WHEN l_suppkey % 10 = 9 THEN concat('Unknown ', s_name)
               WHEN l_suppkey % 3 = 0 THEN concat('  ', upper(s_name), ' ')
               WHEN l_suppkey % 3 = 1 THEN concat(s_name, '  gmbh') ELSE s_name END AS manu_name,
          CAST(count(*) AS STRING) AS cnt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY c_nationkey, l_linestatus, l_suppkey, s_name""",
    "v_products": """
        SELECT CASE WHEN l_suppkey % 10 = 9 THEN concat('Unknown ', s_name) ELSE upper(s_name) END AS name,
          l_returnflag AS batch, CAST(count(DISTINCT l_partkey) AS STRING) AS cnt
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name, l_returnflag""",
    "v_datasets": """
        SELECT o_orderkey AS ord, concat('Supplier#', lpad(CAST(o_custkey % 120 AS STRING), 9, '0')) AS company_source,
          CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS import_done,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS source_format,
          o_orderstatus AS source_origin
        FROM orders""",
    "v_rules": """
        SELECT s_name AS manufacturer, CASE WHEN s_suppkey % 7 = 3 THEN ' Y ' ELSE 'n' END AS exclude_flag
        FROM supplier""",
    "v_prev": """
        SELECT s_suppkey AS ord,
          concat(CASE WHEN s_suppkey % 5 = 4 THEN 'old ' ELSE '' END, 'M', CAST(s_suppkey % 90 AS STRING)) AS abbr,
          CASE WHEN s_suppkey % 8 = 0 THEN 'n/a' ELSE CAST(s_suppkey AS STRING) END AS last_month_mr,
          CASE WHEN s_suppkey % 2 = 0 THEN 'open' ELSE 'done' END AS research
        FROM supplier""",
    "v_match_ts": """
        SELECT concat(CAST(c_nationkey AS STRING), '.0') AS list_id,
          CASE WHEN c_nationkey % 6 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS matched_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_catalog": """
        SELECT p_partkey AS row_id, CASE WHEN p_partkey % 13 = 0 THEN ' NO ' ELSE 'Yes' END AS proper_identification,
          CASE WHEN p_partkey % 9 = 0 THEN ' null ' WHEN p_partkey % 2 = 0 THEN concat(' ', upper(p_brand))
               ELSE p_brand END AS manufacturer_name,
          CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', '  ') ELSE p_name END AS manufacturer_article,
          p_type AS manufacturer_typecode, '' AS manufacturer_url,
          CASE WHEN p_partkey % 6 = 0 THEN concat('Source ', CAST(p_partkey % 17 AS STRING)) ELSE '' END AS supplier_name,
          CASE WHEN p_partkey % 12 = 0 THEN p_name ELSE '' END AS supplier_article, '' AS supplier_url,
          p_brand AS manufacturer_name_canonical, p_size AS manufacturer_id
        FROM part""",
    "v_mapping": """
        SELECT DISTINCT lower(p_brand) AS name_key,
          CASE WHEN p_brand = 'Brand#13' THEN '' ELSE concat(p_brand, ' Corp') END AS mapped
        FROM part""",
    "v_part_mapping": """
        SELECT lower(p_name) AS name_key, min(p_brand) AS mapped FROM part GROUP BY lower(p_name)""",
    "v_master": """
        SELECT DISTINCT CASE WHEN p_size % 10 = 7 THEN p_size + 1000 ELSE p_size END AS manufacturer_id,
          concat('Maker ', CAST(p_size AS STRING)) AS canonical_manufacturer_name,
          concat('Brand#', CAST(p_size AS STRING)) AS display_name,
          CASE WHEN p_size % 2 = 0 THEN 'north' ELSE 'south' END AS region,
          CASE WHEN p_size > 5 THEN CAST(floor(p_size / 5) AS INT) ELSE NULL END AS parent_manufacturer_id,
          CASE WHEN p_size > 40 THEN 'inactive' ELSE 'active' END AS manufacturer_status
        FROM part""",
    "v_observed": """
        SELECT CAST(c_nationkey AS STRING) AS list_id, CAST(l_partkey AS STRING) AS item_id,
          CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE CAST(l_suppkey AS STRING) END AS source_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "v_candidates": """
        SELECT CAST(c_nationkey + CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1000 END AS STRING) AS list_id,
          CAST(l_partkey AS STRING) AS item_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "v_lookup": """
        SELECT s_suppkey AS ord,
          CASE WHEN s_suppkey % 4 = 3 THEN concat('retired ', CAST(s_suppkey AS STRING))
               ELSE CAST(s_suppkey AS STRING) END AS source_id,
          CASE WHEN s_suppkey % 6 = 5 THEN '' ELSE concat('Source ', CAST(s_suppkey % 20 AS STRING)) END AS source_name
        FROM supplier
        UNION ALL SELECT 1000000000 + s_suppkey,
          CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS STRING)
               ELSE concat('late ', CAST(s_suppkey AS STRING)) END, 'Late duplicate'
        FROM supplier""",
    "v_research": """
        SELECT l_orderkey * 10 + l_linenumber AS line_id, CAST(l_orderkey AS STRING) AS list_id,
          CASE WHEN l_partkey % 2 = 0 THEN concat(CAST(l_partkey AS STRING), '.0')
               ELSE CAST(l_partkey AS STRING) END AS material_reference,
          CASE WHEN l_returnflag = 'A' THEN 'Yes' WHEN l_returnflag = 'N' THEN ' true ' ELSE 'no' END AS research_returned,
          CASE WHEN l_linenumber = 1 THEN '' ELSE p_brand END AS original_manufacturer, p_name AS original_article,
          CASE WHEN l_linenumber = 3 THEN ' ' ELSE p_type END AS original_typecode,
          CASE WHEN l_linenumber = 2 THEN 'nan' WHEN l_quantity <= 8 THEN 'rival' ELSE upper(p_brand) END
            AS enrichment_manufacturer,
          CASE WHEN l_quantity > 25 THEN p_name ELSE 'other' END AS enrichment_article,
          CASE WHEN l_tax <= 0.04 THEN NULL WHEN l_quantity <= 8 THEN 'zz' ELSE p_type END AS enrichment_typecode
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_matching": """
        SELECT CASE WHEN l_suppkey % 3 = 0 THEN concat('draft ', CAST(l_orderkey AS STRING))
                    ELSE CAST(l_orderkey + (l_suppkey % 2) AS STRING) END AS list_id,
          CAST(l_partkey AS STRING) AS material_reference,
          CASE WHEN l_discount > 0.05 THEN 'TRUE' ELSE 'false' END AS is_matched,
          l_returnflag AS candidate_grade, l_linestatus AS candidate_state
        FROM lineitem""",
    "v_imports": """
        SELECT CASE WHEN p_size > 25 THEN concat(CAST(p_partkey AS STRING), '.0')
                    ELSE concat('spare ', CAST(p_partkey AS STRING)) END AS material_reference FROM part
        UNION ALL SELECT CASE WHEN p_size > 35 THEN CAST(p_partkey AS STRING)
                              ELSE concat('other ', CAST(p_partkey AS STRING)) END FROM part""",
    "v_id_text": """
        SELECT l_orderkey, l_linenumber,
          CASE l_linenumber
            WHEN 1 THEN concat(CAST(l_partkey AS STRING), '.0')
            WHEN 2 THEN concat(' ', CAST(l_partkey AS STRING), ',000 ')
            WHEN 3 THEN concat(CAST(l_partkey AS STRING), 'e2')
            WHEN 4 THEN lpad(CAST(l_partkey AS STRING), 9, '0')
            WHEN 5 THEN concat('AB-', CAST(l_partkey AS STRING))
            WHEN 6 THEN concat('-', CAST(l_partkey AS STRING), '.75')
            ELSE CASE l_returnflag WHEN 'A' THEN 'NaT' WHEN 'N' THEN '  ' ELSE NULL END END AS raw
        FROM lineitem""",
    "v_date_text": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS true_day,
          CASE o_orderpriority
            WHEN '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
            WHEN '2-HIGH' THEN concat(substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2), '/',
              substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2), '/', substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4))
            WHEN '3-MEDIUM' THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T08:30:00')
            WHEN '4-NOT SPECIFIED' THEN concat(
              CASE substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2)
                WHEN '01' THEN 'Jan' WHEN '02' THEN 'Feb' WHEN '03' THEN 'Mar' WHEN '04' THEN 'Apr'
                WHEN '05' THEN 'May' WHEN '06' THEN 'Jun' WHEN '07' THEN 'Jul' WHEN '08' THEN 'Aug'
                WHEN '09' THEN 'Sep' WHEN '10' THEN 'Oct' WHEN '11' THEN 'Nov' ELSE 'Dec' END, ' ',
              substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2), ', ',
              substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4))
            ELSE CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN '' ELSE NULL END END AS raw
        FROM orders""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views, or a provided table, over the Parquet files of a folder."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source = rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b"
    return spark.sql(re.sub(source, rf"\1 parquet.`{sf_dir}/\2.parquet`", VIEWS[name]))
