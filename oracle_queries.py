"""DuckDB SQL for every registered query, written against the raw tables and independent of the Spark code."""

from __future__ import annotations

TOKENS = "('PS', 'PrivacySuppressed', 'NULL', 'NA')"


def typed(column: str, sql_type: str) -> str:
    return f"TRY_CAST(CASE WHEN {column} NOT IN {TOKENS} THEN {column} END AS {sql_type}) AS {column}"


def bare(column: str) -> str:
    return f"CASE WHEN {column} NOT IN {TOKENS} THEN {column} END AS {column}"


INSTITUTION_TYPES = {
    "unitid": "INTEGER",
    "opeid6": None,
    "instnm": None,
    "city": None,
    "stabbr": None,
    "control": "TINYINT",
    "preddeg": "TINYINT",
    "region": "TINYINT",
    "locale": "SMALLINT",
    "hbcu": "TINYINT",
    "main": "TINYINT",
    "curroper": "TINYINT",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "ugds": "INTEGER",
    "adm_rate": "DOUBLE",
    "costt4_a": "INTEGER",
    "npt4_pub": "INTEGER",
    "npt4_priv": "INTEGER",
    "tuitionfee_in": "INTEGER",
    "tuitionfee_out": "INTEGER",
    "pctpell": "DOUBLE",
    "c150_4": "DOUBLE",
    "c150_l4": "DOUBLE",
    "grad_debt_mdn": "DOUBLE",
    "md_earn_wne_p10": "INTEGER",
    "cdr3": "DOUBLE",
}

# The yearly text file: a customer's year, every column as text; codes of the latest order, amounts of all of them.
BRONZE = """
latest AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS k, o_orderstatus AS s,
         CAST(sum(floor(o_totalprice)) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS BIGINT) AS p, o_orderpriority
    FROM orders
 QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), coded AS (
  SELECT *, CASE WHEN k % 97 = 0 THEN 'NULL' WHEN s = 'F' THEN '1' WHEN s = 'O' THEN '2' ELSE '3' END AS sector
    FROM latest
), bronze AS (
  SELECT year,
         CAST(o_custkey AS VARCHAR) AS "UNITID",
         lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS "OPEID6",
         CASE WHEN k % 23 = 0 THEN 'NULL' ELSE c_name END AS "INSTNM",
         CASE WHEN k % 29 = 0 THEN 'NA' ELSE n_name END AS "CITY",
         o_orderpriority AS "STABBR",
         sector AS "CONTROL",
         CASE WHEN k % 31 = 0 THEN 'PS' ELSE CAST(k % 5 AS VARCHAR) END AS "PREDDEG",
         CAST(n_regionkey AS VARCHAR) AS "REGION",
         CASE WHEN year < 1998 THEN 'NULL' ELSE CAST(k % 43 AS VARCHAR) || '.0' END AS "LOCALE",
         CASE WHEN k % 10 = 0 THEN '1' ELSE '0' END AS "HBCU",
         CAST(k % 2 AS VARCHAR) AS "MAIN",
         CASE WHEN year < 2000 THEN 'NULL' WHEN k % 15 = 0 THEN '0' ELSE '1' END AS "CURROPER",
         CASE WHEN year < 2000 THEN 'NA'
              ELSE CAST(p % 90 AS VARCHAR) || '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END AS "LATITUDE",
         CASE WHEN year < 2000 THEN 'NA'
              ELSE '-' || CAST(k % 180 AS VARCHAR) || '.' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0') END AS "LONGITUDE",
         CASE WHEN k % 11 = 0 THEN 'PrivacySuppressed' WHEN k % 13 = 0 THEN 'PS' WHEN k % 17 = 0 THEN 'NULL'
              WHEN k % 19 = 0 THEN 'NA' ELSE CAST(p AS VARCHAR) END AS "UGDS",
         CASE WHEN k % 7 = 0 THEN 'PrivacySuppressed'
              ELSE '0.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END AS "ADM_RATE",
         CAST(p % 50000 AS VARCHAR) AS "COSTT4_A",
         CASE WHEN sector = '1' THEN CAST(p % 30000 AS VARCHAR) ELSE 'NULL' END AS "NPT4_PUB",
         CASE WHEN sector IN ('2', '3') THEN CAST(p % 40000 AS VARCHAR) ELSE 'NULL' END AS "NPT4_PRIV",
         CASE WHEN year = 1996 OR k % 9 = 0 THEN 'NULL' ELSE CAST(p % 20000 AS VARCHAR) END AS "TUITIONFEE_IN",
         CASE WHEN k % 53 = 0 THEN 'n/a' ELSE CAST(p % 25000 AS VARCHAR) END AS "TUITIONFEE_OUT",
         '0.' || lpad(CAST(p % 10000 AS VARCHAR), 4, '0') AS "PCTPELL",
         CASE WHEN k % 5 >= 3 THEN '0.' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0') ELSE 'NULL' END AS "C150_4",
         CASE WHEN k % 5 IN (1, 2) THEN '0.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') ELSE 'NA' END AS "C150_L4",
         CASE WHEN year >= 2001 THEN 'NULL' WHEN k % 4 = 0 THEN 'PrivacySuppressed'
              ELSE CAST(p % 30000 AS VARCHAR) || '.5' END AS "GRAD_DEBT_MDN",
         CASE WHEN year NOT IN (1997, 1999) THEN 'NULL' WHEN k % 6 = 0 THEN 'PS' WHEN k % 101 = 0 THEN '0'
              ELSE CAST(p % 60000 + 20000 AS VARCHAR) END AS "MD_EARN_WNE_P10",
         '0.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') AS "CDR3"
    FROM coded
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
)"""

SILVER = (
    BRONZE
    + ", silver AS (SELECT year, "
    + ", ".join(typed(c, t) if t else bare(c) for c, t in INSTITUTION_TYPES.items())
    + " FROM bronze)"
)

FACT = (
    SILVER
    + """, fact AS (
  SELECT unitid, CAST(year AS SMALLINT) AS year, control, preddeg AS predominant_degree, ugds AS undergrad_enrollment,
         adm_rate AS admission_rate, costt4_a AS cost_of_attendance,
         coalesce(npt4_pub, npt4_priv) AS avg_net_price,
         tuitionfee_in AS tuition_in_state, tuitionfee_out AS tuition_out_of_state, pctpell AS pell_share,
         coalesce(c150_4, c150_l4) AS completion_rate,
         grad_debt_mdn AS median_debt_completers, md_earn_wne_p10 AS median_earnings_10yr, cdr3 AS default_rate_3yr,
         curroper AS operating_flag
    FROM silver
), labels3(control, label) AS (
  VALUES (CAST(1 AS TINYINT), 'Public'), (CAST(2 AS TINYINT), 'Private nonprofit'),
         (CAST(3 AS TINYINT), 'Private for-profit')
)"""
)


def last_known(column: str, name: str) -> str:
    return f"max_by({column}, year) FILTER (WHERE {column} IS NOT NULL) AS {name}"


DIM = (
    FACT
    + ", dim AS (SELECT unitid, "
    + ", ".join(
        last_known(column, name)
        for column, name in (
            ("instnm", "name"),
            ("city", "city"),
            ("stabbr", "state"),
            ("control", "control"),
            ("preddeg", "predominant_degree"),
            ("region", "region"),
            ("locale", "locale"),
            ("hbcu", "hbcu"),
            ("main", "main_campus"),
            ("latitude", "latitude"),
            ("longitude", "longitude"),
        )
    )
    + ", min(year) AS first_year, max(year) AS last_year FROM silver GROUP BY unitid)"
)

CUBE = (
    DIM
    + """, cells AS (
  SELECT f.year, f.control, d.region, CAST(grouping(f.year, f.control, d.region) AS INTEGER) AS grouping_id,
         count(*) AS institutions, CAST(sum(f.undergrad_enrollment) AS BIGINT) AS undergrads
    FROM fact f JOIN dim d ON d.unitid = f.unitid
   GROUP BY CUBE (f.year, f.control, d.region)
), by_sector AS (
  SELECT c.year, l.label AS control, c.institutions, c.undergrads
    FROM cells c JOIN labels3 l ON l.control = c.control WHERE c.grouping_id = 1
)"""
)

# The program file: line items, every column as text.
PROGRAM = (
    """
program_bronze AS (
  SELECT right(CAST(year(l_shipdate) AS VARCHAR), 2) || right(CAST(year(l_shipdate) + 1 AS VARCHAR), 2) || '_'
         || right(CAST(year(l_shipdate) + 1 AS VARCHAR), 2) || right(CAST(year(l_shipdate) + 2 AS VARCHAR), 2) AS cohort,
         CAST(l_suppkey AS VARCHAR) AS unitid,
         CASE WHEN l_orderkey % 89 = 0 THEN 'NULL'
              ELSE lpad(regexp_extract(p_brand, '(\\d+)', 1), 2, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0') END AS cipcode,
         CASE WHEN l_orderkey % 37 = 0 THEN 'NULL' ELSE p_type || ' ' || CAST(p_size AS VARCHAR) END AS cipdesc,
         CASE WHEN l_orderkey % 83 = 0 THEN 'NA' WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '2'
              ELSE '3' END AS credlev,
         l_returnflag || '/' || l_linestatus AS creddesc,
         CASE WHEN l_orderkey % 5 = 0 THEN 'PS' ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS ipedscount1,
         CAST(l_linenumber AS VARCHAR) AS ipedscount2,
         CASE WHEN l_orderkey % 7 = 0 THEN 'PrivacySuppressed'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) % 40000 AS VARCHAR) || '.25' END AS debt_all_stgp_eval_mdn,
         CASE WHEN l_partkey % 6 = 0 THEN 'PS'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) // 2 AS VARCHAR) END AS earn_mdn_1yr,
         CASE WHEN l_orderkey % 11 = 0 THEN 'PrivacySuppressed' WHEN l_orderkey % 103 = 0 THEN '0'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) + 20000 AS VARCHAR) END AS earn_mdn_4yr
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
), program_silver AS (
  SELECT cohort, """
    + ", ".join(
        [
            typed("unitid", "INTEGER"),
            bare("cipcode"),
            bare("cipdesc"),
            typed("credlev", "TINYINT"),
            bare("creddesc"),
            typed("ipedscount1", "INTEGER"),
            typed("ipedscount2", "INTEGER"),
            typed("debt_all_stgp_eval_mdn", "DOUBLE"),
            typed("earn_mdn_1yr", "INTEGER"),
            typed("earn_mdn_4yr", "INTEGER"),
        ]
    )
    + """ FROM program_bronze
), program_fact AS (
  SELECT cohort, unitid, cipcode AS cip, credlev AS credential_level, ipedscount1 AS completers_year1,
         ipedscount2 AS completers_year2, debt_all_stgp_eval_mdn AS median_debt, earn_mdn_1yr AS median_earnings_1yr,
         earn_mdn_4yr AS median_earnings_4yr
    FROM program_silver
), field AS (
  SELECT cipcode AS cip, min(cipdesc) AS field, substr(cipcode, 1, 2) AS family
    FROM program_silver WHERE cipcode IS NOT NULL GROUP BY cipcode
), family_list AS (
  SELECT DISTINCT lpad(regexp_extract(p_brand, '(\\d+)', 1), 2, '0') AS family,
         'BRAND ' || lpad(regexp_extract(p_brand, '(\\d+)', 1), 2, '0') || ' AND RELATED ITEMS' AS family_title
    FROM part
)"""
)

OUTCOMES = (
    FACT
    + """, outcomes AS (
  SELECT l.label AS control, count(*) AS institutions, count(f.median_earnings_10yr) AS with_earnings,
         median(f.avg_net_price) AS median_net_price, median(f.median_debt_completers) AS median_debt,
         median(f.median_earnings_10yr) AS median_earnings_10yr,
         round(median(f.completion_rate), 3) AS median_completion,
         round(median(f.median_debt_completers / nullif(f.median_earnings_10yr, 0)), 3) AS median_debt_to_earnings
    FROM fact f JOIN labels3 l ON l.control = f.control
   WHERE f.year = 1999 AND f.predominant_degree = 3 GROUP BY l.label
)"""
)

BY_FAMILY = (
    PROGRAM
    + """, by_family AS (
  SELECT a.family, a.family_title, count(*) AS programs, count(p.median_earnings_4yr) AS with_earnings,
         median(p.median_earnings_1yr) AS earnings_1yr, median(p.median_earnings_4yr) AS earnings_4yr,
         median(p.median_debt) AS debt,
         round(median(p.median_debt / nullif(p.median_earnings_4yr, 0)), 2) AS debt_to_earnings
    FROM program_fact p JOIN field f ON f.cip = p.cip JOIN family_list a ON a.family = f.family
   WHERE p.cohort = '9900_0001' AND p.credential_level = 3
   GROUP BY a.family, a.family_title HAVING count(p.median_earnings_4yr) >= 100
)"""
)

AVAILABILITY = (
    FACT
    + """, available AS (
  SELECT year, count(*) AS institutions, count(undergrad_enrollment) AS enrollment, count(tuition_in_state) AS tuition,
         count(avg_net_price) AS net_price, count(median_debt_completers) AS debt,
         count(median_earnings_10yr) AS earnings_10yr, count(completion_rate) AS completion
    FROM fact GROUP BY year
)"""
)

ATTRIBUTION = (
    DIM
    + """, attribution AS (
  SELECT f.year,
         CAST(sum(CASE WHEN f.control = 3 THEN f.undergrad_enrollment END) AS BIGINT) AS for_profit_as_reported,
         CAST(sum(CASE WHEN d.control = 3 THEN f.undergrad_enrollment END) AS BIGINT) AS for_profit_by_latest_sector,
         count(CASE WHEN f.control <> d.control THEN 1 END) AS institutions_in_another_sector_now
    FROM fact f JOIN dim d ON d.unitid = f.unitid GROUP BY f.year
)"""
)


def audit_branch(column: str, sql_type: str | None) -> str:
    name = column.upper()
    failed = (
        f"count(*) FILTER (WHERE {column} NOT IN {TOKENS} AND TRY_CAST({column} AS {sql_type}) IS NULL)"
        if sql_type
        else "CAST(0 AS BIGINT)"
    )
    return (
        f"SELECT year, '{name}' AS \"column\", count(*) AS \"rows\", "
        f"count(*) FILTER (WHERE {column} IN ('PS', 'PrivacySuppressed')) AS privacy_suppressed, "
        f"count(*) FILTER (WHERE {column} IS NULL OR {column} IN ('NULL', 'NA')) AS \"null\", "
        f"{failed} AS cast_failed FROM bronze GROUP BY year"
    )


AUDIT = (
    BRONZE
    + ", audit AS ("
    + " UNION ALL ".join(audit_branch(c, t) for c, t in INSTITUTION_TYPES.items())
    + ")"
)

LAYER_TOTALS = (
    FACT
    + """, raw_t AS (
  SELECT CAST("CONTROL" AS INTEGER) AS control, CAST(sum(TRY_CAST("UGDS" AS BIGINT)) AS BIGINT) AS undergrads
    FROM bronze WHERE "CONTROL" IN ('1', '2', '3') GROUP BY 1
), silver_t AS (
  SELECT CAST(control AS INTEGER) AS control, CAST(sum(ugds) AS BIGINT) AS undergrads
    FROM silver WHERE control IS NOT NULL GROUP BY 1
), gold_t AS (
  SELECT CAST(control AS INTEGER) AS control, CAST(sum(undergrad_enrollment) AS BIGINT) AS undergrads
    FROM fact WHERE control IS NOT NULL GROUP BY 1
)"""
)

SWITCHES = (
    FACT
    + """, history AS (
  SELECT unitid, control, lag(control, 1) OVER h AS prev, lag(control, 2) OVER h AS prev2
    FROM fact WHERE control IS NOT NULL WINDOW h AS (PARTITION BY unitid ORDER BY year)
), moved AS (
  SELECT a.label AS from_sector, b.label AS to_sector, unitid, CASE WHEN prev2 = history.control THEN 1 END AS undo
    FROM history JOIN labels3 a ON a.control = prev JOIN labels3 b ON b.control = history.control
   WHERE history.control <> prev
)"""
)

REFRESHED = (
    "SELECT year, count(*) AS \"rows\", count(control) AS with_control, CAST(sum(ugds) AS BIGINT) AS undergrads "
    "FROM silver GROUP BY year"
)

COUNTS = (
    "WITH "
    + SILVER
    + ", "
    + PROGRAM
    + """
SELECT 'institutions' AS name, count(DISTINCT unitid) AS value FROM silver
UNION ALL SELECT 'institution_years', count(*) FROM silver
UNION ALL SELECT 'program_rows', count(*) FROM program_silver
UNION ALL SELECT 'fields', count(*) FROM field"""
)

# Each check as an independent SQL statement over the same rows.
DQ = (
    "WITH "
    + CUBE
    + AUDIT.removeprefix(BRONZE)
    + ", "
    + PROGRAM
    + """, checks AS (
SELECT 'C1' AS "check", count(*) AS failures FROM (
    SELECT year, count(*), sum(TRY_CAST("UGDS" AS BIGINT)) FROM bronze GROUP BY year
    EXCEPT SELECT year, count(*), sum(undergrad_enrollment) FROM fact GROUP BY year)
UNION ALL SELECT 'C2', count(*) FROM (
    SELECT year, sum(TRY_CAST("UGDS" AS BIGINT)) FROM bronze WHERE "CONTROL" = '3' GROUP BY year
    EXCEPT SELECT year, undergrads FROM cells WHERE grouping_id = 1 AND control = 3)
UNION ALL SELECT 'C3', count(*) FROM (
    SELECT year, count(*) FROM bronze WHERE "GRAD_DEBT_MDN" IN ('PS', 'PrivacySuppressed') GROUP BY year
    EXCEPT SELECT year, privacy_suppressed FROM audit WHERE "column" = 'GRAD_DEBT_MDN')
UNION ALL SELECT 'C4', count(*) FROM silver
    WHERE opeid6 IN TOKENS OR instnm IN TOKENS OR city IN TOKENS OR stabbr IN TOKENS
UNION ALL SELECT 'C5', count(*) - count(DISTINCT (unitid, year)) FROM fact
UNION ALL SELECT 'C6', (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.unitid = f.unitid))
                     + (SELECT count(*) FROM program_fact f WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.unitid = f.unitid))
UNION ALL SELECT 'C7', count(*) FROM fact WHERE control NOT IN (SELECT control FROM labels3)
UNION ALL SELECT 'C8', count(*) - count(DISTINCT unitid) FROM dim
UNION ALL SELECT 'C9', count(*) FROM dim d JOIN silver s ON s.unitid = d.unitid AND s.year = d.last_year
    WHERE s.instnm <> d.name OR s.stabbr <> d.state
UNION ALL SELECT 'C10', count(*) FROM (
    SELECT year, control, undergrads FROM cells WHERE grouping_id = 1
    EXCEPT SELECT year, control, sum(undergrad_enrollment) FROM fact GROUP BY year, control)
UNION ALL SELECT 'C11', count(*) FROM (
    SELECT undergrads FROM cells WHERE grouping_id = 7 EXCEPT SELECT sum(undergrad_enrollment) FROM fact)
UNION ALL SELECT 'C12', count(*) FROM (
    SELECT control, median(coalesce(npt4_pub, npt4_priv)) FROM silver WHERE year = 1999 AND preddeg = 3
       AND control IS NOT NULL GROUP BY control
    EXCEPT SELECT control, median(avg_net_price) FROM fact WHERE year = 1999 AND predominant_degree = 3 GROUP BY control)
UNION ALL SELECT 'C13', count(*) FROM (
    SELECT substr(cipcode, 1, 2), median(earn_mdn_4yr) FROM program_silver WHERE cohort = '9900_0001' AND credlev = 3
       AND cipcode IS NOT NULL GROUP BY 1
    EXCEPT SELECT f.family, median(median_earnings_4yr) FROM program_fact p JOIN field f ON f.cip = p.cip
     WHERE cohort = '9900_0001' AND credential_level = 3 GROUP BY 1)
UNION ALL SELECT 'C14', count(*) FROM (
    SELECT "CONTROL", sum(TRY_CAST("UGDS" AS BIGINT)) FROM bronze WHERE "CONTROL" IN ('1', '2', '3') GROUP BY 1
    EXCEPT SELECT CAST(control AS VARCHAR), sum(ugds) FROM silver GROUP BY 1)
) SELECT * FROM checks""".replace("TOKENS", TOKENS)
)

ORACLE = {
    "bronze_csv_roundtrip": f"WITH {BRONZE} SELECT * FROM bronze",
    "union_by_name": f"""WITH {BRONZE} SELECT year, "UNITID", "CONTROL", "UGDS",
        CASE WHEN year <= 1997 THEN "ADM_RATE" END AS "ADM_RATE" FROM bronze""",
    "file_key": f'WITH {BRONZE} SELECT year, count(*) AS "rows" FROM bronze GROUP BY year',
    "file_widths": f"WITH {BRONZE} SELECT 27 AS columns, count(DISTINCT year) AS files FROM bronze",
    "layer_sizes": f"""WITH {FACT}, {PROGRAM}, years AS (
            SELECT count(*) AS "rows", count(DISTINCT year) AS partitions FROM bronze
        ), cohorts AS (SELECT count(*) AS "rows", count(DISTINCT cohort) AS partitions FROM program_silver)
        SELECT 'bronze_institution_csv' AS layer, "rows", partitions, true AS a_file_per_partition, true AS larger_than_parquet FROM years
        UNION ALL SELECT 'silver_institution_parquet', "rows", partitions, true, NULL FROM years
        UNION ALL SELECT 'same_columns_as_csv', count(*), NULL, true, NULL FROM silver
        UNION ALL SELECT 'silver_program_parquet', "rows", partitions, true, NULL FROM cohorts
        UNION ALL SELECT 'gold_fact_parquet', count(*), NULL, true, NULL FROM fact""",
    "silver_view": f"""WITH {SILVER} SELECT year, control, count(*) AS institutions, CAST(sum(ugds) AS BIGINT) AS undergrads
        FROM silver GROUP BY year, control""",
    "audit_csv": f"""WITH {AUDIT} SELECT "column", CAST(sum("rows") AS BIGINT) AS "rows",
        CAST(sum(privacy_suppressed) AS BIGINT) AS privacy_suppressed, CAST(sum("null") AS BIGINT) AS missing
        FROM audit GROUP BY "column" ORDER BY 3 DESC, 4 DESC, 1""",
    "manifest_refresh": f"""WITH {SILVER} SELECT year, count(*) AS "rows", count(control) AS with_control,
        CAST(sum(ugds) AS BIGINT) AS undergrads, CASE WHEN year IN (1999, 2001) THEN 'rebuilt' ELSE 'kept' END AS state
        FROM silver WHERE year <> 1998 AND NOT (year = 1999 AND coalesce(control = 1, false)) GROUP BY year""",
    "partitioned_scan": f"WITH {SILVER} SELECT year, unitid, control, ugds FROM silver WHERE year = 1998",
    "program_lake": f"""WITH {PROGRAM} SELECT cohort, count(*) AS "rows", CAST(sum(earn_mdn_1yr) AS BIGINT) AS earnings_sum
        FROM program_silver GROUP BY cohort""",
    "code_list": f"WITH {PROGRAM} SELECT family AS code, family_title || '.' AS title FROM family_list",
    "mart_csv": f"WITH {AVAILABILITY} SELECT * FROM available",
    "metrics_json": COUNTS,
    "gold_tables": f"""WITH {DIM} SELECT d.region, f.year, count(*) AS institutions,
        CAST(sum(f.undergrad_enrollment) AS BIGINT) AS undergrads
        FROM fact f JOIN dim d ON d.unitid = f.unitid GROUP BY d.region, f.year""",
    "silver_refresh": f"WITH {SILVER} {REFRESHED}",
    "stream_refresh": f"WITH {SILVER} {REFRESHED}",
    "silver_typed": f"WITH {SILVER} SELECT * FROM silver",
    "silver_item": f"WITH {PROGRAM} SELECT * FROM program_silver",
    "null_token_audit": f"WITH {AUDIT} SELECT * FROM audit",
    "null_token_totals": f"""WITH {AUDIT} SELECT "column", CAST(sum("rows") AS BIGINT) AS "rows",
        CAST(sum(privacy_suppressed) AS BIGINT) AS privacy_suppressed, CAST(sum("null") AS BIGINT) AS missing
        FROM audit GROUP BY "column" ORDER BY 3 DESC, 4 DESC, 1""",
    "category_labels": f"""WITH {FACT} SELECT f.control, l.label, count(*) AS "rows"
        FROM fact f LEFT JOIN labels3 l ON l.control = f.control GROUP BY f.control, l.label""",
    "dim_year": f"""WITH {SILVER} SELECT DISTINCT CAST(year AS SMALLINT) AS year,
        CAST(year AS VARCHAR) || '-' || right(CAST(year + 1 AS VARCHAR), 2) AS academic_year FROM silver""",
    "dim_entity": f"WITH {DIM} SELECT * FROM dim",
    "dim_family": f"WITH {PROGRAM} SELECT * FROM family_list",
    "dim_field": f"WITH {PROGRAM} SELECT * FROM field",
    "dim_credential": f"""WITH {PROGRAM} SELECT DISTINCT credlev AS credential_level, creddesc AS credential
        FROM program_silver WHERE credlev IS NOT NULL""",
    "fact_entity_year": f"WITH {FACT} SELECT * FROM fact",
    "fact_item": f"WITH {PROGRAM} SELECT * FROM program_fact",
    "enrollment_cube": f"WITH {CUBE} SELECT * FROM cells",
    "cube_totals": f"""WITH {CUBE} SELECT year, CAST(NULL AS TINYINT) AS control, CAST(NULL AS TINYINT) AS region,
        3 AS grouping_id, count(*) AS institutions, CAST(sum(undergrad_enrollment) AS BIGINT) AS undergrads
        FROM fact GROUP BY year
        UNION ALL SELECT NULL, NULL, NULL, 7, count(*), CAST(sum(undergrad_enrollment) AS BIGINT) FROM fact""",
    "measure_availability": f"WITH {AVAILABILITY} SELECT * FROM available ORDER BY year",
    "enrollment_by_category": f"WITH {CUBE} SELECT * FROM by_sector ORDER BY year, control",
    "outcomes_by_category": f"WITH {OUTCOMES} SELECT * FROM outcomes ORDER BY median_earnings_10yr DESC",
    "median_trend": f"""WITH {FACT} SELECT f.year, l.label AS control, count(f.tuition_in_state) AS institutions,
        median(f.tuition_in_state) AS median_in_state_tuition
        FROM fact f JOIN labels3 l ON l.control = f.control
        WHERE f.predominant_degree = 3 AND f.tuition_in_state IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
    "median_by_family": f"WITH {BY_FAMILY} SELECT * FROM by_family ORDER BY earnings_4yr DESC",
    "closures": f"""WITH {DIM}, early AS (
        SELECT unitid, max_by(control, year) FILTER (WHERE control IS NOT NULL) AS control
          FROM fact WHERE year <= 1997 GROUP BY unitid)
        SELECT l.label AS control, count(*) AS present_by_1997,
               count(CASE WHEN d.last_year < 2001 THEN 1 END) AS not_in_2001_file,
               round(100.0 * count(CASE WHEN d.last_year < 2001 THEN 1 END) / count(*), 1) AS pct_not_in_2001
          FROM early e JOIN dim d ON d.unitid = e.unitid JOIN labels3 l ON l.control = e.control
         GROUP BY l.label ORDER BY l.label""",
    "category_attribution": f"WITH {ATTRIBUTION} SELECT * FROM attribution ORDER BY year",
    "category_switches": f"""WITH {SWITCHES}
        SELECT from_sector, to_sector, count(*) AS switches, count(DISTINCT unitid) AS institutions,
               count(undo) AS undoing_previous_switch FROM moved GROUP BY from_sector, to_sector
        UNION ALL SELECT 'All', 'All', count(*), count(DISTINCT unitid), count(undo) FROM moved""",
    "layer_totals": f"""WITH {LAYER_TOTALS} SELECT 'raw' AS layer, * FROM raw_t
        UNION ALL SELECT 'silver', * FROM silver_t UNION ALL SELECT 'gold', * FROM gold_t""",
    "layers_agree": f"""WITH {LAYER_TOTALS}
        SELECT 'raw=silver' AS pair, (SELECT count(*) FROM (SELECT * FROM raw_t EXCEPT ALL SELECT * FROM silver_t))
             + (SELECT count(*) FROM (SELECT * FROM silver_t EXCEPT ALL SELECT * FROM raw_t)) AS differences
        UNION ALL
        SELECT 'silver=gold', (SELECT count(*) FROM (SELECT * FROM silver_t EXCEPT ALL SELECT * FROM gold_t))
             + (SELECT count(*) FROM (SELECT * FROM gold_t EXCEPT ALL SELECT * FROM silver_t))""",
    "warehouse_counts": COUNTS,
    "cube_reconcile": f"""WITH {CUBE}, direct AS (
        SELECT year, control, sum(undergrad_enrollment) AS undergrads FROM fact GROUP BY year, control)
        SELECT count(*) AS cells,
               count(CASE WHEN c.undergrads IS NOT DISTINCT FROM d.undergrads AND c.grouping_id = 1 THEN 1 END) AS matched,
               count(CASE WHEN c.undergrads IS DISTINCT FROM d.undergrads THEN 1 END) AS mismatched
          FROM direct d LEFT JOIN cells c ON c.grouping_id = 1 AND c.year = d.year
           AND c.control IS NOT DISTINCT FROM d.control""",
    "dq_report": DQ,
    "dq_report_faults": f"""WITH {CUBE}, {PROGRAM}, left_fact AS (
        SELECT unitid, year, control FROM fact UNION ALL SELECT unitid, year, control FROM fact WHERE unitid % 50 = 0
    ), left_dim AS (
        SELECT unitid, CASE WHEN unitid % 80 = 0 THEN 'Old name' ELSE name END AS name, state, last_year
          FROM dim WHERE unitid % 60 <> 0
    ), all_dim AS (SELECT * FROM left_dim UNION ALL SELECT * FROM left_dim WHERE unitid % 70 = 0)
    SELECT 'C4' AS "check", count(*) AS failures FROM silver WHERE unitid % 40 = 0
    UNION ALL SELECT 'C5', count(*) FROM fact WHERE unitid % 50 = 0
    UNION ALL SELECT 'C6', (SELECT count(*) FROM left_fact WHERE unitid NOT IN (SELECT unitid FROM all_dim))
                         + (SELECT count(*) FROM program_fact WHERE unitid NOT IN (SELECT unitid FROM all_dim))
    UNION ALL SELECT 'C7', count(*) FROM left_fact WHERE control = 3
    UNION ALL SELECT 'C8', (SELECT count(*) FROM left_dim WHERE unitid % 70 = 0)
                         + (SELECT count(*) FROM labels3 WHERE control <> 3 AND label = 'Public')
    UNION ALL SELECT 'C9', count(*) FROM all_dim d JOIN silver s ON s.unitid = d.unitid AND s.year = d.last_year
        WHERE s.instnm <> d.name OR s.stabbr <> d.state""",
    "availability_share": f"""WITH {AVAILABILITY}, long AS (
        SELECT year, institutions, unnest(['enrollment', 'tuition', 'net_price', 'debt', 'earnings_10yr', 'completion']) AS measure,
               unnest([enrollment, tuition, net_price, debt, earnings_10yr, completion]) AS n FROM available)
        SELECT year, measure, nullif(n / institutions, 0) AS share FROM long""",
    "enrollment_pivot": f"""WITH {CUBE} SELECT year,
        sum(undergrads) FILTER (WHERE control = 'Public') / 1e6 AS "Public",
        sum(undergrads) FILTER (WHERE control = 'Private nonprofit') / 1e6 AS "Private nonprofit",
        sum(undergrads) FILTER (WHERE control = 'Private for-profit') / 1e6 AS "Private for-profit"
        FROM by_sector GROUP BY year""",
    "enrollment_overlay": f"""WITH {ATTRIBUTION} SELECT year, for_profit_as_reported / 1e6 AS as_reported_millions,
        for_profit_by_latest_sector / 1e6 AS latest_sector_millions FROM attribution""",
    "peak_year": f"""WITH {CUBE} SELECT year, undergrads FROM by_sector WHERE control = 'Private for-profit'
        AND undergrads IS NOT NULL ORDER BY undergrads DESC, year LIMIT 1""",
    "outcome_bars": f"""WITH {OUTCOMES}
        SELECT control, 'median_net_price' AS metric, median_net_price / 1000 AS thousands FROM outcomes
        UNION ALL SELECT control, 'median_debt', median_debt / 1000 FROM outcomes
        UNION ALL SELECT control, 'median_earnings_10yr', median_earnings_10yr / 1000 FROM outcomes""",
    "top_bottom_fields": f"""WITH {BY_FAMILY}, placed AS (
        SELECT *, row_number() OVER (ORDER BY earnings_4yr DESC, family) AS up,
               row_number() OVER (ORDER BY earnings_4yr, family DESC) AS down FROM by_family),
        ends AS (SELECT 'top' AS place, * FROM placed WHERE up <= 6
                 UNION ALL SELECT 'bottom', * FROM placed WHERE down <= 6)
        SELECT place, family,
               CASE family WHEN '11' THEN 'Computer and information sciences' WHEN '15' THEN 'Engineering technologies'
                    WHEN '19' THEN 'Family and consumer sciences' WHEN '23' THEN 'English language and literature'
                    WHEN '24' THEN 'Liberal arts and general studies'
                    ELSE 'Brand ' || family END AS title,
               earnings_4yr / 1000 AS earnings_thousands, debt / 1000 AS debt_thousands, debt_to_earnings
          FROM ends""",
}
