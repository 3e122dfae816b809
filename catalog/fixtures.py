"""Snapshots derived from the driver's tables, as SQL that Spark and DuckDB both run.

Every view is computed from whole tables. A remainder test inside a view decides which
branch of an operator a row takes (withdrawn upstream, no lab id, a child, ...); it is
never there to make a table smaller. Left out are only the people whom the registry does not know (``c_custkey%10 = 9``
in ``fx_registry``) and the records that a registry row points to but the source has withdrawn (``o_orderkey%4 = 3``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"]

FX: dict[str, str] = {}

FX["fx_registry"] = """
SELECT c_custkey AS cuimc_id,
 CASE WHEN m5=0 THEN coalesce(CAST(ok AS STRING),'') ELSE '' END AS record_id,
 CASE WHEN m5=1 THEN concat('lab', CAST(c_custkey AS STRING)) ELSE '' END AS participant_lab_id,
 lower(trim(c_mktsegment)) AS first_local, concat('fam', CAST(fam AS STRING)) AS last_local, dob,
 CASE WHEN m5=3 THEN concat('kid', CAST(c_custkey AS STRING)) ELSE '' END AS child_first,
 CASE WHEN m5=3 THEN concat('fam', CAST(fam AS STRING)) ELSE '' END AS last_child,
 CASE WHEN m5=3 THEN '2015-06-01' ELSE '' END AS dob_child,
 CASE WHEN c_custkey%6=5 THEN '' ELSE concat('M', CAST(c_custkey AS STRING)) END AS mrn,
 CASE WHEN c_custkey%6=0 THEN concat('E', CAST(c_custkey AS STRING)) ELSE '' END AS cuimc_empi,
 CASE WHEN m5=0 THEN lower(trim(c_mktsegment)) ELSE '' END AS first_name,
 CASE WHEN m5=0 THEN concat('alt', CAST(c_custkey AS STRING)) ELSE '' END AS last_name,
 CASE WHEN m5=0 THEN dob ELSE '' END AS date_of_birth,
 '' AS first_name_child, '' AS last_name_child, '' AS date_of_birth_child,
 CASE WHEN c_custkey%11=0 THEN '9' ELSE '1' END AS rec_outcome,
 CASE WHEN c_custkey%23=0 THEN '9' ELSE '' END AS rec_outcome_2, '' AS rec_outcome_3
FROM (SELECT cu.*, c_custkey%5 AS m5, c_custkey%40 AS fam, concat(CAST(1950+c_custkey%13 AS STRING),'-01-15') AS dob, fo.ok
  FROM customer cu LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS ok FROM orders GROUP BY o_custkey) fo
  ON fo.o_custkey=cu.c_custkey WHERE c_custkey%10<>9) c
"""

FX["fx_source"] = """
SELECT CAST(o_orderkey AS STRING) AS record_id,
 CASE WHEN c_custkey%5=1 THEN concat('lab',CAST(c_custkey AS STRING)) ELSE '' END AS participant_lab_id,
 CASE WHEN c_custkey%5=3 THEN 10 WHEN o_orderkey%7=0 THEN 999 ELSE 40 END AS age,
 lower(trim(c_mktsegment)) AS first_name, concat('fam',CAST(c_custkey%40 AS STRING)) AS last_name,
 concat(CAST(1950+c_custkey%13 AS STRING),'-01-15') AS date_of_birth,
 CASE WHEN c_custkey%5=3 THEN concat('kid',CAST(c_custkey AS STRING)) ELSE '' END AS first_name_child,
 CASE WHEN c_custkey%5=3 THEN concat('fam',CAST(c_custkey%40 AS STRING)) ELSE '' END AS last_name_child,
 CASE WHEN c_custkey%5=3 THEN '2015-06-01' ELSE '' END AS date_of_birth_child,
 o_orderdate AS last_update_timestamp, concat('http://q/',CAST(o_orderkey AS STRING)) AS survey_queue_link
FROM orders JOIN customer ON o_custkey=c_custkey
 LEFT JOIN (SELECT min(o_orderkey) AS linked FROM orders GROUP BY o_custkey) f ON f.linked=o_orderkey
WHERE f.linked IS NULL OR o_orderkey%4<>3
"""

FX["fx_source_raw"] = """
SELECT CAST(o_orderkey AS STRING) AS record_id, '' AS redcap_repeat_instrument, 0 AS redcap_repeat_instance,
 CASE WHEN o_orderkey%7=0 THEN '' WHEN o_orderkey%31=0 THEN 'n.a.' WHEN o_orderkey%37=0 THEN '40.5' ELSE ' 40 ' END AS age,
 CASE WHEN o_orderkey%13=0 THEN NULL ELSE concat('  ', upper(o_orderpriority), ' ') END AS first_name,
 concat('http://q/',CAST(o_orderkey AS STRING)) AS survey_queue_link,
 CASE WHEN o_orderkey%9=0 THEN 'NaN' WHEN o_orderkey%11=0 THEN NULL ELSE 'x' END AS note, '' AS finding
FROM orders LEFT JOIN (SELECT min(o_orderkey) AS linked FROM orders GROUP BY o_custkey) f ON f.linked=o_orderkey
WHERE f.linked IS NULL OR o_orderkey%4<>3
UNION ALL
SELECT CAST(o_orderkey AS STRING), '', 1, '41', 'second', concat('http://a/',CAST(o_orderkey AS STRING)), 'y', ''
FROM orders LEFT JOIN (SELECT min(o_orderkey) AS linked FROM orders GROUP BY o_custkey) f ON f.linked=o_orderkey
WHERE o_orderkey%17=0 AND (f.linked IS NULL OR o_orderkey%4<>3)
UNION ALL
SELECT ' ', '', 0, '', 'nobody', concat('http://n/',CAST(r_regionkey AS STRING)), '', '' FROM region
UNION ALL
SELECT CAST(l_orderkey AS STRING), CASE WHEN l_linenumber%3=0 THEN 'labs' ELSE 'visit' END,
 CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber%3=0 ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS INT), '',
 CASE WHEN l_linenumber%2=0 THEN NULL ELSE 'later' END, '', CASE WHEN l_linenumber%3=0 THEN NULL ELSE concat('r',CAST(l_linenumber AS STRING)) END, concat('p',CAST(l_partkey AS STRING))
FROM lineitem
"""

FX["fx_dates"] = """
SELECT event_id, CASE event_id%4 WHEN 0 THEN d WHEN 1 THEN concat(substr(d,6,2),'/',substr(d,9,2),'/',substr(d,1,4)) WHEN 2 THEN '' ELSE 'unknown' END AS dob_text
FROM (SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS d FROM events) e
"""

FX["fx_intake"] = """
SELECT CAST(1000000+c_custkey AS STRING) AS cuimc_id,
 CASE WHEN c_custkey%15=0 THEN '' WHEN c_custkey%6=0 THEN concat('M',CAST(c_custkey AS STRING)) ELSE concat('N',CAST(c_custkey AS STRING)) END AS mrn,
 concat(' ',upper(c_mktsegment)) AS first_local,
 CASE WHEN c_custkey%21=0 THEN '' WHEN c_custkey%9=0 THEN concat('FAM',CAST(c_custkey%40 AS STRING)) ELSE concat('New',CAST(c_custkey AS STRING)) END AS last_local,
 CASE WHEN c_custkey%33=0 THEN '' ELSE concat(CAST(1950+c_custkey%13 AS STRING),'-01-15') END AS dob,
 '' AS last_child, '' AS child_first, '' AS dob_child, concat('s',CAST(c_custkey%3 AS STRING)) AS site
FROM customer
"""

FX["fx_patient_map"] = """
SELECT concat('E',CAST(c_custkey AS STRING)) AS empi, concat('M',CAST(c_custkey AS STRING)) AS local_pt_id,
 CASE c_custkey%4 WHEN 0 THEN 'P' WHEN 1 THEN 'UI' WHEN 2 THEN 'X' ELSE 'P' END AS facility_code FROM customer
UNION ALL
SELECT concat('E2',CAST(c_custkey AS STRING)), concat('M',CAST(c_custkey AS STRING)), 'UI' FROM customer WHERE c_custkey%7=0
UNION ALL
SELECT concat('M',CAST(c_custkey AS STRING)), 'old', 'X' FROM customer WHERE c_custkey%15=2
"""

FX["fx_provider"] = """
SELECT s_suppkey AS cuimc_id, CASE s_suppkey%10
 WHEN 0 THEN concat('Dr. Ana Fam',k) WHEN 1 THEN concat('Ana Fam',k,', MD') WHEN 2 THEN concat('Ana Q. Fam',k)
 WHEN 3 THEN concat('Dra Fam',k) WHEN 4 THEN concat('Ana Q Fam',k,' NP') WHEN 5 THEN concat('  Ana   Fam',k,' ')
 WHEN 6 THEN concat('Dr Ana Q Fam',k) WHEN 7 THEN concat('Fam',k) WHEN 8 THEN '' ELSE ' ., ' END AS provider_name
FROM (SELECT s_suppkey, CAST(s_suppkey AS STRING) AS k FROM supplier) s
"""

FX["fx_npi"] = """
SELECT 1000000000+s_suppkey AS npi, 'ana' AS first_name, concat('fam',CAST(s_suppkey AS STRING)) AS last_name FROM supplier WHERE s_suppkey%9<>8
UNION ALL
SELECT 1900000000+s_suppkey, 'ana', concat('fam',CAST(s_suppkey AS STRING)) FROM supplier WHERE s_suppkey%7=0
"""

FX["fx_dict_registry"] = """
SELECT concat('f',CAST(p_partkey AS STRING)) AS field_name, lower(p_type) AS form_name, p_partkey AS seq,
 CASE WHEN p_partkey%17=0 THEN '@CALC(1)' ELSE '' END AS annotation FROM part WHERE p_partkey%3<>0
"""

FX["fx_dict_source"] = """
SELECT concat('f',CAST(p_partkey AS STRING)) AS field_name, lower(p_type) AS form_name, p_partkey AS seq,
 CASE WHEN p_partkey%19=0 THEN '@CALC(2)' ELSE '' END AS annotation FROM part WHERE p_partkey%3<>1
UNION ALL SELECT 'record_id', 'enrol', -1, ''
"""

FX["fx_ignore"] = """
SELECT concat('f',CAST(p_partkey AS STRING)) AS field_name, CASE WHEN p_partkey%20=0 THEN '1' ELSE '0' END AS flag FROM part
UNION ALL SELECT 'gone_upstream', '1'
"""

FX["fx_files"] = """
SELECT page_id AS record_id,
 CASE WHEN page_id%3=0 THEN '' ELSE concat('m',CAST(page_id AS STRING),'.json') END AS json_file,
 CASE WHEN page_id%5=0 THEN '' ELSE concat('g',CAST(page_id AS STRING),'.pdf') END AS pdf_file FROM pages
"""

FX["fx_file_repo"] = """
SELECT concat('m',CAST(page_id AS STRING),'.json') AS file_name FROM pages WHERE page_id%4=0
UNION ALL SELECT concat('g',CAST(page_id AS STRING),'.pdf') FROM pages WHERE page_id%7=0
"""

FX["fx_survey"] = """
SELECT o_orderkey AS record_id, CASE WHEN o_orderstatus='F' THEN '2' ELSE '0' END AS previous_survey_complete,
 CASE WHEN o_orderkey%3=0 THEN '2' WHEN o_orderkey%3=1 THEN '' ELSE '1' END AS reminder_survey_complete,
 concat('http://q/',CAST(o_orderkey AS STRING)) AS survey_queue_link, CAST(o_orderdate AS DATE) AS run_date FROM orders
"""

FX["fx_survey_sent"] = """
SELECT o_orderkey AS record_id FROM orders WHERE o_orderkey%8=0
"""

FX["fx_alerts"] = """
SELECT n_nationkey AS alert_id, n_regionkey AS project_id FROM nation
"""

FX["fx_alerts_sent"] = """
SELECT c_custkey AS alert_sent_id, c_nationkey AS alert_id FROM customer
"""

FX["fx_alerts_recurrence"] = """
SELECT s_suppkey AS recurrence_id, s_nationkey AS alert_id FROM supplier
"""

FX["fx_alerts_sent_log"] = """
SELECT o_orderkey AS log_id, o_custkey AS alert_sent_id FROM orders
"""

FX["fx_payload"] = """
SELECT c_custkey+CASE WHEN c_custkey%50=0 THEN 10000000 ELSE 0 END AS cuimc_id,
 CASE WHEN c_custkey%4=0 THEN '' ELSE concat('new',CAST(c_custkey AS STRING)) END AS mrn, '1' AS local_batch_upload
FROM customer WHERE c_custkey%2=0
UNION ALL SELECT c_custkey, 'again', '1' FROM customer WHERE c_custkey%32=0
UNION ALL SELECT CAST(NULL AS BIGINT), concat('nokey',CAST(r_regionkey AS STRING)), '1' FROM region
"""

FX["fx_delete_ids"] = """
SELECT c_custkey AS cuimc_id FROM customer WHERE c_custkey%50=0
UNION ALL SELECT c_custkey+20000000 FROM customer WHERE c_custkey%100=0
"""

FX["fx_lookup"] = """
SELECT c_custkey AS request_id, concat('M',CAST(c_custkey AS STRING)) AS mrn, lower(trim(c_mktsegment)) AS first_name,
 CASE WHEN c_custkey%8=0 THEN 'other' ELSE concat('fam',CAST(c_custkey%40 AS STRING)) END AS last_name,
 concat(CAST(1950+c_custkey%13 AS STRING),'-01-15') AS dob FROM customer
"""

# Snapshot rows with repeat columns, the way a full export looks.
FX["fx_source_snapshot"] = """
SELECT record_id, '' AS redcap_repeat_instrument, '' AS redcap_repeat_instance, participant_lab_id,
 CASE WHEN age=999 THEN '' ELSE concat(' ', CAST(age AS STRING)) END AS age,
 concat(' ', upper(first_name)) AS first_name, concat(upper(last_name), ' ') AS last_name, date_of_birth,
 concat(' ', upper(first_name_child)) AS first_name_child, upper(last_name_child) AS last_name_child, date_of_birth_child,
 CAST(last_update_timestamp AS STRING) AS last_update_timestamp, survey_queue_link
FROM fx_source
"""

# The registry with a cleaned-up age, and with keys and names that need cleaning.
FX["fx_registry_raw"] = """
SELECT CASE WHEN cuimc_id%29=7 THEN concat('x', CAST(cuimc_id AS STRING)) ELSE concat(' ', CAST(cuimc_id AS STRING)) END AS cuimc_id,
 concat('  ', upper(first_local), ' ') AS first_local, concat(last_local, ' ') AS last_local, dob,
 CASE WHEN cuimc_id%5=2 THEN 'NaN' ELSE upper(child_first) END AS child_first, last_child, dob_child, participant_lab_id, record_id
FROM fx_registry
"""

FX["fx_registry_aged"] = """
SELECT cuimc_id, dob, first_local, last_local,
 CASE WHEN child_first <> '' THEN '10' WHEN cuimc_id%6=0 THEN '' ELSE '45' END AS age FROM fx_registry
"""

# Pairs kept over the years: some records moved to a neighbouring id and stayed on the old one.
FX["fx_registry_history"] = """
SELECT cuimc_id, record_id FROM fx_registry
UNION ALL SELECT cuimc_id+1, record_id FROM fx_registry WHERE record_id <> '' AND cuimc_id%15=0
"""

# Numeric texts of mixed quality.
FX["fx_numbers"] = """
SELECT event_id, CASE event_id%4 WHEN 0 THEN concat(' ', CAST(event_id AS STRING)) WHEN 1 THEN '' WHEN 2 THEN 'n/a' ELSE CAST(event_id AS STRING) END AS num_text FROM events
"""

# Update times of mixed quality.
FX["fx_stamps"] = """
SELECT event_id, CASE event_id%3 WHEN 0 THEN substr(CAST(ts AS STRING),1,19) WHEN 1 THEN '' ELSE substr(CAST(ts AS STRING),1,10) END AS stamp_text FROM events
"""

# Names in several scripts, and texts without a letter.
FX["fx_names"] = """
SELECT page_id, CASE page_id%6 WHEN 0 THEN '' WHEN 1 THEN '123' WHEN 2 THEN concat('a',CAST(page_id AS STRING)) WHEN 3 THEN 'Éa' WHEN 4 THEN '李' ELSE ' -.' END AS name_text FROM pages
"""

# Repeated uploads of one person in one batch.
FX["fx_intake_twice"] = """
SELECT * FROM fx_intake
UNION ALL SELECT CAST(CAST(cuimc_id AS BIGINT)+5000000 AS STRING), mrn, first_local, last_local, dob, last_child, child_first, dob_child, site
FROM fx_intake WHERE CAST(cuimc_id AS BIGINT)%30=0
"""


# Registry as it is after an import of published rows: repeat rows below the base rows, without identity fields of their own.
FX["fx_registry_rows"] = """
SELECT cuimc_id, '' AS redcap_repeat_instrument, '' AS redcap_repeat_instance, mrn, cuimc_empi, record_id FROM fx_registry
UNION ALL SELECT cuimc_id, 'visit', '1', '', '', '' FROM fx_registry WHERE cuimc_id%3=0
UNION ALL SELECT cuimc_id, 'visit', '2', '', '', '' FROM fx_registry WHERE cuimc_id%6=0
"""

# Lines of an export and of an upload; some are cut off, as after a broken transfer.
FX["fx_export_lines"] = """
SELECT o_orderkey AS line_no, CASE WHEN o_orderkey%29=0 THEN substr(line, 1, length(line)-5) WHEN o_orderkey%41=0 THEN 'Gateway timeout' ELSE line END AS line
FROM (SELECT o_orderkey, concat('{"record_id":"', CAST(o_orderkey AS STRING), '","age":', CASE WHEN o_orderkey%7=0 THEN 'null' ELSE '"40"' END,
  ',"status":"', lower(o_orderstatus), '"}') AS line FROM orders) l
"""

FX["fx_upload_lines"] = """
SELECT c_custkey AS line_no, CASE WHEN c_custkey%23=0 THEN concat('M',CAST(c_custkey AS STRING),',x') WHEN c_custkey%37=0 THEN concat(line, ',more') ELSE line END AS line
FROM (SELECT c_custkey, concat(CAST(c_custkey AS STRING), ',M', CAST(c_custkey AS STRING), ',', lower(c_mktsegment)) AS line FROM customer) l
"""


def needed(sql: str, views: dict[str, str] = FX) -> list[str]:
    """Views and base tables a statement uses, directly or through other views, in order of use."""
    seen: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:from|join)\s+(\w+)", text, re.I)):
            if word in views and word not in seen:
                visit(views[word])
                seen.append(word)
            elif word in BASE and word not in seen:
                seen.append(word)

    visit(sql)
    return seen


def with_views(sql: str, views: dict[str, str]) -> str:
    """Statement for DuckDB, where the base tables are views already; each view is worked out once."""
    ctes = [f"{n} AS MATERIALIZED ({views[n].strip()})" for n in needed(sql, views) if n in views]
    body = sql.strip()
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view on the tables of ``sf_dir``."""
    sql = FX[name].strip()
    ctes = [
        f"{n} AS ({FX[n].strip()})" if n in FX else f"{n} AS (SELECT * FROM parquet.`{sf_dir}/{n}.parquet`)"
        for n in needed(sql)
    ]
    return spark.sql(f"WITH {', '.join(ctes)} {sql}")
