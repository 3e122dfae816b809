"""The same results in DuckDB SQL, written rule after rule instead of the Spark way."""

from __future__ import annotations

from catalog.fixtures import FX, with_views

V: dict[str, str] = dict(FX)
O: dict[str, str] = {}

CLEAN = r"lower(regexp_replace({0}, '^\s+|\s+$', '', 'g'))"


def clean(col: str) -> str:
    return CLEAN.format(col)


def key(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {clean(col)} = 'nan' THEN '' ELSE {clean(col)} END"


def day(col: str) -> str:
    formats = ["%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%m-%d-%Y"]
    return "coalesce(" + ", ".join(f"try_strptime({col}, '{f}')::DATE" for f in formats) + ")"


# --- shared views ---------------------------------------------------------------------

V["o_source"] = f"""
SELECT record_id, {key('first_name')} AS first_name, {key('last_name')} AS last_name, {key('date_of_birth')} AS date_of_birth,
 {key('first_name_child')} AS first_name_child, {key('last_name_child')} AS last_name_child, {key('date_of_birth_child')} AS date_of_birth_child,
 {key('participant_lab_id')} AS participant_lab_id, CASE WHEN trim(age) = '' THEN 999 ELSE CAST(trim(age) AS INT) END AS age,
 CAST(epoch(CAST(last_update_timestamp AS TIMESTAMP)) AS BIGINT) AS updated
FROM fx_source_snapshot
"""
V["o_known"] = "SELECT DISTINCT record_id, cuimc_id FROM fx_registry WHERE record_id <> ''"
V["o_left1"] = "SELECT s.* FROM o_source s WHERE NOT EXISTS (SELECT 1 FROM o_known k WHERE k.record_id = s.record_id)"
V["o_lab"] = """
SELECT DISTINCT s.record_id, r.cuimc_id FROM o_left1 s
 JOIN fx_registry r ON r.participant_lab_id = s.participant_lab_id AND r.participant_lab_id <> ''
"""
V["o_left2"] = "SELECT s.* FROM o_left1 s WHERE NOT EXISTS (SELECT 1 FROM o_lab k WHERE k.record_id = s.record_id)"
V["o_adult"] = """
SELECT DISTINCT s.record_id, r.cuimc_id FROM o_left2 s
 JOIN fx_registry r ON r.first_local = s.first_name AND r.last_local = s.last_name AND r.dob = s.date_of_birth
WHERE s.age >= 18 AND r.first_local <> '' AND r.last_local <> '' AND r.dob <> '' AND upper(r.child_first) = lower(r.child_first)
"""
V["o_left3"] = "SELECT s.* FROM o_left2 s WHERE NOT EXISTS (SELECT 1 FROM o_adult k WHERE k.record_id = s.record_id)"
V["o_child"] = """
SELECT DISTINCT s.record_id, r.cuimc_id FROM o_left3 s
 JOIN fx_registry r ON r.child_first = s.first_name_child AND r.last_child = s.last_name_child AND r.dob_child = s.date_of_birth_child
WHERE s.age < 18 AND r.child_first <> '' AND r.last_child <> '' AND r.dob_child <> '' AND upper(r.child_first) <> lower(r.child_first)
"""
V["o_new"] = """
SELECT s.record_id, m.top + row_number() OVER (ORDER BY s.record_id) AS cuimc_id
FROM o_left3 s CROSS JOIN (SELECT max(cuimc_id) AS top FROM fx_registry) m
WHERE NOT EXISTS (SELECT 1 FROM o_child k WHERE k.record_id = s.record_id)
"""
V["o_pairs"] = """
SELECT p.record_id, p.cuimc_id, p.step, s.updated FROM (
 SELECT record_id, cuimc_id, 1 AS step FROM o_known UNION ALL SELECT record_id, cuimc_id, 2 FROM o_lab
 UNION ALL SELECT record_id, cuimc_id, 3 FROM o_adult UNION ALL SELECT record_id, cuimc_id, 4 FROM o_child
 UNION ALL SELECT record_id, cuimc_id, 5 FROM o_new) p
JOIN o_source s ON s.record_id = p.record_id
"""
V["o_mapping"] = """
SELECT record_id, cuimc_id, step FROM (SELECT *, row_number() OVER (PARTITION BY cuimc_id
  ORDER BY updated DESC NULLS LAST, step, record_id) AS rn FROM o_pairs) q WHERE rn = 1
"""

# --- sources ----------------------------------------------------------------------------

O["full_scan"] = "SELECT * FROM fx_source_snapshot"
O["projected_scan"] = "SELECT cuimc_id, mrn, cuimc_empi FROM fx_registry"
O["filtered_scan"] = "SELECT record_id, previous_survey_complete FROM fx_survey WHERE run_date >= DATE '1996-01-01'"
O["parse_export"] = """
SELECT line_no, CASE WHEN ok THEN json_extract_string(line, '$.record_id') END AS record_id, CASE WHEN ok THEN coalesce(json_extract_string(line, '$.age'), '') END AS age,
 CASE WHEN ok THEN json_extract_string(line, '$.status') END AS status, CASE WHEN NOT ok THEN line END AS _corrupt_record
FROM (SELECT *, json_valid(line) AS ok FROM fx_export_lines) l
"""
O["parse_upload"] = """
SELECT line_no, CASE WHEN len(c) = 3 THEN c[1] END AS cuimc_id, CASE WHEN len(c) = 3 THEN c[2] END AS mrn,
 CASE WHEN len(c) = 3 THEN c[3] END AS first_local, CASE WHEN len(c) <> 3 THEN line END AS _corrupt_record
FROM (SELECT *, string_split(line, ',') AS c FROM fx_upload_lines) l
"""
O["point_lookup"] = """
SELECT record_id, redcap_repeat_instrument, redcap_repeat_instance, finding FROM fx_source_raw WHERE record_id = '18'
"""
O["point_lookup_landed"] = O["point_lookup"]
V["o_ranges"] = """
SELECT CAST((rn-1)//50 AS BIGINT) AS range_no, lo, lead(lo) OVER (ORDER BY lo) AS hi FROM (
 SELECT lo, row_number() OVER (ORDER BY lo) AS rn FROM (SELECT DISTINCT CAST(record_id AS BIGINT) AS lo FROM fx_registry WHERE record_id <> '') a) b
WHERE (rn-1) % 50 = 0
"""
O["range_boundaries"] = "SELECT range_no, lo, hi FROM o_ranges"
O["range_records"] = """
SELECT s.record_id, CASE WHEN s.id IS NULL THEN -2 ELSE coalesce(r.range_no, -1) END AS range_no
FROM (SELECT record_id, TRY_CAST(record_id AS BIGINT) AS id FROM fx_source) s
LEFT JOIN o_ranges r ON s.id >= r.lo AND (r.hi IS NULL OR s.id < r.hi)
"""
O["ignore_list"] = "SELECT DISTINCT field_name FROM fx_ignore WHERE flag = '1'"

# --- normalisation ---------------------------------------------------------------------------

O["normalize_registry"] = f"""
SELECT CAST(trim(cuimc_id) AS BIGINT) AS cuimc_id, {key('first_local')} AS first_local, {key('last_local')} AS last_local,
 {key('dob')} AS dob, {key('child_first')} AS child_first, {key('last_child')} AS last_child, {key('dob_child')} AS dob_child,
 {key('participant_lab_id')} AS participant_lab_id, {key('record_id')} AS record_id
FROM fx_registry_raw WHERE try_cast(trim(cuimc_id) AS BIGINT) IS NOT NULL
"""
O["registry_quarantine"] = """
SELECT cuimc_id, 'bad_key' AS reason FROM fx_registry_raw WHERE try_cast(trim(cuimc_id) AS BIGINT) IS NULL
"""
O["normalize_source"] = "SELECT * FROM o_source"
def _first(col: str) -> str:
    """First non-null value of a record in the order base row, repeats, values."""
    return f"first({col} ORDER BY redcap_repeat_instrument, redcap_repeat_instance, {col}) FILTER ({col} IS NOT NULL) AS {col}"


O["collapse_source"] = f"""
SELECT record_id, {", ".join(_first(c) for c in ("age", "first_name", "survey_queue_link", "note", "finding"))} FROM fx_source_raw GROUP BY record_id
"""
READ_AGE = "CASE WHEN trim(age) = '' THEN 999 WHEN regexp_matches(trim(age), '^[+-]?[0-9]+$') THEN CAST(trim(age) AS INT) END"
O["clean_age"] = f"""
SELECT record_id, redcap_repeat_instrument, redcap_repeat_instance, CAST({READ_AGE} AS BIGINT) AS age FROM fx_source_raw
"""
O["parse_numbers"] = """
SELECT event_id, try_cast(trim(num_text) AS BIGINT) AS num, coalesce(try_cast(trim(num_text) AS BIGINT), 0) AS num_or_zero FROM fx_numbers
"""
O["parse_stamps"] = """
SELECT event_id, CAST(epoch(try_strptime(stamp_text, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS seconds FROM fx_stamps
"""
O["parse_dates"] = f"SELECT event_id, CAST({day('dob_text')} AS STRING) AS dob FROM fx_dates"
O["format_dates"] = f"SELECT event_id, coalesce(strftime({day('dob_text')}, '%m/%d/%Y'), '') AS dob_us FROM fx_dates"
O["has_name"] = "SELECT page_id, upper(name_text) <> lower(name_text) AS named FROM fx_names"
O["clean_text"] = f"""
SELECT record_id, redcap_repeat_instance, {clean('age')} AS age, {clean('first_name')} AS first_name, {clean('note')} AS note FROM fx_source_raw
"""
O["column_policy"] = """
SELECT record_id, redcap_repeat_instrument, redcap_repeat_instance, age, first_name, finding FROM fx_source_raw
"""
O["constant_columns"] = """
SELECT cuimc_id, '01/02/2024 00:00:00' AS last_r4_pull, '1' AS local_batch_upload FROM fx_registry
"""
O["complete_rows"] = """
SELECT cuimc_id FROM fx_registry WHERE record_id <> '' AND first_local <> '' AND last_local <> '' AND dob <> ''
"""
O["adult_child_split"] = "SELECT record_id, CASE WHEN age >= 18 THEN 'adult' ELSE 'child' END AS part FROM o_source"
O["base_repeat_split"] = """
SELECT record_id, redcap_repeat_instance, redcap_repeat_instrument = '' AS is_base FROM fx_source_raw
"""
O["declined_rows"] = "SELECT cuimc_id FROM fx_registry WHERE rec_outcome = '9' OR rec_outcome_2 = '9' OR rec_outcome_3 = '9'"

# --- matching ------------------------------------------------------------------------------------

O["match_steps"] = """
SELECT s.record_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM o_known k WHERE k.record_id = s.record_id) THEN 1
 WHEN EXISTS (SELECT 1 FROM o_lab k WHERE k.record_id = s.record_id) THEN 2
 WHEN EXISTS (SELECT 1 FROM o_adult k WHERE k.record_id = s.record_id) THEN 3
 WHEN EXISTS (SELECT 1 FROM o_child k WHERE k.record_id = s.record_id) THEN 4 ELSE 5 END AS BIGINT) AS step
FROM o_source s
"""
O["match_known"] = "SELECT k.cuimc_id, k.record_id FROM o_known k JOIN o_source s ON s.record_id = k.record_id"


def _winner(pairs: str) -> str:
    return f"""
SELECT cuimc_id, record_id, n_records FROM (
 SELECT p.cuimc_id, p.record_id, row_number() OVER (PARTITION BY p.cuimc_id ORDER BY s.updated DESC NULLS LAST, p.record_id) AS rn,
  count(*) OVER (PARTITION BY p.cuimc_id) AS n_records
 FROM {pairs} p JOIN o_source s ON s.record_id = p.record_id) q WHERE rn = 1
"""


O["match_lab"] = _winner("o_lab")
O["match_adult"] = _winner("o_adult")
O["match_child"] = _winner("o_child")
O["new_ids"] = "SELECT record_id, cuimc_id FROM o_new"
O["match_mapping"] = "SELECT record_id, cuimc_id, CAST(step AS BIGINT) AS step FROM o_mapping"
O["match_conflicts"] = """
SELECT record_id, cuimc_id, n_ids FROM (SELECT record_id, cuimc_id, count(*) OVER (PARTITION BY record_id) AS n_ids
 FROM (SELECT DISTINCT record_id, cuimc_id FROM fx_registry_history WHERE record_id <> '') h) q WHERE n_ids > 1
"""

# --- publishing --------------------------------------------------------------------------------------

V["o_linked"] = """
SELECT m.record_id, m.cuimc_id, l.link FROM o_mapping m
LEFT JOIN (SELECT record_id, first(survey_queue_link ORDER BY redcap_repeat_instance, survey_queue_link) AS link FROM fx_source_raw
 WHERE redcap_repeat_instrument = '' GROUP BY record_id) l
 ON l.record_id = m.record_id
"""
O["link_enrichment"] = "SELECT record_id, cuimc_id, link AS r4_survey_queue_link FROM o_linked"
V["o_batches"] = """
SELECT cuimc_id, CAST((row_number() OVER (ORDER BY cuimc_id) - 1) // 500 + 1 AS BIGINT) AS batch_id
FROM (SELECT DISTINCT cuimc_id FROM o_mapping) k
"""
V["o_published"] = """
SELECT l.cuimc_id, CASE WHEN r.redcap_repeat_instrument = '' THEN r.record_id ELSE '' END AS record_id,
 r.redcap_repeat_instrument, r.redcap_repeat_instance, CASE WHEN lower(trim(r.age)) = 'nan' THEN '' ELSE r.age END AS age,
 coalesce(r.first_name, '') AS first_name, r.finding,
 CASE WHEN r.redcap_repeat_instrument = '' THEN coalesce(l.link, '') ELSE '' END AS r4_survey_queue_link,
 CASE WHEN r.redcap_repeat_instrument = '' THEN '01/02/2024 00:00:00' ELSE '' END AS last_r4_pull, b.batch_id
FROM fx_source_raw r JOIN o_linked l ON l.record_id = r.record_id JOIN o_batches b ON b.cuimc_id = l.cuimc_id
"""
O["publish_rows"] = "SELECT * FROM o_published"
O["publish_quarantine"] = """
SELECT record_id, redcap_repeat_instrument, redcap_repeat_instance, 'superseded' AS reason FROM fx_source_raw r
WHERE NOT EXISTS (SELECT 1 FROM o_mapping m WHERE m.record_id = r.record_id)
"""
V["o_unread"] = f"""
SELECT record_id FROM (SELECT record_id, {_first("age")} FROM fx_source_raw GROUP BY record_id) a WHERE {READ_AGE} IS NULL AND trim(record_id) <> ''
"""
O["quarantine_all"] = """
SELECT record_id, redcap_repeat_instrument, redcap_repeat_instance,
 CASE WHEN trim(record_id) = '' THEN 'blank_id' WHEN EXISTS (SELECT 1 FROM o_unread u WHERE u.record_id = r.record_id) THEN 'bad_age' ELSE 'superseded' END AS reason
FROM fx_source_raw r WHERE NOT EXISTS (SELECT 1 FROM o_mapping m WHERE m.record_id = r.record_id)
"""
V["o_lines"] = """
SELECT batch_id, cuimc_id, redcap_repeat_instrument AS instrument, CAST(redcap_repeat_instance AS BIGINT) AS instance,
 CAST(to_json({'record_id': record_id, 'redcap_repeat_instrument': redcap_repeat_instrument, 'redcap_repeat_instance': redcap_repeat_instance,
  'age': age, 'first_name': first_name, 'finding': finding, 'cuimc_id': cuimc_id,
  'r4_survey_queue_link': r4_survey_queue_link, 'last_r4_pull': last_r4_pull}) AS STRING) AS line
FROM o_published
"""
O["publish_batches"] = """
SELECT batch_id, count(*) AS n_rows, count(DISTINCT cuimc_id) AS n_keys, CAST(sum(strlen(line)) AS BIGINT) AS n_bytes,
 min(cuimc_id) AS first_key, max(cuimc_id) AS last_key FROM o_lines GROUP BY batch_id
"""
O["batch_lines"] = "SELECT * FROM o_lines"
O["batch_payload"] = """
SELECT batch_id, cuimc_id, instrument, instance,
 CASE WHEN rn = 1 THEN '[' ELSE ',' END || line || CASE WHEN rn = n THEN ']' ELSE '' END AS framed
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY cuimc_id, instrument, instance, line) AS rn,
 count(*) OVER (PARTITION BY batch_id) AS n FROM o_lines) f
"""

# --- upserts and deletes ---------------------------------------------------------------------------------

# a repeated key counts with its last row in the order of its values
V["o_payload"] = "SELECT cuimc_id, max(mrn) AS mrn, max(local_batch_upload) AS local_batch_upload FROM fx_payload GROUP BY cuimc_id"
O["upsert_overwrite"] = """
SELECT coalesce(p.cuimc_id, t.cuimc_id) AS cuimc_id, CASE WHEN p.local_batch_upload IS NULL THEN t.mrn ELSE p.mrn END AS mrn,
 coalesce(t.last_local, '') AS last_local, coalesce(p.local_batch_upload, '') AS local_batch_upload
FROM fx_registry t FULL JOIN o_payload p ON p.cuimc_id = t.cuimc_id
"""
O["upsert_normal"] = """
SELECT coalesce(p.cuimc_id, t.cuimc_id) AS cuimc_id, coalesce(nullif(p.mrn, ''), t.mrn, '') AS mrn,
 coalesce(t.last_local, '') AS last_local, coalesce(p.local_batch_upload, '') AS local_batch_upload
FROM fx_registry t FULL JOIN o_payload p ON p.cuimc_id = t.cuimc_id
"""
O["upsert_patch"] = O["upsert_normal"]
O["upsert_pruned"] = O["upsert_overwrite"]
O["delete_by_ids"] = """
SELECT cuimc_id, mrn FROM fx_registry t WHERE NOT EXISTS (SELECT 1 FROM fx_delete_ids x WHERE x.cuimc_id = t.cuimc_id)
"""
O["delete_pruned"] = O["delete_by_ids"]
O["delete_receipt"] = """
SELECT x.cuimc_id, count(t.cuimc_id) AS n_rows FROM (SELECT DISTINCT cuimc_id FROM fx_delete_ids) x
LEFT JOIN fx_registry t ON t.cuimc_id = x.cuimc_id GROUP BY x.cuimc_id
"""

# --- duplicates --------------------------------------------------------------------------------------------

V["o_dups"] = """
SELECT r.* FROM fx_registry r JOIN (
 SELECT dob, first_local, last_local FROM fx_registry WHERE child_first = '' AND first_local <> ''
 GROUP BY dob, first_local, last_local HAVING count(DISTINCT cuimc_id) > 1) g
ON g.dob = r.dob AND g.first_local = r.first_local AND g.last_local = r.last_local WHERE r.first_local <> ''
"""
O["dup_groups"] = "SELECT cuimc_id, first_local, last_local, dob, child_first, record_id FROM o_dups"
# Rule after rule on ids, the way a person would do it by hand.
V["o_dup_linked"] = """
SELECT DISTINCT d.cuimc_id FROM o_dups d JOIN (SELECT DISTINCT dob, first_local, last_local FROM o_dups WHERE record_id <> '') g
ON g.dob = d.dob AND g.first_local = d.first_local AND g.last_local = d.last_local
"""
V["o_dup_free"] = "SELECT d.* FROM o_dups d WHERE NOT EXISTS (SELECT 1 FROM o_dup_linked x WHERE x.cuimc_id = d.cuimc_id)"
V["o_dup_refused"] = """
SELECT f.* FROM o_dup_free f WHERE EXISTS (SELECT 1 FROM o_dup_free x WHERE x.cuimc_id = f.cuimc_id
 AND '9' IN (x.rec_outcome, x.rec_outcome_2, x.rec_outcome_3))
"""
V["o_dup_settled"] = """
SELECT DISTINCT f.cuimc_id FROM o_dup_free f JOIN (SELECT DISTINCT dob, first_local, last_local FROM o_dup_refused) g
ON g.dob = f.dob AND g.first_local = f.first_local AND g.last_local = f.last_local
"""
V["o_dup_keep"] = """
SELECT cuimc_id, min(verdict) AS verdict FROM (
 SELECT cuimc_id, 'keep_linked' AS verdict FROM o_dup_linked
 UNION ALL SELECT max(cuimc_id), 'keep_declined' FROM o_dup_refused GROUP BY dob, first_local, last_local
 UNION ALL SELECT max(f.cuimc_id), 'keep_largest' FROM o_dup_free f
  WHERE NOT EXISTS (SELECT 1 FROM o_dup_settled x WHERE x.cuimc_id = f.cuimc_id) GROUP BY f.dob, f.first_local, f.last_local) k
GROUP BY cuimc_id
"""
V["o_verdicts"] = """
SELECT d.cuimc_id, coalesce(k.verdict, 'delete') AS verdict,
 EXISTS (SELECT 1 FROM o_dup_refused x WHERE x.cuimc_id = d.cuimc_id) AS declined,
 EXISTS (SELECT 1 FROM o_dups x WHERE x.record_id <> '' AND x.dob = d.dob AND x.first_local = d.first_local AND x.last_local = d.last_local) AS group_linked
FROM o_dups d LEFT JOIN o_dup_keep k ON k.cuimc_id = d.cuimc_id
"""
O["dup_verdicts"] = "SELECT * FROM o_verdicts"
O["dup_delete_applied"] = """
SELECT r.cuimc_id FROM fx_registry r WHERE NOT EXISTS (SELECT 1 FROM o_verdicts v WHERE v.cuimc_id = r.cuimc_id AND v.verdict = 'delete')
"""
V["o_members"] = """
SELECT dob, first_local, last_local, 'registry' AS side, CAST(cuimc_id AS STRING) AS member,
 CASE WHEN age = '' THEN true ELSE CAST(age AS INT) >= 18 END AS adult FROM fx_registry_aged WHERE first_local <> '' AND last_local <> '' AND dob <> ''
UNION ALL SELECT date_of_birth, first_name, last_name, 'source', record_id, false FROM o_source WHERE first_name <> '' AND last_name <> '' AND date_of_birth <> ''
"""
O["dup_cross_source"] = """
SELECT side, member, adult, n_registry, n_source, n_adult FROM (SELECT *,
  count(*) FILTER (WHERE side = 'registry') OVER g AS n_registry, count(*) FILTER (WHERE side = 'source') OVER g AS n_source,
  count(*) FILTER (WHERE adult) OVER g AS n_adult FROM o_members WINDOW g AS (PARTITION BY dob, first_local, last_local)) q
WHERE n_registry > 0 AND n_source > 0
"""

# --- intake -----------------------------------------------------------------------------------------------------

V["o_people"] = f"""
SELECT DISTINCT * FROM (
 SELECT {key('last_local')} AS last_local, {key('first_local')} AS first_local, {key('dob')} AS dob,
  {key('last_child')} AS last_child, {key('child_first')} AS child_first, {key('dob_child')} AS dob_child FROM fx_registry
 UNION ALL SELECT {key('last_name')}, {key('first_name')}, {key('date_of_birth')},
  {key('last_name_child')}, {key('first_name_child')}, {key('date_of_birth_child')} FROM fx_registry) n
"""
O["existing_names"] = "SELECT * FROM o_people"
V["o_judged"] = f"""
SELECT u.*, CASE WHEN u.mrn = '' THEN 'blank_mrn' WHEN u.last_local = '' OR u.first_local = '' THEN 'blank_name' WHEN u.dob = '' THEN 'blank_dob'
 WHEN EXISTS (SELECT 1 FROM fx_registry r WHERE r.mrn = u.mrn) THEN 'known_mrn'
 WHEN EXISTS (SELECT 1 FROM o_people p WHERE p.last_local = {clean('u.last_local')} AND p.first_local = {clean('u.first_local')} AND p.dob = u.dob
  AND p.last_child = {clean('u.last_child')} AND p.child_first = {clean('u.child_first')} AND p.dob_child = u.dob_child) THEN 'known_person' END AS reason
FROM fx_intake u
"""
O["intake_rejects"] = "SELECT cuimc_id, mrn, reason FROM o_judged WHERE reason IS NOT NULL"
O["intake_accepted"] = f"""
SELECT upload_id, m.top + row_number() OVER (ORDER BY last_local, first_local, dob, last_child, child_first, dob_child, upload_id) AS cuimc_id,
 mrn, last_local, first_local, strftime(CAST(dob AS DATE), '%m/%d/%Y') AS dob, last_child, child_first, dob_child, '1' AS local_batch_upload, site
FROM (SELECT cuimc_id AS upload_id, {clean('mrn')} AS mrn, {clean('last_local')} AS last_local, {clean('first_local')} AS first_local, dob,
  last_child, child_first, dob_child, site FROM o_judged WHERE reason IS NULL) a
CROSS JOIN (SELECT max(cuimc_id) AS top FROM fx_registry) m
"""
O["intake_repeats"] = f"""
SELECT cuimc_id, n_rows FROM (SELECT cuimc_id, count(*) OVER (PARTITION BY {clean('last_local')}, {clean('first_local')}, dob,
  {clean('last_child')}, {clean('child_first')}, dob_child) AS n_rows FROM fx_intake_twice) q WHERE n_rows > 1
"""

# --- crosswalks -------------------------------------------------------------------------------------------------------

V["o_walked"] = """
SELECT r.cuimc_id, r.mrn, CASE WHEN r.cuimc_empi <> '' THEN 'skip_has_empi' WHEN r.mrn = '' THEN 'skip_no_mrn'
  WHEN coalesce(h.n, 0) = 0 THEN 'not_found' WHEN h.n > 1 THEN 'not_unique' ELSE 'filled' END AS status, h.empi
FROM fx_registry r LEFT JOIN (
 SELECT q.mrn, count(DISTINCT m.empi) AS n, min(m.empi) AS empi FROM (SELECT DISTINCT mrn FROM fx_registry WHERE mrn <> '') q
 JOIN fx_patient_map m ON m.empi = q.mrn OR (m.local_pt_id = q.mrn AND m.facility_code IN ('P', 'UI')) GROUP BY q.mrn) h ON h.mrn = r.mrn
"""
O["crosswalk_filled"] = "SELECT cuimc_id, empi AS cuimc_empi FROM o_walked WHERE status = 'filled'"
O["crosswalk_issues"] = "SELECT cuimc_id, mrn, status FROM o_walked WHERE status <> 'filled'"
O["crosswalk_repeats"] = """
SELECT r.cuimc_id, r.redcap_repeat_instrument, r.redcap_repeat_instance, r.mrn,
 CASE WHEN r.redcap_repeat_instrument = '' AND w.status = 'filled' THEN w.empi ELSE r.cuimc_empi END AS cuimc_empi, r.record_id
FROM fx_registry_rows r JOIN o_walked w ON w.cuimc_id = r.cuimc_id
"""
O["crosswalk_upsert"] = """
SELECT r.cuimc_id, r.mrn, CASE WHEN w.status = 'filled' THEN w.empi ELSE r.cuimc_empi END AS cuimc_empi
FROM fx_registry r JOIN o_walked w ON w.cuimc_id = r.cuimc_id
"""
V["o_tokens"] = r"""
SELECT cuimc_id, provider_name, t, len(t) AS n, lower(coalesce(t[1], '')) IN ('dr', 'doctor', 'dra') AS titled, lower(coalesce(t[len(t)], '')) IN ('md', 'np') AS degreed
FROM (SELECT cuimc_id, provider_name, list_filter(regexp_split_to_array(provider_name, '[,\s.]+'), lambda x: x <> '') AS t FROM fx_provider) p
"""
V["o_parsed"] = """
SELECT cuimc_id, provider_name,
 CASE WHEN titled THEN CASE n WHEN 4 THEN t[2] WHEN 3 THEN t[2] ELSE '' END
  WHEN degreed THEN CASE n WHEN 4 THEN t[1] WHEN 3 THEN t[1] ELSE '' END
  WHEN n IN (2, 3) THEN t[1] ELSE '' END AS first,
 CASE WHEN titled THEN CASE n WHEN 4 THEN t[4] WHEN 3 THEN t[3] WHEN 2 THEN t[2] ELSE '' END
  WHEN degreed THEN CASE n WHEN 4 THEN t[3] WHEN 3 THEN t[2] WHEN 2 THEN t[1] ELSE '' END
  WHEN n = 2 THEN t[2] WHEN n = 3 THEN t[3] ELSE '' END AS last
FROM o_tokens
"""
O["provider_parse"] = "SELECT cuimc_id, first, last FROM o_parsed"
V["o_npi"] = """
SELECT p.cuimc_id, p.provider_name, CASE WHEN p.last = '' THEN 'no_name' WHEN count(n.npi) = 0 THEN 'none' WHEN count(DISTINCT n.npi) > 1 THEN 'several' ELSE 'one' END AS status,
 CASE WHEN p.last <> '' AND count(DISTINCT n.npi) = 1 THEN CAST(min(n.npi) AS STRING) ELSE '' END AS provider_npi
FROM o_parsed p LEFT JOIN fx_npi n ON p.last <> '' AND n.last_name = lower(p.last) AND (p.first = '' OR n.first_name = lower(p.first))
GROUP BY p.cuimc_id, p.provider_name, p.first, p.last
"""
O["provider_npi"] = "SELECT cuimc_id, provider_npi, status FROM o_npi"
O["provider_update"] = "SELECT cuimc_id, provider_name, provider_npi FROM o_npi"

# --- dictionaries -----------------------------------------------------------------------------------------------------------


def _merge(kept: str) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY fpos, side, seq) AS position, field_name, form_name, annotation, origin
FROM (SELECT *, min(side * 1000000000000 + seq) OVER (PARTITION BY form_name) AS fpos FROM (
 SELECT field_name, form_name, seq, annotation, 0 AS side, 'registry' AS origin FROM fx_dict_registry WHERE {kept}
 UNION ALL SELECT s.field_name, s.form_name, s.seq, s.annotation, 1, 'source' FROM fx_dict_source s
 WHERE NOT EXISTS (SELECT 1 FROM fx_dict_registry r WHERE r.field_name = s.field_name AND {kept.replace('form_name', 'r.form_name')})) a) b
"""


O["dict_merge"] = _merge("true")
O["dict_merge_override"] = _merge("form_name NOT IN ('standard', 'economy')")
O["dict_union"] = """
SELECT 'registry' AS origin, field_name, form_name, seq FROM fx_dict_registry
UNION ALL SELECT 'source', field_name, form_name, seq FROM fx_dict_source WHERE field_name <> 'record_id'
"""
O["dict_drift"] = """
SELECT DISTINCT field_name, 'unknown_to_registry' AS issue FROM fx_dict_source s
WHERE NOT EXISTS (SELECT 1 FROM fx_dict_registry r WHERE r.field_name = s.field_name)
 AND NOT EXISTS (SELECT 1 FROM fx_ignore i WHERE i.flag = '1' AND i.field_name = s.field_name)
UNION ALL SELECT DISTINCT field_name, 'ignored_but_gone' FROM fx_ignore i
WHERE flag = '1' AND NOT EXISTS (SELECT 1 FROM fx_dict_source s WHERE s.field_name = i.field_name)
"""
O["dict_calc"] = """
SELECT field_name, form_name FROM fx_dict_registry WHERE annotation LIKE '%@CALC%'
UNION SELECT field_name, form_name FROM fx_dict_source WHERE annotation LIKE '%@CALC%'
"""

# --- audits ----------------------------------------------------------------------------------------------------------------------

O["audit_name_mismatch"] = """
SELECT * FROM (SELECT m.record_id, m.cuimc_id, s.first_name,
  CASE WHEN r.cuimc_id % 4 = 0 THEN concat('x', r.first_local) ELSE r.first_local END AS first_local
 FROM o_mapping m JOIN o_source s ON s.record_id = m.record_id
 JOIN fx_registry r ON r.cuimc_id = m.cuimc_id AND r.participant_lab_id = s.participant_lab_id) q WHERE first_local <> first_name
"""
O["audit_id_mismatch"] = """
SELECT m.cuimc_id, m.record_id, r.record_id AS stored_record_id, CASE WHEN r.record_id = '' THEN 'first_link' ELSE 'changed' END AS kind
FROM o_mapping m JOIN fx_registry r ON r.cuimc_id = m.cuimc_id WHERE r.record_id <> m.record_id
"""
O["audit_id_repeats"] = O["audit_id_mismatch"]
O["verified_lookup"] = """
SELECT q.request_id, CASE WHEN same THEN r.cuimc_id END AS cuimc_id, CASE WHEN same THEN r.record_id END AS record_id,
 CASE WHEN n <> 1 THEN 'not_one' WHEN same THEN 'verified' ELSE 'mismatch' END AS status
FROM (SELECT l.*, (SELECT count(*) FROM fx_registry x WHERE x.mrn = l.mrn) AS n FROM fx_lookup l) q
LEFT JOIN (SELECT * FROM fx_registry WHERE mrn <> '') r ON r.mrn = q.mrn AND q.n = 1
CROSS JOIN LATERAL (SELECT coalesce(r.first_local = q.first_name AND r.last_local = q.last_name AND r.dob = q.dob, false) AS same) v
"""
O["exactly_one"] = """
SELECT local_pt_id, min(empi) AS empi FROM fx_patient_map GROUP BY local_pt_id HAVING count(DISTINCT empi) = 1
"""

# --- alerts and files ----------------------------------------------------------------------------------------------------------------

V["o_due"] = "SELECT * FROM fx_survey WHERE previous_survey_complete = '2' AND reminder_survey_complete <> '2'"
O["alert_eligible"] = "SELECT record_id, survey_queue_link FROM o_due"
O["alert_schedule"] = """
SELECT d.record_id, n.k + 1 AS send_no, CAST(d.run_date + CAST(n.k * 7 AS INT) AS STRING) AS send_date, d.survey_queue_link
FROM o_due d CROSS JOIN (SELECT unnest([0, 1, 2])::BIGINT AS k) n
WHERE NOT EXISTS (SELECT 1 FROM fx_survey_sent s WHERE s.record_id = d.record_id)
"""
V["o_plan"] = O["alert_schedule"]
O["alert_ledger"] = """
SELECT record_id, send_no, send_date, CAST(CASE WHEN send_date <= '1996-06-30' THEN 1 ELSE 2 END AS BIGINT) AS run FROM o_plan WHERE send_date <= '1997-06-30'
"""
V["o_reset"] = """
SELECT 'sent' AS ledger, CAST(s.alert_sent_id AS BIGINT) AS row_id, a.project_id FROM fx_alerts_sent s LEFT JOIN fx_alerts a ON a.alert_id = s.alert_id
UNION ALL SELECT 'recurrence', CAST(r.recurrence_id AS BIGINT), a.project_id FROM fx_alerts_recurrence r LEFT JOIN fx_alerts a ON a.alert_id = r.alert_id
UNION ALL SELECT 'sent_log', CAST(l.log_id AS BIGINT), a.project_id FROM fx_alerts_sent_log l
 LEFT JOIN fx_alerts_sent s ON s.alert_sent_id = l.alert_sent_id LEFT JOIN fx_alerts a ON a.alert_id = s.alert_id
"""
O["alert_reset"] = "SELECT ledger, row_id FROM o_reset WHERE project_id = 3"
O["alert_kept"] = "SELECT ledger, row_id FROM o_reset WHERE project_id IS DISTINCT FROM 3"
O["file_manifest"] = """
SELECT record_id, field, file_name FROM (SELECT record_id, 'json_file' AS field, json_file AS file_name FROM fx_files
 UNION ALL SELECT record_id, 'pdf_file', pdf_file FROM fx_files) f
WHERE file_name <> '' AND NOT EXISTS (SELECT 1 FROM fx_file_repo p WHERE p.file_name = f.file_name)
"""
O["stage_counts"] = """
SELECT 'registry' AS stage, count(*) AS n_rows FROM fx_registry UNION ALL SELECT 'source', count(*) FROM o_source
UNION ALL SELECT 'mapping', count(*) FROM o_mapping UNION ALL SELECT 'duplicates', count(*) FROM o_dups
"""


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, V) for name, sql in O.items()}
