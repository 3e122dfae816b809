"""Field names, codes and formats of the exchanged snapshots.

Everything here is a fixed value: these names and codes appear in the exported
files, so they have to be spelled exactly like this for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: key and bookkeeping fields -------------------------------
KEY = "cuimc_id"
RECORD = "record_id"
LAB = "participant_lab_id"
EMPI = "cuimc_empi"
MRN = "mrn"
INSTRUMENT = "redcap_repeat_instrument"
INSTANCE = "redcap_repeat_instance"
SOURCE_LINK = "survey_queue_link"
REGISTRY_LINK = "r4_survey_queue_link"
PULL_STAMP = "last_r4_pull"
UPDATED = "last_update_timestamp"
UPLOAD_FLAG = "local_batch_upload"
NPI = "provider_npi"
PROVIDER = "provider_name"

# --- fixed values: identity fields of the two sides --------------------------
OWN = ["last_local", "first_local", "dob"]
OWN_CHILD = ["last_child", "child_first", "dob_child"]
FOREIGN = ["last_name", "first_name", "date_of_birth"]
FOREIGN_CHILD = ["last_name_child", "first_name_child", "date_of_birth_child"]
OUTCOMES = ["rec_outcome", "rec_outcome_2", "rec_outcome_3"]

# The eighteen fields of a narrow registry export.
IDENTITY_FIELDS = (
    OWN + OWN_CHILD + [MRN, KEY, EMPI] + FOREIGN + FOREIGN_CHILD + [LAB, "age", RECORD]
)
REGISTRY_MATCH_FIELDS = [KEY, *OWN, *OWN_CHILD, LAB, RECORD]
SOURCE_MATCH_FIELDS = [RECORD, *FOREIGN, *FOREIGN_CHILD, "age", LAB, UPDATED]
INTAKE_FIELDS = [KEY, MRN, *OWN, *OWN_CHILD]
FILE_FIELDS = ["metree_import_json_file", "gira_pdf"]

# --- fixed values: codes -------------------------------------------------------
DECLINED = "9"
SURVEY_DONE = "2"
FACILITIES = ["P", "UI"]
HONORIFICS = ["dr", "doctor", "dra"]
SUFFIXES = ["md", "np"]
CALC_TAG = "@CALC"

# --- fixed values: limits -------------------------------------------------------
ADULT_AGE = 18
UNKNOWN_AGE = 999
KEYS_PER_BATCH = 500
IDS_PER_RANGE = 500
SENDS_PER_ALERT = 3

# --- fixed values: date formats ---------------------------------------------------
ISO_DATE = "yyyy-MM-dd"
DATE_FORMATS = [ISO_DATE, "MM/dd/yyyy", "yyyy/MM/dd", "MM-dd-yyyy"]
UPLOAD_DATE = "MM/dd/yyyy"
RUN_STAMP = "%d/%m/%Y %H:%M:%S"


#: Number of a landed row; stays the same however often the snapshot is read. Not a field of the exchanged files.
ROW = "_row"


def all_strings(names: list[str]) -> T.StructType:
    """Schema of a flat export: every field is a string."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
