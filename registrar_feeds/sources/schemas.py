"""Fixed schemas of the registrar tables.

The source system declares none, so these are read off the columns the feeds
use.  Text codes are blank-padded CHAR(n) at the source; ``KEY_COLUMNS`` lists
the ones that are joined or compared and therefore right-trimmed at staging
(trailing blanks carry no meaning in a CHAR compare).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
TS = T.TimestampNTZType()          # registrar datetimes are naive local time
HRS = T.DecimalType(4, 2)
CLOCK = T.DecimalType(8, 2)        # 900.0 = 9:00


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "jenzcrs_rec": _schema(("course_code", S), ("sec", S), ("term_code", S), ("coursekey", S), ("hrs", S)),
    "crs_rec": _schema(("crs_no", S), ("cat", S), ("dept", S), ("prog", S),
                       ("title1", S), ("title2", S), ("title3", S)),
    "jenzccd_rec": _schema(("course_code", S), ("title", S), ("dept_code", S)),
    "jenztrm_rec": _schema(("term_code", S), ("start_date", D), ("end_date", D)),
    "jenzdpt_rec": _schema(("dept_code", S), ("descr", S)),
    "jenzsch_rec": _schema(("term_code", S), ("sec", S), ("course_code", S)),
    "secmtg_rec": _schema(("crs_no", S), ("sec_no", S), ("cat", S), ("yr", S), ("sess", S), ("mtg_no", L)),
    "sec_rec": _schema(("crs_no", S), ("sec_no", S), ("cat", S), ("yr", S), ("sess", S), ("subsess", S),
                       ("fac_id", L), ("hrs", HRS), ("stat", S), ("stat_date", D),
                       ("beg_date", D), ("end_date", D)),
    "id_rec": _schema(("id", L), ("lastname", S), ("firstname", S), ("middlename", S), ("fullname", S)),
    "sess_table": _schema(("sess", S), ("txt", S)),
    "mtg_rec": _schema(("mtg_no", L), ("yr", S), ("sess", S), ("bldg", S), ("room", S), ("days", S),
                       ("beg_tm", CLOCK), ("end_tm", CLOCK), ("beg_date", D), ("end_date", D)),
    "bldg_table": _schema(("bldg", S), ("txt", S)),
    "dept_table": _schema(("dept", S), ("txt", S)),
    "jenzcst_rec": _schema(("host_id", L), ("status_code", S)),
    "jenzprs_rec": _schema(("host_id", L), ("host_username", S), ("e_mail", S)),
    "job_rec": _schema(("id", L), ("title_rank", I), ("end_date", D), ("job_title", S), ("hrpay", S)),
    "prog_enr_rec": _schema(("id", L), ("acst", S), ("tle", S)),
    "addree_rec": _schema(("prim_id", L), ("style", S), ("alt_name", S)),
    "role_rec": _schema(("id", L), ("role", S), ("end_date", D)),
    "jenzcrp_rec": _schema(("course_code", S), ("sec", S), ("term_code", S), ("host_id", S), ("status_code", S)),
    # second database: the audit trail of section changes (before/after images)
    "audit_sec_rec": _schema(("crs_no", S), ("sec_no", S), ("cat", S), ("yr", S), ("sess", S), ("fac_id", L),
                             ("beg_date", D), ("end_date", D), ("stat", S), ("stat_date", D),
                             ("schd_upd_date", D), ("audit_timestamp", TS)),
}

TABLES = tuple(SCHEMAS)

# Columns staging adds (derived from the source columns), appended to the
# source schema.  Audit images lie in a directory for each day or month.  The
# course key and the slices of term code and section key are join keys of
# several feeds: worked out once, the joins are plain column equalities.
STAGED_EXTRA: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "audit_sec_rec": (("audit_date", D), ("audit_month", S)),
    "crs_rec": (("course_key", S),),
    "sec_rec": (("course_key", S),),
    "jenzcrs_rec": (("course_key", S), ("term_sess", S), ("term_year", S), ("key_year", S)),
    "jenztrm_rec": (("term_year", S),),
}

# Source columns that may be absent (read as null); any other absent column is
# an error.
OPTIONAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "id_rec": ("fullname",),
}


def staged_schema(name: str) -> T.StructType:
    """Schema of a staged table: the source schema plus ``STAGED_EXTRA``."""
    extra = [T.StructField(n, t, True) for n, t in STAGED_EXTRA.get(name, ())]
    return T.StructType(list(SCHEMAS[name].fields) + extra)

# Join / compare keys and flags, right-trimmed at staging.
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "jenzcrs_rec": ("course_code", "sec", "term_code"),
    "crs_rec": ("crs_no", "cat", "dept", "prog"),
    "jenzccd_rec": ("course_code", "dept_code"),
    "jenztrm_rec": ("term_code",),
    "jenzdpt_rec": ("dept_code",),
    "jenzsch_rec": ("term_code", "sec", "course_code"),
    "secmtg_rec": ("crs_no", "sec_no", "cat", "yr", "sess"),
    "sec_rec": ("crs_no", "sec_no", "cat", "yr", "sess", "stat"),
    "sess_table": ("sess",),
    "mtg_rec": ("yr", "sess", "bldg"),
    "bldg_table": ("bldg",),
    "dept_table": ("dept",),
    "jenzcst_rec": ("status_code",),
    "job_rec": ("hrpay",),
    "prog_enr_rec": ("acst", "tle"),
    "addree_rec": ("style",),
    "role_rec": ("role",),
    "jenzcrp_rec": ("course_code", "sec", "term_code"),
    "audit_sec_rec": ("crs_no", "sec_no", "cat", "yr", "sess", "stat"),
}

# Range layout of the staged files: the columns the feeds filter on by range
# (run-date windows) or join on.  Files hold disjoint ranges of them, so Parquet
# statistics let scans skip whole files.  Tables not listed are written as they
# come.
CLUSTER_COLUMNS: dict[str, tuple[str, ...]] = {
    "audit_sec_rec": ("audit_timestamp",),
    "sec_rec": ("end_date", "stat_date"),
    "secmtg_rec": ("crs_no", "sec_no"),
    "jenzcrs_rec": ("course_code", "sec"),
    "jenzcrp_rec": ("course_code", "sec"),
    "mtg_rec": ("end_date", "beg_date"),
    "jenztrm_rec": ("end_date", "start_date"),
    "job_rec": ("id",),
}

# Directory partitioning of the staged history tables.  COURSES joins section
# history to the few years it needs, ENROLLMENT joins enrolments and offerings
# to the terms at hand: dynamic partition pruning reads only those folders.  The
# audit window names its days outright.
PARTITION_COLUMNS: dict[str, tuple[str, ...]] = {
    "secmtg_rec": ("yr",),
    "sec_rec": ("yr",),
    "mtg_rec": ("yr",),
    "jenzcrs_rec": ("term_code",),
    "jenzcrp_rec": ("term_code",),
    "audit_sec_rec": ("audit_date",),
}

# The same with the audit trail in a folder for each month, its files sorted by
# time: for trails of which a day fills less than a file.
BY_MONTH: dict[str, tuple[str, ...]] = {**PARTITION_COLUMNS, "audit_sec_rec": ("audit_month",)}

# Bucketed layout (``catalog.store_tables``): both sides of the meeting pattern's
# join lie in the same buckets of the meeting number.
BUCKET_COLUMNS: dict[str, tuple[str, ...]] = {
    "secmtg_rec": ("mtg_no",),
    "mtg_rec": ("mtg_no",),
}

# Where the audit table lives: a second database at the source.
AUDIT_NAMESPACE = "audit"
