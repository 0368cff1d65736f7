"""Fixed values.

These must equal the source system's values for the feeds to be right; they
are stated here once, as text, in their natural order.
"""

# --- fixed values -----------------------------------------------------------

# Programmes whose sections never go to the LMS (last 4 letters of a term code).
EXCLUDED_PROGRAMS = ("PRDV", "PARA", "KUSD")

# Person statuses that never make a user.
EXCLUDED_STATUSES = ("PGR", "ALM", "PTR")

# Rank of a person's status when picking their primary record (lower wins);
# any other status ranks 99.  GLL appears twice in the source; the second
# entry (8) is never reached.
STATUS_PRIORITY = (
    ("FAC", 1), ("AMA", 2), ("AMO", 3), ("GLL", 4), ("FAA", 5), ("ADA", 6),
    ("ADV", 7), ("GLL", 8), ("STF", 9), ("FW0", 10), ("FWS", 11), ("STU", 12),
)
OTHER_STATUS_PRIORITY = 99

# Pay codes of a first-rank job that do not make a person faculty.
NON_FACULTY_PAY = ("VEN", "DPW", "BIW", "FV2", "SUM", "GRD")

# Programme-enrolment standings that, with tle = 'Y', make a person faculty.
GOOD_STANDING = ("GOOD", "GRAD")
TLE_FLAG = "Y"
PREFERRED_NAME_STYLE = "N"

# Role whose open records exclude a person in the seasonal months.
PREFF_ROLE = "PREFF"
PREFF_MONTHS = (6, 7)

# Section status of a cancelled section.
CANCELLED_STAT = "X"

# Job-title sentinel: a missing title, or the title 'x', prints nothing.
NO_TITLE = "x"

# Meeting text when a meeting has no days or times.
NO_MEETING = "------- 0-0"
# Location when building or room is missing.
NO_LOCATION = "TBA"

# Row labels.
ACTIVE = "Active"
CANCELLED = "Cancelled"
OPEN = "Open"
CLOSED = "Closed"
INSTRUCTOR_ENROLLMENT = "1PR"
FACULTY_ROLE = "FAC"
STUDENT_ROLE = "STU"

# Term window: months ahead / behind of today (sections, enrolments) and the
# longer look-back of the cross-list meeting window.
TERM_MONTHS_AHEAD = 6
TERM_MONTHS_BEHIND = 1
MEETING_MONTHS_BEHIND = 3
# A cancellation is recent when its status date is after today minus this.
RECENT_CANCEL_DAYS = 4
# Audit images count from the start of (today minus this many days).
AUDIT_DAYS_BACK = 1
# The digest goes out only after this hour.
DIGEST_AFTER_HOUR = 12

# Digest text: the heading, a blank line, then one line per course
# (crs_no, sec_no, sess, yr, title; a missing value prints as None).
DIGEST_HEADING = "The following courses have been cancelled."
DIGEST_LINE = "COURSE: {0} - {1} {2} {3} {4}"
DIGEST_MISSING = "None"

# CSV headers of the exported feeds, in column order.
CSV_HEADERS = {
    "COURSES": (
        "Course Name", "Department", "Course Code", "Credits",
        "Description", "Section Name", "Section School Code",
        "Section Code", "Section Description", "Location",
        "School", "Grading Period",
    ),
    "USERS": (
        "First Name", "Preferred First Name", "Middle Name",
        "Last Name", "Name Prefix", "User Name", "Email",
        "Unique ID", "Role", "School", "Schoology ID", "Position",
        "Pwd", "Gender", "Graduation Year", "Additional Schools",
    ),
    "ENROLLMENT": (
        "Course Code", "Section Code", "Section School Code",
        "Unique ID", "Enrollment Type", "Grade Period",
    ),
    "CROSSLIST": (
        "Meeting Number", "Cross-listed Section Code", "Target Code",
    ),
}

# Export order of the feeds in one run.
FEED_ORDER = ("COURSES", "USERS", "ENROLLMENT", "CROSSLIST")

# --- end of fixed values ----------------------------------------------------

# Our own default (the school name is a parameter of every feed).
DEFAULT_SCHOOL = "Example College"
