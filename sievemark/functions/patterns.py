"""The regular expressions (Java syntax) and code lists the checks test for."""

WHITESPACE = r"\s"
LEADING_ALNUM = r"^\p{Alnum}"
LEADING_NON_WORD = r"^\W"
TRAILING_SPACE = r"\s+:.*\z|\s+\z|:\s+.*\z"
INVALID_ID_CHARS = r"[\]\[~`!@#$%^&*=+}{|<>;?,]"
QUESTIONABLE_ID_CHARS = r'[\\/")(]'
SPECIAL_CHARS = r"""[*&~';,%+#"\\/$@`?)(^!]"""
CONTROL_CHARS = r"\p{Cntrl}"
NEW_LINES = r"\n|\r\n"
PIPE = r"\|"
COLON = ":"
DECIMAL_POINT = r"\."
NON_ASCII_OR_BACKSLASH = r"[^\x00-\x5B\x5D-\x7F]"

EIGHT_THREE_ID = r"^\d{8}-\d{3}\z"
EIGHT_THREE_PREFIX = r"^\d{8}-\d{3}"
DOT_BETWEEN = r"(.)\.(.)"
ODD_REVISION_CHAR = r"[^A-Z0-9]"
DASH_REVISION = r"^-{1,2}\z"

COLON_SUFFIX = r":.*"
LAST_COLON_PART = r"[^:]+\z"
GROUP_FIRST_WORD = r"^[^ ]+"
GROUP_BEFORE_DOT = r"^[^\.]+"

FILE_NAME = r"[^\\]+\z"
HAS_EXTENSION = r"\.(.+)\z"
EXTENSION = r".+\.(.+)\z"
UNC_PATH = r"^\\\\"
SERVER_SHARE = r"^\\\\[^\\]+\\[^\\]+"

THREE_CAPITALS = r"[A-Z]{3}"
SUBTYPE_LOV_NAME = r"^(Nov4){0,1}[A-Z]{3}_Subtype_LOV\z"

# Status codes written in capitals; every other status is written in title case.
UPPER_STATUS_CODES = ("active", "legacy", "inactive", "stop", "mfg", "eng")
