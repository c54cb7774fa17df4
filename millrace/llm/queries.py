"""Registered queries of this subpackage, and their SQL where it can express them."""

from .decontaminate import OP3_SQL, op3_decontaminate
from .fertility import op9_fertility
from .html import op10_html
from .language import op5_language
from .licenses import OP1_SQL, op1_licenses
from .mixing import op7_mixing
from .neardup import OP8_SQL, op8_neardup
from .privacy import op2_privacy
from .quality import op6_quality
from .substrings import OP4_SQL, op4_substrings

QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_privacy": op2_privacy,
    "op3_decontaminate": op3_decontaminate,
    "op4_substrings": op4_substrings,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_neardup": op8_neardup,
    "op9_fertility": op9_fertility,
    "op10_html": op10_html,
}
SQL = {"op1_licenses": OP1_SQL, "op3_decontaminate": OP3_SQL, "op4_substrings": OP4_SQL, "op8_neardup": OP8_SQL}
