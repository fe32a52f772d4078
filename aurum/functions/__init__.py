"""Column -> Column functions (Catalyst expressions, plus one Arrow UDF)."""

from aurum.functions.text import (  # noqa: F401
    blank_to_null, title_case, norm_email, norm_phone, digits, phone_suffix,
    email_domain, soundex_nordic, row_hash, dq_tier,
    full_name, capitalise,
)
from aurum.functions.ssn import ssn_mod11_valid, ssn_date_valid  # noqa: F401
from aurum.functions.similarity import jaro_winkler, jw_upper_bound  # noqa: F401
