"""Declarative rule tables and the fixed values the results depend on.

FIXED VALUES (must stay equal to the reference behaviour):
- nickname -> canonical first name dictionary (35 pairs, upper case)
- national-id control-digit weights 3 7 6 1 8 9 4 5 2 and 5 4 3 2 7 6 5 4 3 2
- disposable e-mail domains (bulk: mailinator.com, tempmail.com;
  stream: mailinator.com, tempmail.com, guerrillamail.com, 10minutemail.com)
- placeholder phones (bulk: 00000000000, 11111111111;
  stream: 0000000000, 1111111111, 1234567890)
- quality tiers 90 / 70 / 50 -> Excellent / Good / Fair / Poor
- match thresholds: pairwise and stream 0.70, SSN-first fuzzy 92 (of 100)
"""

from __future__ import annotations

# Fixed value: nickname dictionary (nickname, canonical), upper case.
NICKNAMES: list[tuple[str, str]] = [
    ("PER", "PER"), ("PETTER", "PER"), ("PETER", "PER"),
    ("OLE", "OLE"), ("OLAV", "OLE"), ("OLUF", "OLE"),
    ("BJØRN", "BJØRN"), ("BJÖRN", "BJØRN"),
    ("KARI", "KARI"), ("KARIN", "KARI"), ("KAREN", "KARI"), ("KATRINE", "KARI"),
    ("MARIE", "MARIE"), ("MARIA", "MARIE"), ("MARI", "MARIE"), ("MARIANNE", "MARIE"),
    ("JON", "JON"), ("JONAS", "JON"), ("JONATHAN", "JON"),
    ("ANN", "ANN"), ("ANNE", "ANN"), ("ANNA", "ANN"), ("ANNIKEN", "ANN"), ("ANETTE", "ANN"),
    ("LARS", "LARS"), ("LAURITZ", "LARS"), ("LAURITS", "LARS"),
    ("LISE", "LISE"), ("LISA", "LISE"), ("ELISABETH", "LISE"),
    ("EIRIK", "EIRIK"), ("ERIK", "EIRIK"),
    ("TRINE", "TRINE"),
    ("HILDE", "HILDE"), ("HILDEGUNN", "HILDE"),
]

# National-id modulus-11 weights.
SSN_WEIGHTS_1 = [3, 7, 6, 1, 8, 9, 4, 5, 2]
SSN_WEIGHTS_2 = [5, 4, 3, 2, 7, 6, 5, 4, 3, 2]

# Disposable domains and placeholder phones per rule set.
DISPOSABLE_DOMAINS_BULK = ["mailinator.com", "tempmail.com"]
DISPOSABLE_DOMAINS_STREAM = ["mailinator.com", "tempmail.com", "guerrillamail.com", "10minutemail.com"]
PLACEHOLDER_PHONES_BULK = ["00000000000", "11111111111"]
PLACEHOLDER_PHONES_STREAM = ["0000000000", "1111111111", "1234567890"]

# Validator patterns (Java regex).
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
NAME_PATTERN_BULK = r"^[A-Za-zæøåÆØÅ '-]+$"
NAME_PATTERN_STREAM = r"^[A-Za-z '-]+$"
PHONE_PATTERN_NO = r"^\+47[0-9]{8}$"
PHONE_PATTERN_INTL = r"^\+?[0-9]{10,15}$"
POSTCODE_PATTERN_NO = r"^[0-9]{4}$"
SSN_PATTERN = r"^[0-9]{11}$"

# Quality tiers (lower bound, label), checked top-down.
DQ_TIERS = [(90, "Excellent"), (70, "Good"), (50, "Fair")]
DQ_TIER_FLOOR = "Poor"

# Test / placeholder name tokens of the rule-based fake-name flag.
FAKE_TOKENS = ["TEST", "DUMMY", "ASDF", "QWERTY", "FOO", "BAR", "XXX", "NONAME", "UNKNOWN"]

MATCH_THRESHOLD = 0.70
# Scores of the pairwise rules (label, score), the fuzzy-name rule (least similarity, weight) and the soundex bonus.
PAIR_SCORES = [("D01", 1.0), ("D01b", 0.98), ("D02", 0.95)]
FUZZY_NAME_LEAST = 0.85
FUZZY_NAME_WEIGHT = 0.85
SOUNDEX_BONUS = 0.10
# Scores of the stream's deterministic rules (D01 e-mail, D02 phone, C01 name) and weights of its
# probabilistic ones (P01 full name, P03 soundex, P04 domain and first name), least similarity of a first name
STREAM_SCORES = {"D01": 1.0, "D02": 0.95, "C01": 0.80, "P01": 0.30, "P03": 0.20, "P04": 0.15}
STREAM_FIRST_NAME_LEAST = 0.90
STREAM_PROBABILISTIC_MOST = sum(STREAM_SCORES[r] for r in ("P01", "P03", "P04"))
STREAM_DETERMINISTIC_LEAST = min(STREAM_SCORES[r] for r in ("D01", "D02", "C01"))
FUZZY_THRESHOLD_V1 = 92.0
OPEN_END = "9999-12-31"

# Source trust: SSN-first (higher = better) and pairwise priorities (1 = best).
TRUST_V1 = {"FREG": 3, "BS": 2, "NICE": 1}
PRIORITY_BANK = {"FREG": 1, "BS": 2, "NICE": 3}
PRIORITY_INS = {"FREG": 1, "BS": 2, "NICE": 2}
CITIZENSHIP_PRIORITY_BANK = {"FREG": 1, "BS": 1, "NICE": 2}
CITIZENSHIP_PRIORITY_INS = {"FREG": 1, "BS": 2, "NICE": 2}
ADDRESS_PRIORITY = {"FREG": 1, "BS": 2, "NICE": 3}
STREAM_PRIORITY = {"CRM_A": 1, "CRM_B": 2, "CRM_C": 3}

ORGANIZATIONS = ["BANK", "INS"]

TOPICS = {"topic.crm.a": "CRM_A", "topic.crm.b": "CRM_B", "topic.crm.c": "CRM_C"}


def check_match_graph() -> None:
    """The match graphs rest on this order of scores and threshold; a rule table that breaks it must not run silently.

    Pairwise: every deterministic rule and every fuzzy name match at its least
    reaches the threshold alone, and the soundex bonus alone does not. Stream:
    the deterministic rules reach it alone, the probabilistic ones do not together.
    """
    least = min([score for _, score in PAIR_SCORES] + [FUZZY_NAME_LEAST * FUZZY_NAME_WEIGHT])
    if not SOUNDEX_BONUS < MATCH_THRESHOLD <= least:
        raise ValueError(f"MATCH_THRESHOLD must lie over {SOUNDEX_BONUS} and not over {least:.4f} for the pairwise match graph")
    if not STREAM_PROBABILISTIC_MOST < MATCH_THRESHOLD <= STREAM_DETERMINISTIC_LEAST:
        raise ValueError(f"MATCH_THRESHOLD must lie over {STREAM_PROBABILISTIC_MOST} and not over {STREAM_DETERMINISTIC_LEAST} for the stream match graph")
