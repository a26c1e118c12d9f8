"""Parameter tables shared by the Spark plans and the SQL oracles.

Every table here is a caller-supplied parameter in the library API; these are
the defaults used by the registered queries. The oracle SQL is rendered from
the same Python literals, so both engines always see identical inputs.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Entity dictionary (canonical name -> aliases, dictionary
# order matters for alias canonicalisation), comparison companies, stop words,
# sentiment lexicon, negation words and calendar periods for the generated
# test tables. Tokens are frequent invented words of the corpus; "ble" is a
# deliberate substring trap and "the by" a two-word alias.
# ---------------------------------------------------------------------------
ENTITY_ALIASES: list[tuple[str, list[str]]] = [
    ("Thre Ea", ["thre", "thea"]),
    ("Thon Ly", ["thon", "thly"]),
    ("Ble Sh", ["ble", "thsh"]),
    ("Erth Nd", ["erth", "thnd"]),
    ("Wh Tion", ["thwh", "thtion"]),
    ("Sich Mit", ["sich", "mit"]),
    ("The By", ["the by", "thby"]),
    ("Onon Ti", ["onon", "onti"]),
]

COMPANIES: list[str] = ["Erre", "Onan", "Erin", "Los", "Zu"]

STOP_WORDS: list[str] = [
    "the", "and", "that", "for", "was", "with", "this", "from", "are", "has",
    "have", "had", "not", "but", "you", "his", "her", "its", "all", "any",
    "can", "our", "out", "she", "who", "they", "them", "then", "than", "there",
    "der", "die", "und", "den", "von", "das", "dem", "ist", "auf", "mit",
    "que", "les", "des", "une", "est", "por", "los", "las", "del", "con",
]

LEXICON: list[tuple[str, float]] = [
    ("thing", 1.9), ("ther", 1.2), ("thth", -1.5), ("erin", 0.7),
    ("ernt", -1.1), ("eran", 2.1), ("erat", -2.3), ("ered", 0.5),
    ("ering", 1.4), ("eren", -0.9), ("onon", 1.0), ("onti", -1.7),
    ("ble", -0.4), ("worthless", -2.6), ("sich", 1.1), ("thly", 1.6),
    ("oned", -2.0), ("thin", -0.6), ("thea", 0.8), ("thon", -1.2),
    ("tion", 0.6), ("ing", -0.7), ("thre", 1.3), ("than", -0.5),
    ("ha", 0.9), ("nd", -0.8), ("ea", 0.4), ("ly", -0.3),
]

NEGATIONS: list[str] = ["not", "nicht", "pas", "never", "ohne", "sin", "nie", "thhe"]

# VADER's published constants: compound = s / sqrt(s*s + alpha); a negated
# word has its valence multiplied by the negation scalar; a booster moves the
# valence by 0.293, less one and two words further away; capitals by 0.733; an
# exclamation mark adds 0.292, two or three question marks 0.18 each, more 0.96.
VADER_ALPHA = 15.0
NEGATION_SCALAR = -0.74
BOOST = 0.293
FADE = (1.0, 0.95, 0.9)
CAPS = 0.733
SHOUT = 0.292
ASK = 0.18
ASK_MOST = 0.96

# Booster and contrast words for the generated test tables (words
# of their languages and frequent invented ones).
BOOSTERS: list[tuple[str, float]] = [
    ("very", BOOST), ("sehr", BOOST), ("trop", BOOST), ("muy", BOOST), ("that", BOOST), ("thou", BOOST), ("erea", BOOST),
    ("slightly", -BOOST), ("kaum", -BOOST), ("peu", -BOOST), ("thed", -BOOST), ("onre", -BOOST),
]
CONTRAST: list[str] = ["but", "aber", "mais", "pero", "thor"]

# name, start (inclusive), end (inclusive, midnight of the last day; Q3)
PERIODS: list[tuple[str, str, str]] = [
    ("<1997", "1995-01-01", "1996-12-31"),
    ("1997-1998", "1997-01-01", "1998-12-31"),
    ("1999-2000", "1999-01-01", "2000-12-30"),
    ("2001", "2001-01-01", "2001-12-31"),
]

SENTIMENT_THRESHOLD = 0.03
EDGE_THRESHOLDS = (-0.1, 0.1)
MIN_WORD_FREQ = 4
NGRAM_MAX = 2


def entities() -> list[str]:
    return [e for e, _ in ENTITY_ALIASES]


def alias_rows() -> list[tuple[str, str, int]]:
    """(entity, alias lower-case, alias order) incl. the canonical name itself,
    plus companies (which match on their own name only)."""
    rows = []
    for e, aliases in ENTITY_ALIASES:
        for a in [e] + aliases:
            rows.append((e, a.lower(), len(rows)))
    for c in COMPANIES:
        rows.append((c, c.lower(), len(rows)))
    return rows


def alias_lookup() -> list[tuple[str, str]]:
    """Ordered (alias, canonical token) for word-bounded replacement.

    Mirrors a dict keyed by lower-case alias: a later duplicate alias
    overwrites the value but keeps the first position."""
    order: dict[str, str] = {}
    for e, aliases in ENTITY_ALIASES:
        for a in aliases:
            order[a.lower()] = e.lower().replace(" ", "_")
    return list(order.items())


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_str(v) for v in values) + "]"

# Fixed values for the price binding: per-symbol beta constants, target and
# peers of the herding (CSAD) study, and the feature date floor.
BETAS: list[tuple[str, float]] = [
    ("AUTOMOBILE", 1.8), ("BUILDING", 0.9), ("FURNITURE", 1.1),
    ("HOUSEHOLD", 0.7), ("MACHINERY", 1.3),
]
TARGET_SYMBOL = "AUTOMOBILE"
PEER_SYMBOLS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FEATURE_DATE_FLOOR = "1995-03-01"
RSI_PERIOD = 14
VOL_WINDOW = 10
N_VOLUME_LAGS = 10

# A small (form, lemma) table for the re-aimed lemmatiser.
LEMMAS: list[tuple[str, str]] = [
    ("things", "thing"), ("erings", "ering"), ("tions", "tion"), ("eas", "ea"),
    ("thes", "the"), ("ered", "er"), ("ering", "er"),
]

# A small (symbol, name) table for the re-aimed emoji names.
SYMBOLS: list[tuple[str, str]] = [
    ("\U0001F600", "grinning_face"), ("\U0001F44D", "thumbs_up"), ("\u2764", "red_heart"),
    ("\u00df", "sharp_s"), ("&", "ampersand"), ("%", "percent_sign"), ("$", "dollar_sign"),
]
