"""Text functions on columns. All but NFKC and title case are built-in expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.storage import ship

# Legal forms, address words and country names with what they become.
LEGAL_FORMS = {
    "corp": "corporation", "corporation": "corporation", "pvt": "private", "private": "private", "ltd": "limited", "limited": "limited",
    "inc": "incorporated", "incorporated": "incorporated", "co": "company", "company": "company", "llc": "llc", "plc": "plc", "gmbh": "gmbh", "sa": "sa", "sarl": "sarl",
}
ADDRESS_WORDS = {
    "rd": "road", "road": "road", "st": "street", "street": "street", "ave": "avenue", "avenue": "avenue", "blvd": "boulevard", "boulevard": "boulevard",
    "apt": "apartment", "apartment": "apartment", "no": "number", "num": "number", "number": "number", "ste": "suite", "suite": "suite", "fl": "floor", "flr": "floor", "floor": "floor",
    "bldg": "building", "building": "building", "dr": "drive", "drive": "drive", "ln": "lane", "lane": "lane", "pkwy": "parkway", "parkway": "parkway", "hwy": "highway", "highway": "highway",
}
COUNTRIES = {
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US", "in": "India", "ind": "India", "india": "India",
    "fr": "France", "fra": "France", "france": "France",
}
GENERIC = sorted({*LEGAL_FORMS, *LEGAL_FORMS.values()})

#: Punctuation and symbols of the basic plane; those beyond it (emoji) stay.
PUNCTUATION = r"[\p{P}\p{S}&&[\x{0}-\x{FFFF}]]"
SPACES = r"(?U)[\s\x1c-\x1f]+"
#: Characters that NFKC can change; all others below U+0132 are stable.
UNSTABLE = r"[^\x00-\x7F\xC0-\x{131}]"


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def _title(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.title())


def _ready() -> None:
    """The functions above run on executors, which need the package."""
    session = SparkSession.getActiveSession()
    if session is not None:
        ship(session)


def nfkc(c: Column) -> Column:
    """NFKC. Only values that it can change are sent to Python; the others go as nulls."""
    _ready()
    return F.coalesce(_nfkc(F.when(c.rlike(UNSTABLE), c)), c)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?U)^[\s\x1c-\x1f]*$")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def tokens(c: Column) -> Column:
    """Split at white space; never an empty token."""
    return F.filter(F.split(c, SPACES), lambda x: x != "")


def no_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCTUATION, " ")


def _mapped(words: Column, table: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.transform(words, lambda t: F.coalesce(F.try_element_at(m, t), t))


def name_words(c: Column, unicode: bool = True) -> Column:
    low = F.lower(nfkc(c) if unicode else c)
    return F.when(blank(c), F.array().cast("array<string>")).otherwise(_mapped(tokens(no_punctuation(low)), LEGAL_FORMS))


def significant(words: Column) -> Column:
    """The words that are no legal form; all of them, if none is left."""
    rest = F.filter(words, lambda t: ~t.isin(GENERIC))
    return F.when(F.size(rest) == 0, words).otherwise(rest)


def address_words(c: Column, unicode: bool = True) -> Column:
    low = F.lower(nfkc(c) if unicode else c)
    return F.when(blank(c), F.array().cast("array<string>")).otherwise(_mapped(tokens(no_punctuation(low)), ADDRESS_WORDS))


def digit_runs(c: Column, unicode: bool = True) -> Column:
    return F.when(blank(c), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(F.lower(nfkc(c) if unicode else c), F.lit(r"(\p{Nd}+)"), 1))


def clean_country(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    plain = strip(c)
    known = F.try_element_at(m, F.lower(plain))
    _ready()
    other = _title(F.when(known.isNull() & ~blank(c), plain))
    return F.when(blank(c), F.lit("")).otherwise(F.coalesce(known, other))


def id_list(c: Column, trim: bool = True, keep_blank: bool = False) -> Column:
    """A comma list as an array; a null or empty list has no id."""
    parts = F.split(F.coalesce(c, F.lit("")), ",")
    parts = F.transform(parts, lambda x: strip(x)) if trim else parts
    return parts if keep_blank else F.filter(parts, lambda x: x != "")


def words_of(c: Column) -> Column:
    """The words of an already cleaned, space-joined string."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda x: x != "")


NA_LITERALS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def na_as_empty(c: Column) -> Column:
    """Optional: literals that data-frame readers take for missing become empty."""
    return F.when(c.isNull() | c.isin(*NA_LITERALS), F.lit("")).otherwise(c)
