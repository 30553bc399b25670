"""Name cleaning, roman district numbers and composite keys."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with a canonical decomposition in Polish, and their base letters.
ACCENTED = "ąćęńóśźżĄĆĘŃÓŚŹŻ"
PLAIN = "acenoszzACENOSZZ"

# Weights of the roman letters, and what a subtractive pair takes off their sum.
ROMAN_LETTERS = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
ROMAN_PAIRS = {"IV": 2, "IX": 2, "XL": 20, "XC": 20}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slug(name: Column | str) -> Column:
    """Drop a trailing parenthesis and turn blanks into underscores."""
    return F.translate(F.regexp_replace(_col(name), r"\s*\(.*\)", ""), " ", "_")


def strip_diacritics(s: Column | str) -> Column:
    """Base letters for the Polish accents. The stroke of l has no decomposition and stays."""
    return F.translate(_col(s), ACCENTED, PLAIN)


def strip_diacritics_nfkd(s: Column | str) -> Column:
    """Same for any script: full compatibility decomposition, in Arrow batches."""
    @F.pandas_udf("string")
    def decompose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata

        def plain(text):
            if text is None:
                return None
            parts = unicodedata.normalize("NFKD", text)
            return "".join(ch for ch in parts if not unicodedata.combining(ch))

        for batch in batches:
            yield batch.map(plain)

    return decompose(_col(s))


def _occurrences(text: Column, token: str) -> Column:
    removed = F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))
    return (removed / len(token)).cast("int")


def roman_in_parens(name: Column | str) -> Column:
    """Integer value of a roman numeral in the first parentheses, else NULL."""
    token = F.trim(F.regexp_extract(_col(name), r"^[^(]*\(([^)]*)\)", 1))
    total = F.lit(0)
    for letter, weight in ROMAN_LETTERS.items():
        total = total + _occurrences(token, letter) * weight
    # an X already taken by IX cannot open XL or XC
    rest = F.replace(token, F.lit("IX"), F.lit(" "))
    for pair, correction in ROMAN_PAIRS.items():
        total = total - _occurrences(token if pair[0] == "I" else rest, pair) * correction
    return F.when(token.rlike("^[IVXLCDM]+$"), total)


def trip_key(trip_id: Column, headsign: Column, day: Column, mode: Column) -> Column:
    """Identity of one run: trip, headsign, date and mode; missing parts read ``nan``."""
    parts = [F.coalesce(c.cast("string"), F.lit("nan")) for c in (trip_id, headsign, day, mode)]
    return F.concat_ws("_", *parts)


def vector_id(trip_id: Column, day_text: Column, seq: Column, next_seq: Column) -> Column:
    """Digest that names a stop-to-stop vector of a run."""
    end = F.coalesce(next_seq.cast("string"), F.lit("END"))
    return F.md5(F.concat(trip_id, day_text, seq.cast("string"), end))


def same_row(left: str, right: str, cols: list[str]) -> Column:
    """NULL-safe equality of the named columns of two aliased relations."""
    pick = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in cols])
    return pick(left).eqNullSafe(pick(right))


def file_stem(path: Column | str) -> Column:
    return F.regexp_replace(F.regexp_extract(_col(path), r"([^/]*)$", 1), r"\.[^.]*$", "")


def table_of(path: Column | str) -> Column:
    """Table name of an export file: the stem without a date or timestamp suffix."""
    return F.regexp_replace(file_stem(path), r"(?i)(_\d{4}-\d{2}-\d{2}|_\d{8}T\d{6}Z)$", "")


def date_of(path: Column | str) -> Column:
    """Date of a daily export file, NULL for any other file."""
    text = F.regexp_extract(_col(path), r"(?i)_(\d{4}-\d{2}-\d{2})\.parquet$", 1)
    return F.when(text != "", text).try_cast("date")
