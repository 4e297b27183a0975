"""Text expressions over annotator output (Unicode-aware, whole texts)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackloom.model import ABSENCE_WORDS, DURATION_LEAK_PATTERN, OK, REFUSAL_PATTERN, SUBJECT_WORDS

# --- fixed values: what Python counts as white space, and non-ASCII digits ------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
ASCII_DIGITS = "01234567890123456789"
# --------------------------------------------------------------------------------

SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+"
BPM = r"(?U)(?:^|[^0-9.])([0-9]{2,3}(?:\.[0-9]+)?)\s*(?i:BPM)"
KEY = r"(?U)\b[A-G][#♯b♭]?[\s\u2011-]+(?i:major|minor)\b"
TIME_SIGNATURE = r"(?:^|[^0-9/])([0-9]{1,2}/(?:2|4|8|16))(?![0-9/])"
BULLET = r"(?U)^\s*[-•*]\s+([^:\n]+?)\s*:\s*(.*)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python's ``str.strip()``: ``trim`` alone removes only plain spaces."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def ascii_digits(c: Column | str) -> Column:
    return F.translate(_col(c), ARABIC_DIGITS, ASCII_DIGITS)


def to_int(c: Column | str) -> Column:
    """Whole number in text, or null. Accepts Arabic-Indic digits and outer blanks."""
    # the pattern keeps bad text away from the cast, whose failures are slow
    digits = F.regexp_extract(ascii_digits(strip(c)), r"^[+-]?[0-9]+$", 0)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def quoted(c: Column | str) -> Column:
    """Text in quotes, switching to double quotes around an apostrophe."""
    c = F.replace(_col(c), F.lit("\\"), F.lit("\\\\"))
    has_single, has_double = F.contains(c, F.lit("'")), F.contains(c, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), c, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def cell_text(status: Column | str, output: Column | str, error: Column | str) -> Column:
    """One summary cell: the answer on one line, or ``[status] reason``."""
    status, output, error = _col(status), _col(output), _col(error)
    answer = F.translate(F.coalesce(output, F.lit("")), "\n", " ")
    reason = F.concat(
        F.lit("["), F.coalesce(status, F.lit("missing")), F.lit("] "), F.coalesce(error, F.lit(""))
    )
    return strip(F.when(status == OK, answer).otherwise(reason))


def sentences(text: Column | str) -> Column:
    """Sentences with their end marks and blanks, so that joining them gives the text back."""
    return F.regexp_extract_all(_col(text), F.lit(SENTENCE), F.lit(0))


def drop_sentences(text: Column | str, pattern: str) -> Column:
    """The text without the sentences that match; untouched when none does."""
    text = _col(text)
    kept = F.array_join(F.filter(sentences(text), lambda s: ~s.rlike(pattern)), "")
    return F.when(text.rlike(pattern), strip(kept)).otherwise(text)


def drop_refusals(text: Column | str, pattern: str = REFUSAL_PATTERN) -> Column:
    return drop_sentences(text, pattern)


def drop_noise(text: Column | str) -> Column:
    """Without refusals and leaked durations, in one pass over the sentences."""
    return drop_sentences(text, f"{REFUSAL_PATTERN}|{DURATION_LEAK_PATTERN}")


def states_absence(
    text: Column | str, within: int = 4, subjects: list[str] = SUBJECT_WORDS, absences: list[str] = ABSENCE_WORDS,
) -> Column:
    """Whether a subject word stands at most ``within`` words from one that says it is absent."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))

    def near(words: Column) -> Column:
        around = lambda i: F.slice(words, F.greatest(i - within + 1, F.lit(1)), within + 1 + F.least(i, F.lit(within)))
        return F.size(F.filter(words, lambda w, i: w.isin(subjects) & F.exists(around(i), lambda x: x.isin(absences)))) > 0

    # as a lambda's argument the words are taken out of the text once
    return F.exists(F.array(found), near)


def drop_evasions(text: Column | str, within: int = 4) -> Column:
    """The text without sentences that say in other words that a subject is absent; untouched when none does.

    A sentence is only taken apart when an absence word is in it.
    """
    text = _col(text)
    absent = "(?i)" + "|".join(ABSENCE_WORDS)
    evades = lambda s: s.rlike(absent) & states_absence(s, within)
    parts = F.transform(sentences(text), lambda s: F.struct(s.alias("s"), evades(s).alias("evades")))
    # a list of one, so that every sentence is judged once
    cleaned = F.transform(F.array(parts), lambda ps: F.when(
        F.exists(ps, lambda p: p["evades"]), strip(F.array_join(F.transform(F.filter(ps, lambda p: ~p["evades"]), lambda p: p["s"]), ""))
    ).otherwise(text))[0]
    return F.when(text.rlike(absent), cleaned).otherwise(text)


def drop_duration_leaks(text: Column | str, pattern: str = DURATION_LEAK_PATTERN) -> Column:
    return drop_sentences(text, pattern)


def tag_list(text: Column | str) -> Column:
    """Comma-separated noun phrases as an array: lower case, stripped, no blanks."""
    return F.filter(
        F.transform(F.split(_col(text), ","), lambda t: F.lower(strip(t))), lambda t: t != ""
    )


def bpm_values(text: Column | str) -> Column:
    """All tempo figures in the text, rounded to one decimal."""
    found = F.regexp_extract_all(_col(text), F.lit(BPM), F.lit(1))
    return F.transform(found, lambda v: F.round(v.cast("double"), 1))


def first_bpm(text: Column | str) -> Column:
    """First tempo figure in the text; one search, no array of all of them."""
    return F.round(F.nullif(F.regexp_extract(_col(text), BPM, 1), F.lit("")).cast("double"), 1)


def musical_key(text: Column | str) -> Column:
    """First key named, as ``C# minor``; null when there is none."""
    # one chain, so that the text is searched once
    found = F.translate(F.regexp_extract(_col(text), KEY, 0), "♯♭", "#b")
    named = F.initcap(F.regexp_replace(found, r"(?U)[\s\u2011-]+", " "))
    lower_mode = F.replace(F.replace(named, F.lit(" Major"), F.lit(" major")), F.lit(" Minor"), F.lit(" minor"))
    return F.nullif(lower_mode, F.lit(""))


def time_signature(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(text), TIME_SIGNATURE, 1), F.lit(""))


def bullet_fields(text: Column | str) -> Column:
    """``- Label: answer`` lines as an array of (position, label, answer)."""
    lines = F.transform(
        F.split(_col(text), "\n"),
        lambda line, i: F.struct(
            i.alias("position"),
            F.regexp_extract(line, BULLET, 1).alias("label"),
            strip(F.regexp_extract(line, BULLET, 2)).alias("answer"),
        ),
    )
    return F.filter(lines, lambda f: f["label"] != "")


def word_count(text: Column | str) -> Column:
    # runs of other characters are the words: no strip, no array of them
    return F.regexp_count(_col(text), F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def in_length_rule(text: Column | str, low: int = 60, high: int = 120) -> Column:
    return word_count(text).between(low, high)
