"""Column expressions of the data path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vantry.functions import edits


def normalize_identifier(value: Column) -> Column:
    """Trimmed, single quotes stripped; digits as canonical integer text, else upper case; null for several signs."""
    bare = F.trim(F.btrim(F.trim(value), F.lit("'")))
    return F.when(bare.rlike(r"^-?\d{1,18}$"), F.regexp_replace(F.regexp_replace(bare, r"^(-?)0+(?=\d)", "$1"), "^-0$", "0")).when(bare.rlike(r"^--+\d+$"), None).otherwise(F.upper(bare))


def recording_start(value: Column) -> Column:
    """MM/dd/yyyy hh:mm am/pm as ISO text; blank as ''; anything else as it stands."""
    parsed = F.try_to_timestamp(F.trim(value), F.lit("M/d/yyyy h:mm a"))
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", F.lit("")).otherwise(F.coalesce(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"), value))


def minute_bucket(value: Column) -> Column:
    """ISO date and time, truncated to the minute; null if it is no such text."""
    return F.when(value.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d)?$"), F.date_trunc("MINUTE", F.try_to_timestamp(F.regexp_replace(value, " ", "T")))).cast("timestamp_ntz")


def clock(seconds: Column) -> Column:
    """HH:MM:SS, wrapping at 24 hours; --:--:-- for null."""
    s = F.pmod(F.floor(seconds).cast("bigint"), F.lit(86400))
    parts = (F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return F.when(seconds.isNull(), F.lit("--:--:--")).otherwise(F.concat_ws(":", *(F.lpad(x.cast("string"), 2, "0") for x in parts)))


def speaker_label(speaker: Column) -> Column:
    """Bare integers as SPEAKER_nn, by their value; anything else as it stands."""
    number = F.regexp_extract(speaker, r"^0*(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("SPEAKER_"), F.lpad(number, F.greatest(F.length(number), F.lit(2)), F.lit("0")))).otherwise(speaker)


def annotation_ms(seconds: Column) -> Column:
    """Milliseconds, halves to even."""
    return F.rint(seconds * 1000).cast("bigint")


def pitch_bucket(hz: Column) -> Column:
    return F.when(hz < 145, "lower").when(hz > 185, "higher").otherwise("ambiguous")


def normalized_text(text: Column) -> Column:
    """Lower case without punctuation, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\p{P}", ""), r"\s+", " "))


def char_error_rate(ref: Column, hyp: Column) -> Column:
    """Edits over characters of the reference; null if it has none."""
    return F.round(F.try_divide(edits.char_edits(ref, hyp), F.char_length(ref)), 4)


def word_error_rate(ref: Column, hyp: Column) -> Column:
    """Word edits over words of the reference, for any number of distinct words; null if the reference has none."""
    words = F.size(F.filter(F.split(ref, " "), lambda w: w != ""))
    return F.round(F.try_divide(edits.word_edits(ref, hyp), words), 4)
