"""Dates and timestamps. Wall-clock time is kept, so the type is ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martloom import settings as S


def is_offset_timestamp(col: Column) -> Column:
    """True for ``yyyy-mm-ddThh:mm:ss+hh:mm``: no fraction, no ``Z``, no negative offset."""
    # the pattern is 25 characters long and may be followed by a line end
    return F.length(col).between(25, 26) & col.rlike(S.OFFSET_TIMESTAMP)


def year_in_range(ts: Column) -> Column:
    """The timestamp, or NULL when its year is outside the supported years."""
    return F.when(F.year(ts).between(S.FIRST_YEAR, S.LAST_YEAR), ts)


def _wall_clock(col: Column) -> Column:
    """Time of an offset timestamp; the year is tested as text, so that the cell is parsed once."""
    in_range = F.substring(col, 1, 4).between(str(S.FIRST_YEAR), str(S.LAST_YEAR))
    return F.when(in_range, F.substring(col, 1, 19).try_cast("timestamp_ntz"))


def local_timestamp(col: Column) -> Column:
    """Wall-clock time of an offset timestamp; NULL for other text and impossible dates."""
    return F.when(is_offset_timestamp(col), _wall_clock(col))


def local_timestamp_text(col: Column) -> Column:
    """Offset timestamps as ``yyyy-MM-dd HH:mm:ss``; other text is unchanged."""
    return F.when(is_offset_timestamp(col), _wall_clock(col).cast("string")).otherwise(col)


def to_datetime(col: Column) -> Column:
    """Text as a timestamp without zone, NULL when it is none."""
    return col.try_cast("timestamp_ntz")


def zero_date_to_null(col: Column) -> Column:
    """NULL for the all-zero date."""
    return F.nullif(col, F.lit(S.ZERO_DATE))


def has_date_shape(col: Column) -> Column:
    """True for a plain date or a timestamp with ``Z`` or any offset."""
    return col.rlike(S.PLAIN_DATE) | col.rlike(S.ANY_TIMESTAMP)
