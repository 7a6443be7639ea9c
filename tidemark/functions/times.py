"""Epoch arithmetic, window bounds and checks on watermark text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import DEFAULT_SAFETY_S, WATERMARK_DIGITS
from tidemark.functions.paths import ColumnOrName, _col

_WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"


def ms_to_s(millis: ColumnOrName) -> Column:
    """Whole seconds, by integer division."""
    return F.call_function("div", _col(millis), F.lit(1000))


def upper_bound(logical_start_ms: ColumnOrName, safety_s: ColumnOrName) -> Column:
    return ms_to_s(logical_start_ms) - _col(safety_s)


def lower_bound(explicit: ColumnOrName, persisted: ColumnOrName) -> Column:
    """An explicit start wins over the persisted one; without both, from the beginning."""
    return F.coalesce(_col(explicit), _col(persisted), F.lit(0)).cast("bigint")


def window_bounds(logical_start_ms: int, safety_s: int = DEFAULT_SAFETY_S, from_delta: int | None = None,
                  persisted: int | None = None) -> tuple[int, int]:
    """The same bounds for one run, as driver values: files with from < mtime <= to.

    ``from`` after ``to`` is an empty window.
    """
    to_s = logical_start_ms // 1000 - safety_s
    if from_delta is not None:
        return from_delta, to_s
    return (persisted if persisted is not None else 0), to_s


def whole_number(text: ColumnOrName) -> Column:
    """Text as bigint; null unless all of it is one whole number."""
    text = _col(text)
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint"))


def safety_lag(text: ColumnOrName, default: int = DEFAULT_SAFETY_S) -> Column:
    """Seconds to hold back; missing, bad or negative text means the default."""
    value = whole_number(text)
    return F.when(value >= 0, value).otherwise(F.lit(default).cast("bigint"))


def watermark_status(text: ColumnOrName, now_s: int | Column | None = None, legacy: bool = False) -> Column:
    """``ok``, ``bad_length``, ``not_numeric`` or ``future`` for persisted text.

    A trailing newline is trimmed first unless ``legacy``. The future check
    compares epoch seconds with epoch seconds.
    """
    text = _col(text)
    if not legacy:
        text = F.regexp_replace(text, r"\A\s+|\s+\z", "")
    now = F.unix_seconds(F.current_timestamp()) if now_s is None else (
        now_s if isinstance(now_s, Column) else F.lit(now_s)
    )
    value = whole_number(text)
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) != WATERMARK_DIGITS, "bad_length")
        .when(value.isNull(), "not_numeric")
        .when(value > now, "future")
        .otherwise("ok")
    )


def elapsed_ms(start_ms: ColumnOrName, end_ms: ColumnOrName) -> Column:
    return (_col(end_ms) - _col(start_ms)).cast("bigint")
