"""Scalar column helpers. Everything here stays inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelweave.config import ROOF_AGE_DATASETS

BIGINT = "bigint"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``; without this a column expression used in a
    lambda would be evaluated again for every array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def half_even(value: Column, digits: int) -> Column:
    """Round half to even the way array libraries do: scale, ``rint``, unscale."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def zero_if_null(value: Column) -> Column:
    """Sum of nothing is 0, not NULL."""
    return F.coalesce(value, F.lit(0.0))


def snake_name(name: str) -> str:
    """camelCase identifier -> snake_case, for renaming columns at plan time."""
    head, tail = name[:1].lower(), name[1:]
    return head + re.sub(r"([A-Z])", lambda m: "_" + m.group(1).lower(), tail)


def snake(value: Column) -> Column:
    """camelCase text -> snake_case, for values such as map keys."""
    return F.lower(F.regexp_replace(value, r"(?<!^)([A-Z])", "_$1"))


def label(value: Column) -> Column:
    """Free-text description -> column-name fragment."""
    return F.replace(F.lower(value), F.lit(" "), F.lit("_"))


def label_name(text: str) -> str:
    """Plan-time counterpart of :func:`label`."""
    return text.lower().replace(" ", "_")


def slug(value: Column) -> Column:
    """Collapse every run of non-alphanumerics to one underscore (file names)."""
    return F.regexp_replace(F.lower(value), r"[^a-z0-9]+", "_")


def strip_url_query(message: Column) -> Column:
    """Cut the query part off every URL in a message, so equal failures group together."""

    def shortened(piece: Column) -> Column:
        scheme = F.instr(piece, "://")
        mark = F.instr(F.substring(piece, scheme + 3, F.length(piece)), "?")
        kept = F.substring(piece, F.lit(1), scheme + 2 + mark)
        is_link = piece.contains("http://") | piece.contains("https://")
        return F.when(is_link & (mark > 0), F.concat(kept, F.lit("..."))).otherwise(piece)

    # Pieces begin at each white-space character, so joining them again gives the message.
    return F.array_join(F.transform(F.split(message, r"(?=\s)"), shortened), "")


def with_location_marker(url: Column) -> Column:
    """Append the marker suffix unless it is there already; empty or NULL stays as it is."""
    marker = "?locationMarker"
    return F.when((url == "") | url.endswith(marker), url).otherwise(F.concat(url, F.lit(marker)))


def to_day(value: Column) -> Column:
    """Text -> DATE; partial dates start at day 1, unreadable ones become NULL."""
    return value.try_cast("date")


def age_years(installed: Column, as_of: Column) -> Column:
    """Whole days between two dates in Julian years, one decimal; bad dates give NULL."""
    return half_even(F.datediff(to_day(as_of), to_day(installed)) / F.lit(365.25), 1)


def yes_no(flag: Column) -> Column:
    """BOOLEAN -> 'Y'/'N', NULL kept."""
    return F.when(flag, "Y").when(~flag, "N")


def json_object(text: Column) -> Column:
    """The text itself if it holds a non-empty JSON object, otherwise NULL."""
    return F.when(F.size(F.json_object_keys(text)) > 0, text)


def dataset_id(alias: Column) -> Column:
    """Roof-age dataset alias -> id; anything unknown passes through."""
    names = F.create_map(*[F.lit(x) for kv in ROOF_AGE_DATASETS.items() for x in kv])
    return F.coalesce(names[alias], alias)


def effective_window(row_value: Column, bulk: str | None, *, empty_is_unset: bool = False) -> Column:
    """Per-row text overrides the bulk value.

    An empty string means "no limit" for feature requests and "use the bulk value"
    for roof-age requests (``empty_is_unset=True``).
    """
    own = F.nullif(row_value, F.lit("")) if empty_is_unset else row_value
    merged = F.coalesce(own, F.lit(bulk))
    return F.nullif(merged, F.lit(""))
