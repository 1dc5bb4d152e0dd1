"""Conversion counts out of the JSON action list of an ad insight."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTIONS_TYPE = "array<struct<action_type:string,value:string>>"

# Action types that do not count as conversions.
UNCOUNTED_ACTIONS = (
    "link_click",
    "landing_page_view",
    "page_engagement",
    "post_engagement",
)

ParseMode = Literal["strict", "lenient"]


def is_action_list(column: Column) -> Column:
    """True for text that starts like a JSON array; blank text counts as ``[]``."""
    return F.coalesce(F.trim(column), F.lit("")).rlike(r"^(\[|$)")


def parse_actions(column: Column, mode: ParseMode = "strict") -> Column:
    """Action list as an array of structs; NULL and ``''`` are the empty list.

    ``strict`` fails the job on text that is no JSON array. ``lenient`` turns such
    text into NULL, to be counted by a data-quality check.
    """
    text = F.when(column.isNull() | (column == ""), F.lit("[]")).otherwise(column)
    if mode == "strict":
        parsed = F.from_json(text, ACTIONS_TYPE, {"mode": "FAILFAST"})
        refused = F.raise_error(F.concat(F.lit("not a JSON array of actions: "), text))
        return F.when(is_action_list(text), parsed).otherwise(refused)
    if mode == "lenient":
        return F.when(is_action_list(text), F.from_json(text, ACTIONS_TYPE))
    raise ValueError(f"unknown mode {mode!r}")


def counted_actions(actions: Column) -> Column:
    """Drop uncounted types. A missing type compares to NULL and is dropped too."""
    return F.filter(actions, lambda e: ~e["action_type"].isin(*UNCOUNTED_ACTIONS))


def action_conversions(column: Column, mode: ParseMode = "strict") -> Column:
    """Sum of the counted values of one row, without exploding it."""
    cast = "cast" if mode == "strict" else "try_cast"
    values = F.transform(
        counted_actions(parse_actions(column, mode)),
        lambda e: getattr(e["value"], cast)("double"),
    )
    present = F.filter(values, lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    return F.coalesce(total, F.lit(0.0))
