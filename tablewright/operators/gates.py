"""Gates: one-row aggregates that fail a run which captured nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    pass


def harvest_reason(work_items: Column, records: Column) -> Column:
    return F.when(work_items == 0, "no work items: the census failed").when(records == 0, "work items gave ZERO records")


def census_reason(requests: Column, denied: Column, work_items: Column) -> Column:
    return F.when((requests > 0) & (denied == requests), "every request was denied by robots.txt").when(
        (requests > 0) & (work_items == 0), "requests gave ZERO work items"
    )


def pilot_reason(fetched: Column) -> Column:
    return F.when(fetched == 0, "the pilot fetched 0 pages: the sample says nothing about the family")


def check(one_row: DataFrame, reason: Column) -> None:
    """Raises GateError with the reason, if there is one."""
    said = one_row.select(reason.alias("reason")).first()
    if said and said["reason"]:
        raise GateError(said["reason"])
