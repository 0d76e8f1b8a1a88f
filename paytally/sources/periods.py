"""Paths of the raw files of a day, a month or a year."""

from __future__ import annotations


def _day_file(prefix: str, year: int | str, month: int | str, day: int | str) -> str:
    return f"{prefix}_{year}_{str(month).zfill(2)}_{str(day).zfill(2)}.json"


def period_path(
    root: str,
    year: int | str,
    month: int | str | None = None,
    day: int | str | None = None,
    prefix: str = "payments",
) -> str:
    """Path or glob of a period below ``root``.

    Layout: ``<root>/YYYY_MM/<prefix>_YYYY_MM_DD.json``. A year is a glob over its
    month folders, a month a glob over one folder, a day one file. The glob keeps
    the scan to the folders of the period.
    """
    root = root.rstrip("/")
    if month is None:
        if day is not None:
            raise ValueError("a day needs a month")
        return f"{root}/{year}_*"
    folder = f"{root}/{year}_{str(month).zfill(2)}"
    if day is None:
        return f"{folder}/*"
    return f"{folder}/{_day_file(prefix, year, month, day)}"


def landing_path(
    root: str, year: int | str, month: int | str, day: int | str, prefix: str = "payments"
) -> str:
    """Path of a day's file in the landing folder, before it has been processed."""
    return f"{root.rstrip('/')}/unprocessed/{_day_file(prefix, year, month, day)}"
