"""Finding dated reports: the newest report (R10) and one report's rows (R11).

Per-element reports are stored per date and element (``date=YYYY-MM-DD/rse=X``),
whole reports per date, so both lookups are partition filters first. The newest
dates are a small table (one row per element, or one date) joined back with a
semi join: no window over an element's rows, so an element holding a third of
all rows is never gathered into one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.plans.joins import fits

# Look-back of the lookup, and the look-ahead used for replica inventories
# (their dump dates run ahead of the calendar).
DEFAULT_BACK_DAYS = 13
REPLICA_AHEAD_DAYS = 5
REPLICA_BACK_DAYS = 8
# An element name starting with this asks for the full (all elements) report.
FULL_REPORT_MARK = "*"


def _as_date(value: dt.date | str) -> Column:
    return F.lit(value if isinstance(value, str) else value.isoformat()).cast("date")


def _date_col(reports: DataFrame, date_col: str) -> Column:
    return F.col(date_col).cast("date")


def _wants_full(rse: str | None) -> bool:
    return rse is not None and rse.startswith(FULL_REPORT_MARK)


def latest_reports(reports: DataFrame, as_of: dt.date | str, back: int = DEFAULT_BACK_DAYS, ahead: int = 0,
                   rse: str | None = None, date_col: str = "date", rse_col: str | None = "rse",
                   index: DataFrame | None = None, full: DataFrame | None = None) -> DataFrame:
    """Rows of the newest report dated within ``[as_of - back, as_of + ahead]``.

    Per-element reports (``rse_col``): the newest of each element, or of the one
    named by ``rse``; elements without a report in the window have no rows.
    Whole reports (``rse_col=None``: lost files, suspicious files, the full
    listing): the one newest report, all of its rows and no others.
    ``rse`` starting with ``*`` asks for the full listing: its newest report is
    taken from ``full``, and ``reports`` is not read.

    ``index`` (``sources.reports.existing_reports``, of the reports that are
    read) decides which reports exist from the files on disk, so a newest
    report that is empty wins (and yields no rows) as in the original lookup;
    without it a report exists when it has rows. With an index the rows of
    dates that are no element's newest are pruned by directory, those of other
    elements too if ``rse`` is given, and no row is shuffled: the newest dates
    are a small table, broadcast behind its size check.
    """
    if _wants_full(rse):
        if full is None:
            raise ValueError(f"{rse!r} asks for the full listing: pass its reports as full")
        reports, rse, rse_col = full, None, None
    anchor = _as_date(as_of)

    def in_window(df: DataFrame) -> DataFrame:
        day = _date_col(df, date_col)
        out = df.filter((day >= F.date_sub(anchor, back)) & (day <= F.date_add(anchor, ahead)))
        return out.filter(F.col(rse_col) == rse) if rse is not None else out

    window = in_window(reports)
    known = in_window(index) if index is not None else window
    if rse_col is None or rse is not None:
        return window.filter(_date_col(window, date_col) == known.agg(F.max(_date_col(known, date_col))).scalar())
    newest = known.groupBy(F.col(rse_col).alias("_rse_of")).agg(F.max(_date_col(known, date_col)).alias("_newest"))
    if index is not None:
        if fits(newest):
            newest = F.broadcast(newest)
        # at most one value per day of the window: a static partition filter
        dates = [r[0] for r in newest.select("_newest").distinct().collect()]
        window = window.filter(_date_col(window, date_col).isin(dates))
    keys = (F.col(rse_col) == F.col("_rse_of")) & (_date_col(window, date_col) == F.col("_newest"))
    return window.join(newest, keys, "left_semi")


def window_dates(as_of: dt.date | str, back: int = DEFAULT_BACK_DAYS, ahead: int = 0) -> list[str]:
    """The ``yyyy-MM-dd`` dates of a lookup window, newest first (for ``existing_reports``)."""
    anchor = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return [(anchor + dt.timedelta(days=k)).isoformat() for k in range(ahead, -back - 1, -1)]


def report_slice(reports: DataFrame, date: dt.date | str, rse: str | None = None, date_col: str = "date",
                 rse_col: str = "rse", full: DataFrame | None = None) -> DataFrame:
    """Rows of the report of ``date``; of one element if ``rse`` names it.

    ``rse`` starting with ``*`` asks for the full listing of that date, taken from ``full``.
    """
    if _wants_full(rse):
        if full is None:
            raise ValueError(f"{rse!r} asks for the full listing: pass its reports as full")
        return full.filter(_date_col(full, date_col) == _as_date(date))
    rows = reports.filter(_date_col(reports, date_col) == _as_date(date))
    return rows if rse is None else rows.filter(F.col(rse_col) == rse)
