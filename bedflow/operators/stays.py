"""Per-patient stay days: the backfill of days already stayed (rate 1) and
the future days with their survival rate.

One patient row expands into both parts at once: two arrays (built with
``sequence`` + ``transform``) concatenated and inlined by a single Generate,
so the model is one join (patients x cohort curve) and one narrow expansion,
not a union of two re-computed branches.

``sequence(a, b)`` counts *down* when a > b, so every part is guarded by a
condition on its bounds, and every upper bound is capped by the horizon (or
``as_of``) first, so long-stay outliers cannot inflate the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.config import Params
from bedflow.functions.dates import months_after


def horizon_last_day(p: Params, admit_date: Column) -> Column:
    """Largest stay day d with admit_date + d - 1 < as_of + horizon."""
    return F.datediff(months_after(p.as_of, p.horizon_months), admit_date)


def stay_days(patients: DataFrame, last_day: Column, p: Params, keep: list[str],
              future: bool = True, backfill: bool = True) -> DataFrame:
    """Rows (keep..., stay_key_seq, stay_rate, stay_start_date, stay_end_date).

    ``patients`` has one row per stay with admit_date, beddeddays (days
    already stayed, f) and the cohort curve ``s``.  Future day d runs from f
    to ``last_day`` with rate S(d)/S(f), starting admit_date + d - 1; the rate
    is NULL where the curve has no survivors.  A stay with at least one future
    day is backfilled over every day in [admit_date, as_of - 1) with rate 1,
    numbered from 1 in day order.  No calendar bounds either part.
    """
    as_of = p.as_of.isoformat()
    pts = patients.withColumn("_last", last_day)
    has_future = "_last >= beddeddays"
    day = ("named_struct('stay_key_seq', CAST({seq} AS INT), 'stay_rate', CAST({rate} AS DOUBLE), "
           "'stay_start_date', {start})")
    parts = []
    if backfill:
        ok = f"{has_future} AND admit_date < DATE'{as_of}' - 1"
        parts.append(f"IF({ok}, transform(sequence(admit_date, DATE'{as_of}' - 2), (day, i) -> "
                     + day.format(seq="i + 1", rate="1.0", start="day") + "), array())")
    if future:
        rate = "try_element_at(s, d) / try_element_at(s, beddeddays)"
        parts.append(f"IF({has_future}, transform(sequence(beddeddays, _last), d -> "
                     + day.format(seq="d", rate=rate, start="date_add(admit_date, d - 1)") + "), array())")
    days = F.expr(parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})")
    return (pts.select(*keep, F.inline(days))
            .withColumn("stay_end_date", F.date_add("stay_start_date", 1)))
