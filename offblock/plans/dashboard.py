"""Dashboard data steps (no UI): the reference's demo cards as one DataFrame chain.

R06 literal (or any table of the same shape) -> R09 renames -> R53 trim ->
R54 parse -> R55 seconds to minutes -> R24 runway base minutes -> R38 first n
-> R58 HH:MM -> R36/R59 ranked drivers. Every step is a projection except the
head (a top-n) and the ranking (sorted inside each row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.constants import CATEGORY_ORDER
from offblock.functions.datetime import format_hh_mm, parse_iso_datetime
from offblock.functions.numeric import seconds_to_minutes
from offblock.functions.text import trim_text
from offblock.operators.joins import lookup_default
from offblock.operators.report import rank_drivers
from offblock.operators.sampling import head_n
from offblock.operators.schema import q, rename

DEMO_RENAMES = {"Departure Time": "Departure time", "Flight Number": "Flight"}


def dashboard_cards(df: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(cards, drivers): one card per flight (first ``n`` by departure, flight) and its ranked drivers."""
    d = rename(df, DEMO_RENAMES)
    d = d.withColumns({
        "Flight": trim_text(q("Flight")),
        "Departure time": parse_iso_datetime(q("Departure time")),
        "Predicted taxi time (min)": seconds_to_minutes(q("Predicted Taxi Time (s)")),
    })
    d = lookup_default(d, "Runway", "Runway base (min)")
    top = head_n(d, n, ["Departure time", "Flight"])
    cards = top.select("Flight", "Stand", "Runway", format_hh_mm(q("Departure time")).alias("Departure"),
                       "Predicted taxi time (min)", "Runway base (min)", *[q(c) for c in CATEGORY_ORDER])
    drivers = rank_drivers(top, ["Flight"], CATEGORY_ORDER)
    return cards, drivers
