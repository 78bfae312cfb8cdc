"""Column expressions. Every function takes and returns ``Column`` objects and
stays inside Spark's built-in (codegen'd) functions — no Python UDFs."""

from offblock.functions.datetime import (  # noqa: F401
    cyclical_pair,
    delay_seconds,
    epoch_seconds,
    format_mdy_hm,
    format_hh_mm,
    parse_iso_datetime,
    parse_mdy_hm,
    standardize_datetime_text,
    truncate_to_second,
)
from offblock.functions.geo import haversine_m, log_distance  # noqa: F401
from offblock.functions.numeric import impact_direction, impact_tone, round_half_even, seconds_to_minutes  # noqa: F401
from offblock.functions.text import (  # noqa: F401
    bump_id,
    compose_id,
    digits_to_int,
    flag_helicopter,
    flag_private,
    text_or_nan,
    trim_text,
)
