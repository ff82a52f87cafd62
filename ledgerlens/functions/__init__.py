"""Column expressions built from Spark's own functions (no UDFs)."""

from ledgerlens.functions.numeric import (  # noqa: F401
    cents,
    int_div,
    mean_money,
    money_per,
    ratio_units,
    round_ratio,
    round_ratio_percent,
    to_double,
    units_to_double,
)
from ledgerlens.functions.temporal import (  # noqa: F401
    add_seconds,
    age_months,
    day_of,
    month_start,
    seconds_between,
)
