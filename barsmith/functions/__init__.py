"""Column -> Column expressions. Everything here is a built-in Spark
expression, so it stays inside whole-stage codegen."""

from barsmith.functions.timefmt import (  # noqa: F401
    as_of_date, epoch_seconds, epoch_to_ist_date, epoch_to_ist_iso, ist_wall_time,
    candle_window_text, option_window_text,
)
from barsmith.functions.numbers import to_double, to_long, empty_to_null_double  # noqa: F401
from barsmith.functions.variants import (  # noqa: F401
    variant_double, variant_empty_to_null, variant_kind, variant_long,
)
from barsmith.functions.text import (  # noqa: F401
    first_non_empty, strip_ws, matches_keywords, combined_text,
)
from barsmith.functions.options import (  # noqa: F401
    atm_strike, moneyness, guarded_moneyness, stored_atm, strike_offset,
)
from barsmith.functions.dates import bisect_leaves, bisect_mid, date_windows  # noqa: F401
from barsmith.functions.triage import classify_response  # noqa: F401
