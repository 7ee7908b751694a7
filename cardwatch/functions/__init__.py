from cardwatch.functions.expr import (  # noqa: F401
    fio, inf_ts, minus_one_second, null_safe_differs, ntz, ntz_lit, date_lit,
    trimmed, round_to_seconds,
)
