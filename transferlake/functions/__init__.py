from transferlake.functions.columns import (  # noqa: F401
    epoch_seconds_of_ntz,
    epoch_to_instant,
    instant_to_ntz,
    lenient_amount,
    lenient_long,
    money,
    normalise_id,
    normalise_status,
    ntz_to_instant,
    parse_amount,
    strip_ws,
)
