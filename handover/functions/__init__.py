from handover.functions.scalars import (  # noqa: F401
    COST_MARK,
    DEFAULT_COUNTRY,
    MONEY,
    PERCENT_MARK,
    TOTAL_MARK,
    customer_code,
    epoch_digits_to_ts,
    epoch_millis,
    epoch_seconds,
    int_div,
    is_blank,
    json_object,
    ntz_lit,
    money_to_units,
    parse_money,
    parse_percent_int,
    round_half_up_div,
    shift_years,
    strict_money,
    units_to_double,
)
