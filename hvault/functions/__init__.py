from hvault.functions.keys import (  # noqa: F401
    FAR_END,
    LOW_END,
    MONEY,
    OPEN_END,
    blank_to_null,
    composite_hash,
    hash_key,
    md5_coalesce,
    md5_concat_ws,
    open_as_null,
    open_end,
    optional_hash_key,
    to_date,
    to_int,
    to_money,
    to_ts,
    ts_lit,
    ts_text,
)
from hvault.functions.numeric import half_up_units, idiv, money_units, ratio, units_to_decimal  # noqa: F401


def roundup_amount(amount, tail_limit):
    """Round-up posting of a purchase under a tail limit.

    The posting rounds ``amount + limit`` down to a multiple of ten and books
    the difference: limit 47 turns 52 into 90 (38 booked) and 53 into 100 (47).
    """
    from pyspark.sql import functions as F

    return (F.floor((amount + tail_limit) / 10) * 10 - amount).cast(MONEY)
