"""Column expressions of the staging layer: hash keys, hash diffs, typed casts.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType

ColLike = Column | str

# Fixed values of the warehouse's time model: open end of an interval, low
# bound of an extract window, and the far end one mart view compares with.
OPEN_END = "2999-12-31 00:00:00"
LOW_END = "1900-01-01 00:00:00"
FAR_END = "9999-12-31 00:00:00"
KEY_SEPARATOR = ":"

MONEY = DecimalType(18, 2)


def _col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str) -> Column:
    return F.lit(value).cast(TimestampNTZType())


def open_end() -> Column:
    return ts_lit(OPEN_END)


def _norm(c: ColLike) -> Column:
    return F.trim(F.coalesce(_col(c).cast("string"), F.lit("")))


def hash_key(c: ColLike) -> Column:
    """Business hash key: upper-case hex MD5 of the trimmed, upper-cased id (NULL hashes as '')."""
    return F.upper(F.md5(F.upper(_norm(c))))


def composite_hash(cols: Sequence[ColLike]) -> Column:
    """Link key / hash diff: parts trimmed, NULL as '', joined by ':', upper, MD5, upper."""
    return F.upper(F.md5(F.upper(F.concat_ws(KEY_SEPARATOR, *[_norm(c) for c in cols]))))


def md5_concat_ws(cols: Sequence[ColLike]) -> Column:
    """Lower-case MD5 over ':'-joined parts; NULL parts are skipped (not hashed as '')."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_col(c) for c in cols]))


def md5_coalesce(c: ColLike) -> Column:
    return F.md5(F.coalesce(_col(c), F.lit("")))


def optional_hash_key(ref_id: ColLike, own_id: ColLike) -> Column:
    """Key of a self reference: only when the referenced id differs from the own id (NULL otherwise)."""
    return F.when(_col(ref_id) != _col(own_id), hash_key(ref_id))


_PAD = 18  # zero bytes after text that is not an MD5, so that no packed form has the length of another kind


def pack(c: ColLike) -> Column:
    """Hex MD5 text as its 16 bytes (upper case; one byte more for lower case), any other text as its bytes and a pad.

    One to one, and in the order of the texts of each kind. Exchanges move hash columns in this form: half the bytes of
    the text, which a fast codec cannot compress."""
    v = _col(c)
    raw = F.unhex(v)
    text = F.when(F.length(v) == 32, F.hex(raw))
    return (
        F.when(text == v, raw)
        .when(F.lower(text) == v, F.concat(raw, F.lit(bytearray(b"\x01"))))
        .otherwise(F.concat(v.cast("binary"), F.lit(bytearray(_PAD))))
    )


def unpack(c: ColLike) -> Column:
    """The text of a packed column."""
    p = _col(c)
    size = F.length(p)
    return (
        F.when(size == 16, F.hex(p))
        .when(size == 17, F.lower(F.hex(F.substring(p, 1, 16))))
        .otherwise(F.substring(p, F.lit(1), size - _PAD).cast("string"))
    )


def packed(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: pack(c) for c in cols})


def unpacked(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: unpack(c) for c in cols})


def blank_to_null(c: ColLike) -> Column:
    return F.nullif(_col(c), F.lit(""))


def to_ts(c: ColLike, lenient: bool = False) -> Column:
    v = blank_to_null(c)
    return v.try_cast(TimestampNTZType()) if lenient else v.cast(TimestampNTZType())


def to_date(c: ColLike, lenient: bool = False) -> Column:
    v = blank_to_null(c)
    return v.try_cast(DateType()) if lenient else v.cast(DateType())


def to_int(c: ColLike, lenient: bool = False) -> Column:
    v = blank_to_null(c)
    return v.try_cast(IntegerType()) if lenient else v.cast(IntegerType())


def to_money(c: ColLike, lenient: bool = False) -> Column:
    v = blank_to_null(c)
    return v.try_cast(MONEY) if lenient else v.cast(MONEY)


def ts_text(c: ColLike) -> Column:
    """Timestamp as source text, the format the extracts carry."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def open_as_null(c: ColLike) -> Column:
    """Present the open end as NULL (the sentinel does not fit a pandas timestamp)."""
    return F.nullif(_col(c), open_end())
