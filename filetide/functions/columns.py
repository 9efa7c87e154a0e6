"""Column rules: unsigned ranges, times, buckets, the content id and the operation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32_MAX = (1 << 32) - 1
U16_MAX = (1 << 16) - 1
# First and last second that the table's millisecond time type holds: 1900-01-01 and 2299-12-31 23:59:59.
FIRST_SECOND, LAST_SECOND = -2208988800, 10413791999

RFC3339 = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unsigned(c: Column | str, bits: int = 64) -> Column:
    """Saturating conversion: negatives become 0, too large becomes the maximum."""
    floor = F.greatest(col(c).cast("bigint"), F.lit(0).cast("bigint"))
    if bits == 64:
        return floor
    top = {32: U32_MAX, 16: U16_MAX}[bits]
    return F.least(floor, F.lit(top).cast("bigint"))


def low_byte(c: Column | str) -> Column:
    """Saturate to 32 bits, then keep the low 8: 256 becomes 0, not 255."""
    return unsigned(c, 32).bitwiseAND(F.lit(255)).cast("int")


def unix_time(c: Column | str) -> Column:
    """Unix seconds to a timestamp; absent or negative is the epoch."""
    return F.timestamp_seconds(F.least(unsigned(c), F.lit(LAST_SECOND)))


def parse_rfc3339(c: Column | str) -> Column:
    """Timestamp for a strictly RFC 3339 string, otherwise NULL."""
    text = col(c)
    return F.when(text.rlike(RFC3339), text.try_cast("timestamp"))


def milliseconds(c: Column | str) -> Column:
    return F.date_trunc("MILLISECOND", col(c))


def event_time(timestamp: Column, end_time: Column, start_time: Column, received: Column) -> Column:
    """The message's own time, else its close time, else its open time, else when it arrived; kept
    within the range of the table's type, whichever it is."""
    zero = F.lit("0001-01-01T00:00:00Z").cast("timestamp")
    time = F.coalesce(
        F.nullif(timestamp, zero),
        F.when(end_time > 0, unix_time(end_time)),
        F.when(start_time > 0, unix_time(start_time)),
        received,
    )
    last = F.timestamp_micros(F.lit(LAST_SECOND * 1_000_000 + 999_000))
    return milliseconds(F.least(F.greatest(time, F.timestamp_seconds(F.lit(FIRST_SECOND))), last))


def operation(written: Column | str = "write") -> Column:
    return F.when(col(written) > 0, F.lit("write")).otherwise(F.lit("read"))


def bucket(c: Column | str, grain: str) -> Column:
    """Calendar bucket: a timestamp for ``hour``, a date for ``day`` and coarser."""
    if grain == "hour":
        return F.date_trunc("hour", col(c))
    if grain == "day":
        return F.to_date(col(c))
    return F.to_date(F.date_trunc(grain, col(c)))


def _little_endian(c: Column) -> Column:
    """16 hex digits of a 64-bit integer, lowest byte first, by swapping halves three times."""
    x = c.cast("bigint")
    for shift, mask in ((8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        low = F.lit(mask).cast("bigint")
        x = F.shiftleft(x.bitwiseAND(low), shift).bitwiseOR(
            F.shiftrightunsigned(x, shift).bitwiseAND(low))
    x = F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))
    return F.lpad(F.hex(x), 16, "0")


def event_id(texts: list[Column], numbers: list[Column]) -> Column:
    """First 128 bits, in hex, of SHA-256 over NUL-terminated texts and little-endian integers."""
    nul = F.unhex(F.lit("00"))
    parts = [part for t in texts for part in (F.encode(t, "UTF-8"), nul)]
    digits = F.unhex(F.concat(*[_little_endian(n) for n in numbers]))
    return F.substring(F.sha2(F.concat(*parts, digits), 256), 1, 32)


def short_id(c: Column | str) -> Column:
    """A content id as 16 bytes instead of 32 digits, and any other text behind 17 NULs, which make it longer:
    equal for equal texts only."""
    text = col(c)
    digits = F.unhex(text)
    return F.when((F.length(digits) == 16) & (F.lower(F.hex(digits)) == text), digits).otherwise(
        F.concat(F.unhex(F.lit("00" * 17)), F.encode(text, "UTF-8")))


def body_hash(raw_json: Column | str) -> Column:
    """Short stand-in for the message body, so tie-breaks need not read the body itself."""
    return F.xxhash64(col(raw_json))
