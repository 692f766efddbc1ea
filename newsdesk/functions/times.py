"""Time normalisation: UTC in, Japan time out, five string shapes at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone names, string shapes and the rank given to date tags.
ZONE = "Asia/Tokyo"
OFFSET = "+09:00"
POST_SHAPE = "yyyy-MM-dd_HH:mm:ss"
ISO_SHAPE = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICRO_SHAPE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
COMPACT_SHAPE = "yyyyMMddHHmm"
DATE_TAG_RANK = 99


def day(ts: Column) -> Column:
    """Midnight of a zone-less timestamp, still zone-less."""
    return F.to_date(ts).cast("timestamp_ntz")


def utc_to_jst(ts: Column) -> Column:
    """Zone-less UTC timestamp to zone-less Japan time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(ZONE), ts)


def utc_to_jst_text(ts: Column) -> Column:
    """UTC timestamp to `yyyy-MM-dd_HH:mm:ss` in Japan time; the sub-second part is dropped."""
    return F.date_format(utc_to_jst(ts), POST_SHAPE)


def iso_to_jst(text: Column) -> Column:
    """ISO text with a zone to ISO text at +09:00; a text without zone counts as UTC.

    Microseconds are written only where they are not zero. Unreadable text gives NULL.
    """
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    instant = F.try_to_timestamp(zoned)
    local = F.convert_timezone(F.current_timezone(), F.lit(ZONE), instant.cast("timestamp_ntz"))
    whole = F.pmod(F.unix_micros(instant), F.lit(1_000_000)) == 0
    shaped = F.when(whole, F.date_format(local, ISO_SHAPE)).otherwise(F.date_format(local, ISO_MICRO_SHAPE))
    return F.concat(shaped, F.lit(OFFSET))


def snapshot_time(at: Column | None = None) -> Column:
    """The time stamped on a batch in Japan time; pass `at` (UTC) to keep reruns reproducible."""
    if at is None:
        at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return utc_to_jst(at)


def to_compact(ts: Column) -> Column:
    """Timestamp to `yyyyMMddHHmm`."""
    return F.date_format(ts, COMPACT_SHAPE)


def compact_to_iso(text: Column) -> Column:
    """`yyyyMMddHHmm` to ISO text at +09:00."""
    parsed = F.try_to_timestamp(text, F.lit(COMPACT_SHAPE))
    return F.concat(F.date_format(parsed, ISO_SHAPE), F.lit(OFFSET))


def post_time_to_iso(text: Column) -> Column:
    """`yyyy-MM-dd_HH:mm:ss` to the date text of a published post."""
    return F.concat(F.translate(text, "_", "T"), F.lit(f".000{OFFSET}"))


def date_tag_names(ts: Column) -> Column:
    """Array of the year, month and day tag of a timestamp."""
    return F.array(
        F.concat(F.lit("@"), F.date_format(ts, "yyyy"), F.lit("年")),
        F.concat(F.lit("@"), F.date_format(ts, "MM"), F.lit("月")),
        F.concat(F.lit("@"), F.date_format(ts, "MM"), F.lit("月"), F.date_format(ts, "dd"), F.lit("日")),
    )


def date_tags(ts: Column) -> Column:
    """Map from date tag to its fixed rank."""
    return F.map_from_arrays(date_tag_names(ts), F.array_repeat(F.lit(DATE_TAG_RANK), 3))
