"""Parsing, stamping, sharding and formatting expressions. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text with anything but digits behind its time of day: a zone, or what makes the whole unreadable.
_ZONED = r":\d{1,2}(\.\d+)?\s*[^\d\s.:].*$"
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: Column | str) -> Column:
    """Whole number in text; anything else, ``3226.0`` included, is null."""
    return F.trim(_col(c).cast("string")).try_cast("bigint")


def parse_number(c: Column | str) -> Column:
    """Number in text, as a whole number; a fraction or anything else is null."""
    number = F.trim(_col(c).cast("string")).try_cast("double")
    whole = number.try_cast("bigint")
    # A plain integer keeps all its digits, which a double would round.
    return F.coalesce(parse_int(c), F.when(whole.cast("double") == number, whole))


def _month(name: Column) -> Column:
    """Number of a month given by name, as text of two digits; ``xx`` for none."""
    place = F.instr(F.lit(_MONTHS), F.initcap(F.substring(name, 1, 3))) + 2
    return F.when(F.pmod(place, F.lit(3)) == 0, F.lpad((place / 3).cast("int").cast("string"), 2, "0")).otherwise("xx")


# Date forms before a time of day: pattern, then which group is the year, the month and the day. Where a date begins with two
# small numbers the month comes first, unless it cannot be one.
_END = r"(?=$|[^\d/.-])"
_SLASHED = rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_END}"
_YEAR_FIRST = rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){_END}"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?=$|[T ]|\d{4}(?:\d{2})?$)"
_NAME_FIRST = r"^([A-Za-z]{3})[a-z]*\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})(?=$|\D)"
_DAY_FIRST = r"^(\d{1,2})(?:st|nd|rd|th)?[ -]([A-Za-z]{3})[a-z]*\.?,?[ -](\d{4})(?=$|\D)"
_WEEKDAY = r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? +"
_HALF_DAY = r"\b(\d{1,2})((?::\d{2}){0,2}(?:\.\d+)?) ?([AaPp])\.?[Mm]\.?$"


def _date_first(text: Column) -> Column:
    """Dates in other forms as ``yyyy-mm-dd``; what follows them stays."""
    group = lambda form, i: F.regexp_extract(text, form, i)
    rest = lambda form: F.regexp_replace(text, form, "")
    date = lambda year, month, day, form: F.concat(F.concat_ws("-", year, month, day), rest(form))
    one, two, year = group(_SLASHED, 1), group(_SLASHED, 3), group(_SLASHED, 4)
    # two digits: 1970 to 2069
    year = F.when(F.length(year) == 4, year).otherwise(F.concat(F.when(year < "70", "20").otherwise("19"), year))
    swapped = one.try_cast("int") > 12
    clock = F.regexp_replace(rest(_COMPACT), r"^[T ]?(\d{2})(\d{2})(\d{2})?$", " $1:$2:$3")
    return (F.when(text.rlike(_SLASHED), date(year, F.when(swapped, two).otherwise(one), F.when(swapped, one).otherwise(two), _SLASHED))
            .when(text.rlike(_YEAR_FIRST), date(group(_YEAR_FIRST, 1), group(_YEAR_FIRST, 2), group(_YEAR_FIRST, 3), _YEAR_FIRST))
            .when(text.rlike(_COMPACT), F.concat(F.concat_ws("-", *[group(_COMPACT, i) for i in (1, 2, 3)]), F.rtrim(clock, F.lit(":"))))
            .when(text.rlike(_NAME_FIRST), date(group(_NAME_FIRST, 3), _month(group(_NAME_FIRST, 1)), group(_NAME_FIRST, 2), _NAME_FIRST))
            .when(text.rlike(_DAY_FIRST), date(group(_DAY_FIRST, 3), _month(group(_DAY_FIRST, 2)), group(_DAY_FIRST, 1), _DAY_FIRST))
            .otherwise(text))


def _day_clock(text: Column) -> Column:
    """Hours of half days, with am or pm, as hours of the day."""
    hour = F.regexp_extract(text, _HALF_DAY, 1).try_cast("int")
    late = F.lower(F.regexp_extract(text, _HALF_DAY, 3)) == "p"
    of_day = F.when(hour.between(1, 12), hour % 12 + F.when(late, 12).otherwise(0))
    minutes = F.regexp_extract(text, _HALF_DAY, 2)
    whole = F.concat(F.regexp_replace(text, _HALF_DAY, ""), F.lpad(of_day.cast("string"), 2, "0"),
                     F.when(minutes == "", ":00").otherwise(minutes))
    return F.when(text.rlike(_HALF_DAY), whole).otherwise(text)


def parse_time_ms(c: Column | str) -> Column:
    """Epoch milliseconds of a time in text; without a zone it is UTC, whatever the session's zone.

    Null if unreadable, which an unknown zone is too. Text without a zone is read as a civil time, which looks no zone up.
    ``yyyy-MM-dd HH:mm:ss`` is told by its length and signs and cast at once; only other texts go through the forms.
    """
    text = F.trim(_col(c).cast("string"))
    plain = (F.length(text) == 19) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 14, 1) == ":") & (F.substring(text, 17, 1) == ":")
    # each step names the text of the one before once, so the expression does not grow with every use of it
    other = F.transform(F.transform(F.array(F.regexp_replace(text, _WEEKDAY, "")), _date_first), _day_clock)
    read = F.transform(other, lambda o: F.when(o.rlike(_ZONED), F.unix_millis(o.try_cast("timestamp")))
                       .otherwise(ntz_epoch_ms(o.try_cast("timestamp_ntz"))))
    return F.when(plain, ntz_epoch_ms(text.try_cast("timestamp_ntz"))).otherwise(F.get(read, F.lit(0)))


def ntz_epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds of a timestamp without zone, read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(c))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def shard_of(c: Column | str, n_shards: int) -> Column:
    """MD5 of the text as a 128-bit number, modulo ``n_shards``, folded 32 bits at a time."""
    digest = F.md5(_col(c).cast("binary"))
    shard = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        shard = F.pmod(shard * F.lit((1 << 32) % n_shards) + piece, F.lit(n_shards).cast("bigint"))
    return shard.cast("int")


def shard_label(prefix: str, shard: Column | str) -> Column:
    """Stream name: the prefix, then the shard number."""
    return F.concat(F.lit(prefix), _col(shard).cast("string"))


def series_key(prefix: str, shard: Column | str) -> Column:
    """Metric series name: prefix, a colon, the shard number."""
    return F.concat_ws(":", F.lit(prefix), _col(shard).cast("string"))


def dedupe_key(bike: Column | str = "bike_id", first: Column | str = "first_ts_ms",
               ended: Column | str = "b_ended_ms", end: Column | str = "b_end") -> Column:
    return F.concat_ws(":", F.lit("match"), F.lit("dedupe"),
                       *[_col(c).cast("string") for c in (bike, first, ended, end)])


def decode_text(c: Column | str) -> Column:
    return F.decode(_col(c), "UTF-8")


def local_time(ms: Column | str, zone: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Civil time in ``zone`` of an epoch in milliseconds, as text; free of the session's zone."""
    wall = F.make_timestamp_ntz(*[F.lit(v) for v in (1970, 1, 1, 0, 0, 0)]) \
        + F.make_dt_interval(secs=_col(ms) / F.lit(1000).cast("decimal(18,6)"))
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), wall), pattern)


def round2(c: Column | str) -> Column:
    return F.round(_col(c), 2)


def month_of_folder(c: Column | str) -> Column:
    """Month number of a folder named ``<n>_<Month>``, or ``<column>=<n>_<Month>`` as partitioned writes name it."""
    return F.split(F.regexp_replace(_col(c), "^[^=]*=", ""), "_").getItem(0).try_cast("int")
