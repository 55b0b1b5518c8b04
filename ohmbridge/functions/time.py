"""Dates and instants as Column expressions, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
_PARTS = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2}(?:\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?$"
#: What most instants look like: they need no taking apart.
_PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"
#: Patterns of date-only texts, tried in this order: dotted is day first, slashed is month first.
DATE_PATTERNS = ("d.M.yyyy", "d.M.yy", "M/d/yyyy", "M/d/yy", "yyyy-M-d", "yyyy/M/d")
#: The usual texts with a time of day, read in the default zone: a quick way past the reader of all forms, to the same result.
TIME_PATTERNS = ("M/d/yyyy H:mm:ss", "yyyy-M-d H:mm:ss", "M/d/yyyy H:mm", "yyyy-M-d H:mm", "M/d/yy H:mm:ss", "M/d/yy H:mm")
#: Names of months; three letters, and SEPT, count too.
MONTHS = ("JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER")
#: A time of day anywhere in a text: hour, minute, second, fraction, A or P twice (with minutes, without), offset.
_CLOCK = r"(?:^|(?<=[\sT,]))(\d{1,2})(?::(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,9}))?)?(?:\s*([AP])\.?M\b\.?)?|\s*([AP])\.?M\b\.?)\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})?(?=$|[\s,])"
#: What says nothing about a date: weekdays, endings of ordinals, small words, the T before a time.
_IDLE = r"\b(?:MON|TUES?|WED(?:NES)?|THU(?:RS)?|FRI|SAT(?:UR)?|SUN)(?:DAY)?\b|(?<=\d)(?:ST|ND|RD|TH)\b|\b(?:AT|ON|OF)\b|(?<=\d)T(?=\s|$)"
_FORMS = r"^(?:\d{8}|\d{4} (?:\d{1,2}|[A-Z]{3,9}) \d{1,2}|(?:\d{1,2} \d{1,2}|[A-Z]{3,9} \d{1,2}|\d{1,2} [A-Z]{3,9}) (?:\d{4}|\d{2}))$"


def instant(c: Column) -> Column:
    """The instant of an ISO text, a missing offset read as UTC; null for anything else."""
    t = F.trim(c)
    date, time, rest, offset = (F.regexp_extract(t, _PARTS, k) for k in range(1, 5))
    text = F.concat(date, F.lit("T"), F.when(time == "", F.lit("00:00")).otherwise(time), F.when(rest == "", F.lit(":00")).otherwise(rest), F.when(offset == "", F.lit("Z")).otherwise(offset))
    return F.when(t.rlike(_PLAIN), t.try_cast("timestamp")).when(t.rlike(_PARTS), text.try_cast("timestamp"))


def has_offset(c: Column) -> Column:
    return F.regexp_extract(F.trim(c), _PARTS, 4) != ""


def _wall(text: Column, patterns: tuple[str, ...]) -> Column:
    """The wall-clock time as text 'yyyy-MM-ddTHH:mm:ss', by the first pattern that fits; two-digit years from 1969 to 2068."""
    def read(p: str) -> Column:
        got = F.date_format(F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss")
        if "yyyy" not in p:
            got = let(got, lambda g: F.when(F.substring(g, 3, 2) > "68", F.concat(F.lit("19"), F.substring(g, 3, 17))).otherwise(g))
        return F.when(text.rlike(_shape(p)), got)

    return F.coalesce(*(read(p) for p in patterns))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _shape(pattern: str) -> str:
    """Digits and marks that a text of the pattern has; keeps readers of two-digit years from four-digit ones."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        n = len(pattern) - len(pattern[i:].lstrip(ch)) - i if ch.isalpha() else 1
        if ch == "'":
            end = pattern.index("'", i + 1)
            out, i = out + pattern[i + 1 : end], end + 1
            continue
        if ch == "y":
            out += rf"\d{{{n}}}"
        elif ch == "M" and n >= 3:
            out += "[A-Za-z]+"
        elif ch == "a":
            out += "[AaPp][Mm]"
        elif ch == "S":
            out += rf"\d{{{n}}}"
        elif ch.isalpha():
            out += r"\d{1,2}" if n == 1 else rf"\d{{{n}}}"
        else:
            out += "\\" + ch if ch in "./" else ch
        i += n
    return f"^{out}$"


def offset_text(wall: Column, zone: str) -> Column:
    """+hh:mm of a wall-clock time in a zone."""
    local = F.concat(wall, F.lit("Z")).try_cast("timestamp")
    minutes = (F.unix_micros(local) - F.unix_micros(F.to_utc_timestamp(local, zone))) / F.lit(60_000_000)
    size = F.abs(minutes).cast("int")
    return F.concat(F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")), F.format_string("%02d:%02d", (size / 60).cast("int"), size % 60))


def _century(y: Column) -> Column:
    """Two-digit years lie from 1969 to 2068, whatever the day is."""
    return F.when(F.length(y) > 2, y.try_cast("int")).otherwise(y.try_cast("int") + F.when(y > "68", 1900).otherwise(2000))


def _date(rest: Column) -> Column:
    """A struct y, m, d of a text without its time of day: year first, or month first where that can be; null beyond the known forms."""
    names = F.create_map(*(F.lit(v) for k, name in enumerate(MONTHS, 1) for n in sorted({name, name[:3]} | ({"SEPT"} if k == 9 else set())) for v in (n, k)))

    def read(r: Column) -> Column:
        w = F.when(r.rlike(r"^\d{8}$"), F.array(F.substring(r, 1, 4), F.substring(r, 5, 2), F.substring(r, 7, 2))).otherwise(F.split(r, " "))

        def order(w: Column) -> Column:
            a, b, c = (F.get(w, F.lit(k)) for k in range(3))
            first, named = a.rlike(r"^\d{4}$"), b.rlike("^[A-Z]")
            y, m = F.when(first, a).otherwise(c), F.when(first | named, b).otherwise(a)
            d = F.when(first, c).when(named, a).otherwise(b)
            number = F.coalesce(F.try_element_at(names, m), m.try_cast("int"))
            swap = m.rlike(r"^\d") & (number > 12)
            return F.struct(_century(y).alias("y"), F.when(swap, d.try_cast("int")).otherwise(number).alias("m"), F.when(swap, number).otherwise(d.try_cast("int")).alias("d"))

        return F.when(r.rlike(_FORMS), let(w, order))

    return let(F.trim(F.regexp_replace(F.regexp_replace(rest, _IDLE, " "), r"[\s,./-]+", " ")), read)


def _free(t: Column, zone: str) -> Column:
    """ISO text, with an offset, of a date in figures or words and a time of day beside it; midnight without one.

    Only whole dates count: what leaves out a day, month or year, or says anything
    besides, is null. So are names of zones other than UTC and GMT.
    """
    cut = F.split(F.regexp_replace(t, f"^(.*?){_CLOCK}(.*)$", "$1 $9\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6$7\u0001$8"), "\u0001")

    def read(p: Column) -> Column:
        part = lambda k: F.coalesce(F.get(p, F.lit(k)), F.lit(""))
        figure = lambda k: F.when(part(k) == "", F.lit(0)).otherwise(part(k).try_cast("int"))
        hour, half = figure(1), part(5)
        hour = F.when(half == "", hour).when(hour <= 12, hour % 12 + F.when(half == "P", 12).otherwise(0))
        micros = F.rpad(F.substring(part(4), 1, 6), 6, "0")
        fraction = F.when(micros.try_cast("int") > 0, F.concat(F.lit("."), micros)).otherwise(F.lit(""))
        wall = let(_date(part(0)), lambda d: F.when(d.isNotNull(), F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", d["y"], d["m"], d["d"], hour, figure(2), figure(3))))
        said = part(6)
        given = F.when(said.isin("Z", "UTC", "GMT"), F.lit("+00:00")).when(said != "", F.concat(F.substring(said, 1, 3), F.lit(":"), F.right(said, F.lit(2))))
        return let(wall, lambda w: F.when(w.try_cast("timestamp_ntz").isNotNull(), F.concat(w, fraction, F.coalesce(given, offset_text(w, zone)))))

    return let(cut, read)


def lenient(c: Column, zone: str) -> Column:
    """ISO text of a date or time in any of the known forms, null if none fits.

    Date-only forms in figures have no offset: they stay wall-clock times at
    midnight. All others get the zone's offset at that time; ISO texts keep their own.
    """
    def read(t: Column) -> Column:
        iso = F.when(has_offset(t) & instant(t).isNotNull(), F.regexp_replace(F.regexp_replace(F.regexp_replace(t, " ", "T"), "Z$", "+00:00"), r"(T\d{2}:\d{2})([+-])", "$1:00$2"))
        timed = let(_wall(t, TIME_PATTERNS), lambda w: F.concat(w, offset_text(w, zone)))
        return F.coalesce(_wall(t, DATE_PATTERNS), iso, timed, _free(t, zone))

    # a plain instant keeps its text but for the Z; without a figure no form fits: neither needs the reader of all forms
    said = F.upper(F.trim(c))
    plain = F.when(said.rlike(_PLAIN) & said.try_cast("timestamp").isNotNull(), F.when(F.endswith(said, F.lit("Z")), F.concat(F.substr(said, F.lit(1), F.length(said) - 1), F.lit("+00:00"))).otherwise(said))
    return F.coalesce(plain, F.when(said.rlike(r"\d"), let(said, read)))


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def lag_days(seen: Column, happened: Column) -> Column:
    """Days from an event to its report, zero at least."""
    return F.greatest(F.lit(0.0), (F.unix_micros(seen) - F.unix_micros(happened)) / F.lit(86_400_000_000.0))
