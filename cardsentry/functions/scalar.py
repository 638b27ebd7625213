"""Per-row expressions over amount, time, place and person columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
NIGHT_FROM, NIGHT_UNTIL = 22, 6
DAYS_PER_YEAR = 365.25
# Right edges and names of the age groups; the first group starts at 17.
AGE_START = 17
AGE_GROUPS = [(30, "18-30"), (45, "31-45"), (60, "46-60"), (150, "60+")]


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def log_amount(amt: Column) -> Column:
    return F.log1p(amt.cast("double"))


def amount_decimal(amt: Column) -> Column:
    # pmod keeps the sign of the divisor: -1.25 gives 0.75
    return F.pmod(amt.cast("double"), F.lit(1.0))


def is_round_amount(amt: Column) -> Column:
    return F.coalesce((amt.cast("double") == F.round(amt.cast("double"))).cast("int"), F.lit(0))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: Column) -> Column:
    return ((F.hour(ts) >= NIGHT_FROM) | (F.hour(ts) < NIGHT_UNTIL)).cast("int")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2) - F.radians(lat1), F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), F.lit(2.0)
    )
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    # least() ignores nulls, hence the guard
    return F.when(known, F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0)))))


def differs(a: Column, b: Column) -> Column:
    """1 when the texts differ; two nulls are equal."""
    return (~a.eqNullSafe(b)).cast("int")


def age_years(ts: Column, dob: Column) -> Column:
    return F.datediff(ts, dob) / F.lit(DAYS_PER_YEAR)


def age_group(age: Column, include_lowest: bool = True) -> Column:
    start = (age >= AGE_START) if include_lowest else (age > AGE_START)
    out = None
    for upper, name in AGE_GROUPS:
        out = F.when(start & (age <= upper), name) if out is None else out.when(start & (age <= upper), name)
    return out


def age_group_code(group: Column) -> Column:
    code = None
    for i, (_, name) in enumerate(AGE_GROUPS):
        code = F.when(group == name, i) if code is None else code.when(group == name, i)
    return code.otherwise(-1)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def clip_unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def stable_hash(col: Column) -> Column:
    """A 32-bit number that other SQL engines can reproduce: the first 8 hex digits of the md5 of the text."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long")
