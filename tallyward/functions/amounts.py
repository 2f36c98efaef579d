"""Amount features, rule score and small numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward import schemas as S


# Amounts are added up in billionths, as whole numbers: sums do not depend on the order of rows. A number of billionths is
# kept in two parts, high * LIMB + low, so that sums of squares fit whole numbers as well. Doubles at or beyond the
# limit are more than an eighth apart; they count as unreadable.
UNITS = 1_000_000_000
LIMB = 10**12
LIMIT = 1e15


def in_range(amount: Column) -> Column:
    """Finite and within the limit; null for a null amount."""
    return ~F.isnan(amount) & (F.abs(amount) < F.lit(LIMIT))


def limbs(amount: Column) -> tuple[Column, Column]:
    """The two parts as longs; null where the amount is not in range."""
    step = float(LIMB // UNITS)
    high = F.floor(amount / step)
    low = F.rint((amount - high * step) * float(UNITS))
    return F.when(in_range(amount), high.cast("long")), F.when(in_range(amount), low.cast("long"))


def units(amount: Column) -> Column:
    """Whole billionths; null where the amount is not in range."""
    high, low = limbs(amount)
    return (high.cast("decimal(13,0)") * F.lit(LIMB).cast("decimal(13,0)") + low).cast("decimal(26,0)")


def mean_of(total: Column, n: Column) -> Column:
    """Mean of an exact total in billionths. Divides whole numbers, so that equal amounts have exactly
    themselves as their mean and are never a hair away from it."""
    rest = total % n
    return (((total - rest) / n).cast("double") + rest.cast("double") / n) / UNITS


def flag(condition: Column) -> Column:
    """0/1, a null condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def to_number(text: Column) -> Column:
    """Numeric text to double; other text, what is not finite or out of range to null."""
    number = text.try_cast("double")
    return F.when(in_range(number), number)


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


# Two meanings of the same five features: "batch" is what a model is trained on,
# "extractor" is what a lookup of earlier statistics gives for one new record.


def zscore(amount: Column, avg: Column, std: Column, mode: str = "batch") -> Column:
    off = amount - avg
    flat = off if mode == "batch" else F.lit(0.0)
    return F.when(std > 0, off / std).otherwise(flat)


def max_ratio(amount: Column, largest: Column, mode: str = "batch") -> Column:
    return F.when(largest > 0, amount / largest).otherwise(F.lit(0.0 if mode == "batch" else 1.0))


def unusual(amount: Column, avg: Column, std: Column, mode: str = "batch") -> Column:
    if mode == "batch":
        return flag((amount > avg + 2 * std) | (amount < avg - 2 * std))
    return flag((std > 0) & (F.abs(zscore(amount, avg, std, mode)) > 2))


def new_user(count: Column) -> Column:
    return flag(count <= 3)


def largest(amount: Column, largest_so_far: Column) -> Column:
    return flag(amount >= largest_so_far * F.lit(0.95))


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null: ``least`` and ``greatest`` alone would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def rule_score(amount: Column, is_vpn: Column, location_risk: Column, status: Column) -> Column:
    """Weighted rule score, at most 1, without a lower bound."""
    score = (
        (or_default(amount, 0.0) / 1000) * 0.3
        + flag(is_vpn) * 0.2
        + location_risk * 0.3
        + flag(status == "declined") * 0.2
    )
    return F.least(F.lit(1.0), score)


def device_code(device: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in S.DEVICE_CODES.items() for x in pair])
    return F.coalesce(known[F.coalesce(device, F.lit("unknown"))], F.lit(S.DEVICE_CODES["unknown"]))


def exact(value: Column) -> Column:
    """Stored form of a float: the decimal its shortest text names."""
    return value.cast("decimal(38,18)")
