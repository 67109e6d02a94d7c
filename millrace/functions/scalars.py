"""Column expressions: coercion, bounds, money, severity, masking, formats."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the CSV readers take as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Severity limits on the highest 5xx rate.
CRITICAL_RATE = 0.30
HIGH_RATE = 0.15

# Fixed value: price above which a sale is flagged.
HIGH_PRICE = 100_000

# Fixed value: significance level of the hypothesis tests.
SIGNIFICANCE_LEVEL = 0.05

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DAY = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
WHOLE_KINDS = ("tinyint", "smallint", "int", "bigint")
_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_FOUR_OCTETS = rf"{_OCTET}(\.{_OCTET}){{3}}"
_HEX = "[0-9A-Fa-f]{1,4}"
# eight groups, or fewer with one "::" standing for the rest
_IPV6 = "|".join(
    [f"({_HEX}:){{7}}{_HEX}", f"({_HEX}:){{1,7}}:", f":((:{_HEX}){{1,7}}|:)"]
    + [f"({_HEX}:){{1,{7 - k}}}(:{_HEX}){{1,{k}}}" for k in range(1, 7)]
)


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    """Texts that stand for a missing value become NULL."""
    return F.when(~strip(text).isin(*MISSING_TEXTS), text)


def to_number(text: Column, kind: str = "double") -> Column:
    """Number of a text, NULL when it is not a plain decimal number.

    The guard keeps out forms such as ``1d`` that a Spark cast would accept. For a whole
    kind, ``3.0`` and ``1e3`` are whole numbers; ``2.5`` is none.
    """
    text = strip(text.cast("string"))
    number = F.when(text.rlike(_NUMBER), text)
    if kind not in WHOLE_KINDS:
        return number.try_cast(kind)
    plain = number.try_cast(kind)
    exact = number.try_cast("double")
    return F.when(number.rlike(r"^[+-]?\d+$"), plain).when(exact == F.rint(exact), exact.try_cast(kind))


def to_day(text: Column) -> Column:
    """Date of an ISO date or time, NULL when the whole text is none."""
    text = strip(text.cast("string"))
    day = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return F.when(text.rlike(_DAY) & text.try_cast("timestamp_ntz").isNotNull(), day)


def clip(value: Column, low: Column, high: Column) -> Column:
    """Value limited to [low, high]; a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def _held(value: Column, kind: str) -> Column:
    """Whether a decimal type holds the value with every digit."""
    return value.try_cast(kind).cast("double") == value.cast("double")


def discounted_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """``quantity * unit_price * (1 - discount)``, rounded once to two decimals, halves up.

    Multiplied in decimals when they hold all three inputs with every digit, as doubles otherwise.
    """
    kinds = {"quantity": "decimal(20,6)", "unit_price": "decimal(22,10)", "discount": "decimal(12,10)"}
    inputs = dict(zip(kinds, (quantity, unit_price, discount)))
    whole = F.lit(True)
    for name, kind in kinds.items():
        whole = whole & _held(inputs[name], kind)
    q, p, d = (value.try_cast(kinds[name]) for name, value in inputs.items())
    exact = F.round(F.try_multiply(F.try_multiply(q, p), F.lit(1).cast("decimal(1,0)") - d), 2).cast("double")
    plain = F.round(quantity.cast("double") * unit_price.cast("double") * (1.0 - discount.cast("double")), 2)
    return F.coalesce(F.when(whole, exact), plain)


def exact_sum(money: Column, scale: int = 10) -> Column:
    """Sum in decimals: the same result in whatever order partial sums meet."""
    return F.sum(money.cast(f"decimal(28,{scale})"))


def exact_mean(money: Column, scale: int = 10) -> Column:
    """Mean as exact sum over count, NULL for no values."""
    return F.try_divide(exact_sum(money, scale).cast("double"), F.count(money).cast("double"))


def steady_mean(value: Column) -> Column:
    """Mean of the values as they are, NULL for no values.

    Summed in decimals of 12 places, which makes the sum independent of the order in which tasks end; values
    that these do not hold with every digit, very small or very large ones, are summed as doubles.
    """
    kind = "decimal(28,12)"
    steady = F.when(F.bool_and(_held(value, kind)), F.try_sum(value.try_cast(kind)).cast("double"))
    return F.try_divide(F.coalesce(steady, F.sum(value.cast("double"))), F.count(value).cast("double"))


def high_price_flag(unit_price: Column, limit: float = HIGH_PRICE) -> Column:
    return F.when(unit_price > limit, 1).otherwise(0)


def severity(max_error_rate: Column) -> Column:
    return (
        F.when(max_error_rate >= CRITICAL_RATE, "CRITICAL")
        .when(max_error_rate >= HIGH_RATE, "HIGH")
        .otherwise("MEDIUM")
    )


def mask_ip(ip: Column) -> Column:
    """Hide the last of four dotted parts; any other text becomes ``masked``."""
    return F.when(
        F.size(F.split(ip, r"\.")) == 4, F.concat(F.substring_index(ip, ".", 3), F.lit(".***"))
    ).otherwise("masked")


def is_ip(text: Column) -> Column:
    """IPv4 or IPv6 in text form; an IPv4 tail stands for two IPv6 groups."""
    groups = F.regexp_replace(F.regexp_replace(text, r"%[^%]+$", ""), rf"(?<=:){_FOUR_OCTETS}$", "0:0")
    return text.rlike(f"^{_FOUR_OCTETS}$") | (text.contains(":") & groups.rlike(f"^({_IPV6})$"))


def hour_label(ts: Column) -> Column:
    """Two-digit hour of a timestamp."""
    return F.date_format(ts, "HH")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def moment(value: datetime) -> Column:
    """A zone-less point in time, whatever the zones of driver and session are."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def half_open(value: Column, start: Column, end: Column) -> Column:
    return (value >= start) & (value < end)


def label_of(code: Column, labels: dict[int, str]) -> Column:
    """Code to label; unknown codes become NULL."""
    pairs = [item for code_, label in labels.items() for item in (F.lit(code_), F.lit(label))]
    return F.try_element_at(F.create_map(*pairs), code)


def significance(p_value: Column, level: float = SIGNIFICANCE_LEVEL) -> Column:
    return F.when(p_value < level, "significant").otherwise("not significant")
