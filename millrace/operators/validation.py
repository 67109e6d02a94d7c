"""Row contracts: declarative field rules, every failing field kept, quarantine.

A contract compiles to one array-valued column, so validating is a projection: no
shuffle, no Python, and a single pass for all fields.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import is_ip, strip, to_number
from millrace.session import require_columns

ERRORS = "array<struct<loc:string,type:string,msg:string>>"
PARSED = "_value_"


@dataclass(frozen=True)
class Kind:
    """How a raw text becomes a value, and what to report when it does not."""

    type: str
    msg: str
    parse: Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """A condition on the parsed value."""

    type: str
    msg: str
    holds: Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    path: str
    kind: Kind
    rules: Sequence[Rule] = ()
    required: bool = True
    default: Callable[[], Column] | None = None

    @property
    def parsed(self) -> str:
        """Column that holds the parsed value of a tagged row."""
        return f"{PARSED}{self.path.replace('.', '__')}"

    def parse(self) -> Column:
        return self.kind.parse(F.col(self.path)).alias(self.parsed)

    def value(self) -> Column:
        return F.col(self.parsed) if self.default is None else F.coalesce(F.col(self.parsed), self.default())

    def error(self) -> Column:
        """The first broken condition of this field as a struct, else NULL."""
        raw, value = F.col(self.path), F.col(self.parsed)
        absent = self._error("missing", "field is required") if self.required else F.lit(None)
        found = F.when(raw.isNull(), absent).when(value.isNull(), self._error(self.kind.type, self.kind.msg))
        for rule in self.rules:
            found = found.when(~F.coalesce(rule.holds(value), F.lit(False)), self._error(rule.type, rule.msg))
        if "." not in self.path:
            return found
        # an absent record is reported once, by its own field
        return F.when(F.col(self.path.rsplit(".", 1)[0]).isNotNull(), found)

    def _error(self, type_: str, msg: str) -> Column:
        return F.struct(F.lit(self.path).alias("loc"), F.lit(type_).alias("type"), F.lit(msg).alias("msg"))


@dataclass(frozen=True)
class Contract:
    fields: Sequence[Field]
    forbid_extra: bool = False

    def names(self) -> list[str]:
        return list(dict.fromkeys(f.path.split(".")[0] for f in self.fields))

    def errors(self, extra: Column | None = None) -> Column:
        """All errors of a row whose values are parsed."""
        found = F.array_compact(F.array(*[f.error() for f in self.fields])).cast(ERRORS)
        if not self.forbid_extra or extra is None:
            return found
        unknown = F.transform(
            F.array_except(extra, F.array(*map(F.lit, self.names()))),
            lambda name: F.struct(
                name.alias("loc"), F.lit("extra_forbidden").alias("type"), F.lit("unknown field").alias("msg")
            ),
        )
        return F.concat(found, F.coalesce(unknown.cast(ERRORS), F.array().cast(ERRORS)))

    def tag(self, rows: DataFrame, position: str | None = None, field_names: Column | None = None) -> DataFrame:
        """Add ``errors`` to rows of raw texts.

        ``field_names`` is the array of names present in a row (of a JSON object);
        without it the columns of the table count, apart from ``position``.
        """
        require_columns(rows, self.names())
        if field_names is None:
            present = [c for c in rows.columns if c != position]
            field_names = F.array(*map(F.lit, present))
        # each text is parsed once; errors and typed rows both read the result
        parsed = rows.select("*", *[f.parse() for f in self.fields])
        return parsed.withColumn("errors", self.errors(field_names))

    def settle(self, tagged: DataFrame, position: str) -> DataFrame:
        """Tagged rows in the form to store: parsed values, errors, raw JSON of bad rows.

        :meth:`valid`, :meth:`invalid` and :func:`split_counts` read it like tagged
        rows, without parsing any text again.
        """
        raw = [c for c in tagged.columns if c not in (position, "errors") and not c.startswith(PARSED)]
        bad = F.size("errors") > 0
        parsed = [f.parsed for f in self.fields]
        return tagged.select(position, *parsed, "errors", F.when(bad, F.to_json(F.struct(*raw))).alias("data"))

    def valid(self, tagged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Typed, normalised rows without an error."""
        flat = [f for f in self.fields if "." not in f.path]
        nested: dict[str, list[Field]] = {}
        for f in self.fields:
            if "." in f.path:
                nested.setdefault(f.path.split(".")[0], []).append(f)
        columns = [
            F.struct(*[n.value().alias(n.path.split(".", 1)[1]) for n in nested[f.path]]).alias(f.path)
            if f.path in nested
            else f.value().alias(f.path)
            for f in flat
        ]
        return tagged.where(F.size("errors") == 0).select(*keep, *columns)

    def invalid(self, tagged: DataFrame, position: str, data: Column | None = None) -> DataFrame:
        """Quarantine: position, raw row as JSON, all errors."""
        raw = [c for c in tagged.columns if c not in (position, "errors") and not c.startswith(PARSED)]
        record = data if data is not None else F.to_json(F.struct(*raw))
        return tagged.where(F.size("errors") > 0).select(
            F.col(position).cast("long").alias("row_no"), record.alias("data"), "errors"
        )


def error_listing(invalid: DataFrame, id_path: str = "$.id") -> DataFrame:
    """One row per error: 1-based row number, id or ``-``, field, type, message."""
    return invalid.select(
        (F.col("row_no") + 1).alias("row_number"),
        F.coalesce(F.get_json_object("data", id_path), F.lit("-")).alias("id"),
        F.explode("errors").alias("e"),
    ).select("row_number", "id", F.col("e.loc").alias("field"), F.col("e.type").alias("type"), F.col("e.msg").alias("msg"))


def split_counts(tagged: DataFrame) -> DataFrame:
    """Total, valid and invalid rows of a tagged table, counted apart and checked."""
    bad = F.size("errors") > 0
    counts = tagged.agg(
        F.count("*").alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid")
    )
    lost = F.raise_error(F.lit("valid and invalid rows do not add up to the input")).cast("long")
    conserved = F.col("valid") + F.col("invalid") == F.col("total")
    return counts.select(F.when(conserved, F.col("total")).otherwise(lost).alias("total"), "valid", "invalid")


# --- kinds -----------------------------------------------------------------

# Texts read as a truth value.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")


def _parse_int(text: Column) -> Column:
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)(\.0*)?\s*$", 1)
    return F.when(whole != "", whole.try_cast("bigint"))


def _parse_bool(text: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered.isin(*TRUE_TEXTS), True).when(lowered.isin(*FALSE_TEXTS), False)


def _parse_date(text: Column) -> Column:
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(iso, F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))


def _parse_datetime(text: Column) -> Column:
    """Zone-less time; one with ``Z`` or an offset is taken to UTC."""
    plain = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    zone = F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?([Zz]|[+-]\d{2}(?::?\d{2})?)$", 1)
    local = F.substr(text, F.lit(1), F.length(text) - F.length(zone)).try_cast("timestamp_ntz")
    digits = F.regexp_replace(zone, r"\D", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    offset = F.when(F.upper(zone) == "Z", 0).otherwise(F.when(zone.startswith("-"), -minutes).otherwise(minutes))
    zoned = F.when(F.abs(offset) < 24 * 60, local - F.make_dt_interval(F.lit(0), F.lit(0), offset))
    return F.when(plain, text.try_cast("timestamp_ntz")).when(zone != "", zoned)


TEXT = Kind("string_type", "not a text", lambda c: c)
STRIPPED = Kind("string_type", "not a text", strip)
INT = Kind("int_parsing", "not a whole number", _parse_int)
FLOAT = Kind("float_parsing", "not a number", to_number)
BOOL = Kind("bool_parsing", "not a truth value", _parse_bool)
DATE = Kind("date_parsing", "not an ISO date", _parse_date)
DATETIME = Kind("datetime_parsing", "not an ISO time", _parse_datetime)
RECORD = Kind("model_type", "not a record", lambda c: c)
LIST = Kind("list_type", "not a list", lambda c: c)
LOWERED = Kind("string_type", "not a text", lambda c: F.lower(strip(c)))
IP = Kind("ip_any_address", "not an IPv4 or IPv6 address", lambda c: F.when(is_ip(c), c))


def _email(text: Column) -> Column:
    """Trimmed lower-case address, NULL without a local part or a dot behind the first @."""
    address = F.lower(strip(text))
    at = F.instr(address, "@")
    domain = F.substr(address, at + 1)
    return F.when((at > 1) & F.contains(domain, F.lit(".")), address)


EMAIL = Kind("value_error", "not an e-mail address", _email)

# --- rules -----------------------------------------------------------------


def at_least(limit: float) -> Rule:
    return Rule("greater_than_equal", f"must be at least {limit}", lambda v: v >= limit)


def at_most(limit: float) -> Rule:
    return Rule("less_than_equal", f"must be at most {limit}", lambda v: v <= limit)


def more_than(limit: float) -> Rule:
    return Rule("greater_than", f"must be more than {limit}", lambda v: v > limit)


def one_of(*choices: str) -> Rule:
    return Rule("literal_error", "must be one of " + ", ".join(choices), lambda v: v.isin(*choices))


def starts_with(prefix: str) -> Rule:
    return Rule("string_pattern_mismatch", f"must start with {prefix}", lambda v: v.startswith(prefix))


def min_length(n: int) -> Rule:
    return Rule("string_too_short", f"needs at least {n} characters", lambda v: F.length(v) >= n)


def max_length(n: int) -> Rule:
    return Rule("string_too_long", f"allows at most {n} characters", lambda v: F.length(v) <= n)
