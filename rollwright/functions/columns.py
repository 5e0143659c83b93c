"""Scalar expressions over codes, flags, IDs and dates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str

# Default for ``case_map``: a value without an entry maps to itself.
SELF = object()

# White space as Unicode sees it, not only the blank that ``trim`` removes.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_condition(c: ColumnLike) -> Column:
    """A condition given as a Column or as SQL text."""
    return F.expr(c) if isinstance(c, str) else c


# -- text ---------------------------------------------------------------------------------------


def strip(c: ColumnLike, blanks_only: bool = False) -> Column:
    """Remove surrounding white space (tabs and line ends included unless ``blanks_only``)."""
    c = as_column(c)
    return F.trim(c) if blanks_only else F.btrim(c, F.lit(WHITE_SPACE))


def zfill(c: ColumnLike, width: int) -> Column:
    """Zero-pad on the left; a longer value is kept whole (``lpad`` alone would cut it)."""
    c = as_column(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def compose_key(*parts: ColumnLike, sep: str = "") -> Column:
    """Concatenate parts; null as soon as one part is null."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and sep:
            pieces.append(F.lit(sep))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)


def prefix_of(c: ColumnLike, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


def starts_in(c: ColumnLike, firsts: Sequence[str]) -> Column:
    """True where the first character is one of ``firsts``."""
    return prefix_of(c, 1).isin(*firsts)


# -- conditional values -------------------------------------------------------------------------


def ordered_rules(rules: Iterable[tuple[ColumnLike, Any]], default: Any = None) -> Column:
    """First rule that holds gives the value; the order of the rules is part of their meaning.

    A condition is a Column or SQL text; a value is a literal or a Column.
    """
    chain = None
    for condition, value in rules:
        condition = as_condition(condition)
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        raise ValueError("ordered_rules needs at least one rule")
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def case_map(c: ColumnLike, mapping: Mapping[Any, Any], default: Any = SELF) -> Column:
    """Code -> label; without an entry: itself (``SELF``), a fixed value, or null (``None``).

    For short lists held in code. A long or data-driven list belongs in a table, see
    ``operators.joins.replace_by_lookup``.
    """
    c = as_column(c)
    return ordered_rules(((c == F.lit(k), v) for k, v in mapping.items()), c if default is SELF else default)


def override(c: ColumnLike, condition: ColumnLike, value: Any) -> Column:
    """``value`` where the condition holds, otherwise the column."""
    return ordered_rules([(condition, value)], as_column(c))


def any_flag(columns: Sequence[ColumnLike], mark: str, as_text: bool = False) -> Column:
    """True if any column equals ``mark``; never null.

    A plain OR chain stays in generated code, a higher-order function over an array would not.
    """
    cols = [as_column(c) for c in columns]
    if as_text:
        cols = [text_or_blank(c) for c in cols]
    hits = reduce(lambda a, b: a | b, [c == F.lit(mark) for c in cols])
    return F.coalesce(hits, F.lit(False))


def contains_class(c: ColumnLike, classes: Sequence[tuple[str, Any]]) -> Column:
    """First (part, value) whose part occurs in the text, ignoring case; null if none does."""
    lowered = F.lower(as_column(c))
    return ordered_rules([(lowered.contains(part.lower()), value) for part, value in classes])


def all_null_indicator(columns: Sequence[ColumnLike], yes: str = "Y", no: str = "N") -> Column:
    every = reduce(lambda a, b: a & b, [as_column(c).isNull() for c in columns])
    return F.when(every, F.lit(yes)).otherwise(F.lit(no))


# -- null, NaN and '' ---------------------------------------------------------------------------


def text_or_blank(c: ColumnLike) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def nan_to_zero(c: ColumnLike) -> Column:
    """NaN becomes 0; null stays null."""
    return F.nanvl(as_column(c).cast("double"), F.lit(0.0))


def number_or_zero(c: ColumnLike) -> Column:
    """NaN and null become 0."""
    return F.coalesce(nan_to_zero(c), F.lit(0.0))


def whole_number_text(c: ColumnLike) -> Column:
    """Score as published: NaN and null to 0, cut to a whole number, as text."""
    return number_or_zero(c).cast("bigint").cast("string")


def absent_or_zero(c: ColumnLike) -> Column:
    c = as_column(c)
    return c.isNull() | (c == F.lit(0))


def valid_score(c: ColumnLike) -> Column:
    c = as_column(c).cast("double")
    return c.isNotNull() & ~F.isnan(c)


def null_if_placeholder(c: ColumnLike, *placeholders: str) -> Column:
    c = as_column(c)
    return F.when(~c.isin(*placeholders), c)


# -- numbers and IDs ----------------------------------------------------------------------------


def id_normalise(c: ColumnLike, strict: bool = True) -> Column:
    """ID text -> bigint, by way of a decimal so that no digit above 2^53 is lost.

    Strict: text that is no number stops the job. Lenient: it becomes null. Null stays null.
    """
    text = as_column(c).cast("string")
    bare = strip(text)
    # Plain digits take the short way; "12.0" and "1e3" the decimal one.
    number = F.coalesce(bare.try_cast("bigint"), bare.try_cast("decimal(38,6)").try_cast("bigint"))
    if not strict:
        return number
    complaint = F.raise_error(F.concat(F.lit("not an ID: "), text)).cast("bigint")
    return F.coalesce(number, F.when(text.isNotNull(), complaint))


def round_half_up(c: ColumnLike, n: int = 1) -> Column:
    return F.round(as_column(c), n)


# Digits that an exact sum keeps on each side of the decimal point, and in each of its four accumulators.
EXACT_DIGITS = 38
_LIMB = 19
_LIMB_TYPE = "decimal(38,0)"
# Ordinary numbers are added without their text. A double prints at most 17 digits, so that one from 10^e up has no
# digit beyond the scale 17 - e: that of sums across columns, and of three sums down a column, each for 8 places.
_DOUBLE_DIGITS = 17
_PLAIN_SCALE = 22
_PLAIN_LEAST = 1e-5
_BANDS = (-4, 4, 12)
_BAND = 8
# Places on each side of the point up to which a decimal is cut there by a subtraction.
_CUT = 18
_WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def exact_limbs(c: ColumnLike, wanted: Column) -> list[Column]:
    """A number cut into four whole ones of up to 19 digits, from the highest down; null for null, NaN and what is not wanted.

    The number is read off its decimal text, with or without exponent, so that integers, decimals and doubles
    go the same way and none passes through another type. Sums of 10^19 such limbs fit their type.
    """
    limbs = F.when(wanted, _limb_array(as_column(c).cast("string")))
    return [F.get(limbs, F.lit(i)) for i in range(4)]


def _limb_array(text: Column) -> Column:
    """Plain functions, few of them: Spark compiles no aggregation that holds a lambda, and Java no method that is too long."""
    bare = F.ltrim(text, F.lit("-0"))
    number = F.substring_index(bare, "E", 1)
    power = F.substring_index(F.substring_index(F.concat(bare, F.lit("E0")), "E", 2), "E", -1).cast("int")
    point = F.length(F.substring_index(number, ".", 1)) + power
    # The point comes to stand behind the same place of every number, far enough for exponents of two digits.
    before = EXACT_DIGITS + 62
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    digits = F.replace(number, F.lit("."), F.lit(""))
    placed = F.concat(sign, F.repeat(F.lit("0"), F.lit(before) - point), digits, F.lit("0" * (before + EXACT_DIGITS)))
    shape = f"^(-?)0{{{before - EXACT_DIGITS}}}" + f"([0-9]{{{_LIMB}}})" * 4 + "0*$"
    fits = text.rlike(r"^-*([0-9]+[.]?[0-9]*|[.][0-9]+)(E-?[0-9]{1,2})?$") & placed.rlike(shape)
    limbs = F.split(F.regexp_replace(placed, shape, "$1$2,$1$3,$1$4,$1$5"), ",").cast(f"array<{_LIMB_TYPE}>")
    complaint = F.raise_error(F.concat(F.lit("too many digits to add exactly: "), text)).cast(f"array<{_LIMB_TYPE}>")
    return F.when(text != "NaN", F.when(fits, limbs).otherwise(complaint))


def add_limbs(numbers: Sequence[Column], limbs: Sequence[Column] = ()) -> Column:
    """The limbs of numbers, and given ones, added up as an array; null and NaN are absent."""
    zero = F.lit(0).cast(_LIMB_TYPE)
    zeros = F.array(*[zero] * 4)
    start = F.array(*[F.coalesce(limb, zero) for limb in limbs]) if limbs else zeros
    texts = F.array(*[c.cast("string") for c in numbers])
    return F.aggregate(texts, start, lambda held, text: F.zip_with(held, F.coalesce(_limb_array(text), zeros), lambda a, b: (a + b).cast(_LIMB_TYPE)))


def exact_result(limbs: Column, result: str = "double") -> Column:
    """The number that an array of added limbs stands for: carried once from the lowest up, then cast to ``result``."""
    base = F.lit("1" + "0" * _LIMB).cast(_LIMB_TYPE)

    def carry(state: Column, limb: Column) -> Column:
        held = (limb + state["carry"]).cast(_LIMB_TYPE)
        rest = F.pmod(held, base).cast(_LIMB_TYPE)
        return F.struct(
            F.call_function("div", held - rest, base).cast(_LIMB_TYPE).alias("carry"),
            F.concat(F.lpad(rest.cast("string"), _LIMB, "0"), state["digits"]).alias("digits"),
        )

    def carried(v: Column, sign: int) -> Column:
        start = F.struct(F.lit(0).cast(_LIMB_TYPE).alias("carry"), F.lit("").alias("digits"))
        lower = F.aggregate(v["lower"], start, lambda state, limb: carry(state, (limb * sign).cast(_LIMB_TYPE)))
        top = _let(lower, lambda x: F.struct((v["top"] * sign + x["carry"]).cast(_LIMB_TYPE).alias("top"), x["digits"].alias("digits")))
        return top

    def text(v: Column) -> Column:
        # The lower limbs are whole and positive after the carry, so the sign is that of the highest.
        signed = _let(carried(v, 1), lambda x: F.when(x["top"] < 0, F.lit(True)).otherwise(F.lit(False)))
        chosen = F.when(signed, carried(v, -1)).otherwise(carried(v, 1))

        def shown(x: Column) -> Column:
            whole = F.ltrim(F.concat(x["top"].cast("string"), F.substring(x["digits"], 1, _LIMB)), F.lit("0"))
            after = F.rtrim(F.substring(x["digits"], _LIMB + 1, 2 * _LIMB), F.lit("0"))
            number = F.concat(F.when(whole == "", F.lit("0")).otherwise(whole), F.when(after == "", F.lit("")).otherwise(F.concat(F.lit("."), after)))
            return F.struct(number.alias("number"), F.length(after).alias("scale"))

        return _let(_let(chosen, shown), lambda x: F.struct(
            F.concat(F.when(signed, F.lit("-")).otherwise(F.lit("")), x["number"]).alias("number"), x["scale"].alias("scale")
        ))

    sums = _let(limbs, lambda v: F.struct(F.get(v, F.lit(0)).alias("top"), F.reverse(F.slice(v, 2, 3)).alias("lower")))
    number = _let(sums, text)
    if not result.startswith("decimal"):
        return number["number"].cast(result)
    scale = int(re.search(r",\s*(\d+)\)", result)[1]) if "," in result else 0

    def fitted(x: Column) -> Column:
        held = x["number"].try_cast(result)
        complaint = F.raise_error(F.concat(F.lit(f"{result} cannot hold the sum "), x["number"])).cast(result)
        return F.when(held.isNull() | (x["scale"] > scale), complaint).otherwise(held)

    return _let(number, fitted)


def _fits_by_type(c: Column, scale: int) -> Column:
    """The type alone says that no value has more digits after the point. Settled when the plan is made."""
    kind = F.typeof(c)
    digits = F.regexp_extract(kind, r"^decimal\(\d+,(\d+)\)$", 1).try_cast("int")
    return kind.isin(*_WHOLE_TYPES) | F.coalesce(digits <= scale, F.lit(False))


def _is_nan(c: Column) -> Column:
    return F.typeof(c).isin("double", "float") & F.isnan(c.try_cast("double"))


def plain_sum(numbers: Sequence[Column]) -> tuple[Column, Column]:
    """Whether ordinary decimal addition is exact for these numbers, and if so their sum; nulls and NaN are absent.

    It is for whole numbers, decimals and doubles of 0 or at least 10^-5 whose sum has 16 digits before the point and
    ``_PLAIN_SCALE`` after it. Added two by two, each round needs one digit more and none is rounded off.
    """
    spare = (len(numbers) - 1).bit_length()
    kept, most = f"decimal({EXACT_DIGITS - spare},{_PLAIN_SCALE})", 10.0 ** (EXACT_DIGITS - _PLAIN_SCALE - spare)
    fits, terms = F.lit(True), []
    for c in numbers:
        size = F.abs(c.try_cast("double"))
        exact = F.when(F.typeof(c) == "double", (size == 0) | (size >= _PLAIN_LEAST)).otherwise(_fits_by_type(c, _PLAIN_SCALE))
        fits = fits & (c.isNull() | _is_nan(c) | F.coalesce(exact & (size < most), F.lit(False)))
        terms.append(F.coalesce(F.when(size < most, c.try_cast(kept)), F.lit(0).cast(kept)))
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2 :]
    return fits, terms[0]


def exact_addends(c: ColumnLike) -> tuple[list[Column], Column]:
    """A number as decimals to be summed apart, most of them null, and whether it goes by its text instead.

    A double goes, by its size, to one of three scales that holds all its digits, a whole number to the last of them;
    a decimal of up to 18 digits on each side of the point is cut there, for the first and the last. Sums of 10^13 such
    numbers fit their types. The rest (other types, very small and very large numbers) is for ``exact_limbs``.
    """
    c = as_column(c)
    size = F.abs(c.try_cast("double"))
    is_double, is_whole = F.typeof(c) == "double", F.typeof(c).isin(*_WHOLE_TYPES)
    bands = [is_double & (size >= 10.0**e) & (size < 10.0 ** (e + _BAND)) for e in _BANDS]
    types = [f"decimal({EXACT_DIGITS},{_DOUBLE_DIGITS - e})" for e in _BANDS]
    addends = [F.when(band, c.try_cast(kept)) for band, kept in zip(bands, types)]
    # A decimal without room in this type is null here; the difference keeps every digit, as both types are short enough.
    is_cut, cut = ~is_whole & _fits_by_type(c, _CUT), c.try_cast(f"decimal({2 * _CUT},{_CUT})")
    whole = cut.try_cast(f"decimal({_CUT + 1},0)")
    addends[0] = addends[0].when(is_cut, (cut - whole).try_cast(types[0]))
    addends[-1] = addends[-1].when(is_whole, c.try_cast(types[-1])).when(is_cut, whole.try_cast(types[-1]))
    done = reduce(lambda a, b: a | b, bands) | (is_double & (size == 0)) | is_whole | (is_cut & cut.isNotNull()) | _is_nan(c)
    return addends, ~done


def exact_sum_of(columns: Sequence[ColumnLike], result: str = "double") -> Column:
    """Decimal-exact sum across columns of one row; nulls and NaN count as absent.

    Ordinary numbers are added as decimals; only a row with others goes by their text.
    """
    columns = [as_column(c) for c in columns]
    by_text = exact_result(add_limbs(columns), result)
    if result != "double":
        return by_text
    fits, total = plain_sum(columns)
    return F.when(fits, total.cast(result)).otherwise(by_text)


# -- dates --------------------------------------------------------------------------------------


def assemble_date_text(month: ColumnLike, day: ColumnLike, year: ColumnLike, sentinel: str = "1900") -> Column:
    """``MM/DD/YYYY`` from parts; the sentinel year means that only the day part holds text."""
    month, day, year = as_column(month), as_column(day), as_column(year)
    return F.when(year == F.lit(sentinel), day).otherwise(compose_key(month, day, year, sep="/"))


# -- column sets of a table ---------------------------------------------------------------------


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def add_constant_columns(
    df: DataFrame, nulls: Sequence[str] = (), fixed: Mapping[str, Any] | None = None, null_type: str = "string"
) -> DataFrame:
    """Typed-null columns and fixed-value columns in one projection."""
    added = {name: F.lit(None).cast(null_type) for name in nulls}
    added |= {name: F.lit(value) for name, value in (fixed or {}).items()}
    return df.withColumns(added)


@dataclass(frozen=True)
class Numbered:
    """A run of names: a prefix with each number from ``first`` to ``last``."""

    prefix: str
    first: int
    last: int

    @property
    def names(self) -> list[str]:
        return [f"{self.prefix}{n}" for n in range(self.first, self.last + 1)]


def expand_column_list(*parts: str | Numbered) -> list[str]:
    """Column names from literal names and numbered runs, in the order given."""
    return [name for part in parts for name in (part.names if isinstance(part, Numbered) else [part])]


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def conditional_null(df: DataFrame, columns: Sequence[str], keep_when: ColumnLike) -> DataFrame:
    """Blank the columns on rows where the condition does not hold."""
    keep = as_condition(keep_when)
    return df.withColumns({c: F.when(keep, F.col(f"`{c}`")) for c in columns})


def single_value(df: DataFrame, column: str) -> Any:
    """The only value of a column; two or more are an error. At most two rows reach the driver."""
    rows = df.select(column).distinct().limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{column} must hold exactly one value")
    return rows[0][0]


def parametric_name(
    df: DataFrame, column: str, template: str, value_column: str, short: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename ``column`` by the one value found in ``value_column`` (abbreviated by ``short``)."""
    value = single_value(df, value_column)
    return df.withColumnRenamed(column, template.format((short or {}).get(value, value)))
