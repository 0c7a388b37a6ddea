"""Column rules for text, codes and flags. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def code(value: ColumnLike) -> Column:
    """Standard spelling of a code: trimmed and in upper case."""
    return F.upper(F.trim(as_col(value)))


def tidy(value: ColumnLike, how: str) -> Column:
    """``how``: trim, upper or lower."""
    shapes = {"trim": F.trim, "upper": code, "lower": lambda c: F.lower(F.trim(c))}
    return shapes[how](as_col(value))


def full_name(first: ColumnLike, last: ColumnLike, skip_missing: bool = False) -> Column:
    """NULL when a part is missing, unless missing parts are to be skipped."""
    parts = [F.trim(as_col(first)), F.trim(as_col(last))]
    if skip_missing:
        return F.concat_ws(" ", *parts)
    return F.concat(parts[0], F.lit(" "), parts[1])


def email_domain(value: ColumnLike, after_last: bool = False) -> Column:
    """Text after the first '@' (NULL without one), or after the last '@' (whole text without one)."""
    text = F.lower(as_col(value))
    if after_last:
        return F.substring_index(F.trim(text), "@", -1)
    at = F.instr(text, "@")
    return F.when(at > 0, F.substr(text, at + 1))


def phone_digits(value: ColumnLike, international: bool = False) -> Column:
    """Digits and '+' only; optionally a leading 00 becomes '+'."""
    digits = F.regexp_replace(as_col(value), "[^0-9+]", "")
    return F.regexp_replace(digits, "^00", "+") if international else digits


def mapped(value: ColumnLike, codes: Mapping[str, Sequence[str]], rest: ColumnLike | None = None) -> Column:
    """Synonyms to standard code; ``rest`` is the label for others, None passes them through.

    One lookup in a constant map: a CASE over the same lists would repeat the
    trimmed text in every branch and outgrow what the JVM compiles.
    """
    key = code(value)
    pairs = [F.lit(x) for label, names in codes.items() for name in names for x in (name, label)]
    other = key if rest is None else (F.lit(rest) if isinstance(rest, str) else rest)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), other)


def first_match(rules: Iterable[tuple[Column, Column]], rest: Column) -> Column:
    """CASE over (condition, value) pairs in order."""
    pairs = list(rules)
    chain = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(rest)


def pattern_code(
    value: ColumnLike, patterns: Sequence[tuple[str, str]], rest: str, missing: bool = False
) -> Column:
    """Ordered LIKE rules. With ``missing`` a NULL input stays NULL, else it gets ``rest``."""
    text = code(value)
    found = first_match([(text.like(p), F.lit(label)) for p, label in patterns], F.lit(rest))
    return F.when(as_col(value).isNotNull(), found) if missing else found


def below(value: ColumnLike, cuts, missing: str | None = None, inclusive: bool = False) -> Column:
    """Bands by upper bound. NULL gets ``missing``, or the top label when that is None."""
    steps, top = cuts
    c = as_col(value)
    test = (lambda b: c <= F.lit(b)) if inclusive else (lambda b: c < F.lit(b))
    band = first_match([(test(b), F.lit(label)) for b, label in steps], F.lit(top))
    return band if missing is None else F.when(c.isNull(), missing).otherwise(band)


def at_least(value: ColumnLike, cuts) -> Column:
    """Bands by inclusive lower bound, highest first."""
    steps, bottom = cuts
    c = as_col(value)
    return first_match([(c >= F.lit(b), F.lit(label)) for b, label in steps], F.lit(bottom))


def balance_band(value: ColumnLike, cuts, zero: bool = True) -> Column:
    c = as_col(value)
    head = [(c < 0, F.lit("NEGATIVE"))] + ([(c == 0, F.lit("ZERO"))] if zero else [])
    return first_match(head + [(F.lit(True), below(c, cuts))], F.lit(None))


def segment(income: ColumnLike, score: ColumnLike, rules, rest: str) -> Column:
    i, s = as_col(income), as_col(score)
    return first_match([((i > lo_i) & (s > lo_s), F.lit(label)) for lo_i, lo_s, label in rules], F.lit(rest))


def income_segment(income: ColumnLike) -> Column:
    i = as_col(income)
    return (
        F.when(i < 50000, "Low Income").when(i.between(50000, 100000), "Medium Income").otherwise("High Income")
    )


def is_true(condition: Column) -> Column:
    """A flag that is never NULL."""
    return F.coalesce(condition, F.lit(False))


def amount_sign(value: ColumnLike) -> Column:
    c = as_col(value)
    return F.when(c > 0, "CREDIT").when(c < 0, "DEBIT").otherwise("NEUTRAL")


def suspicious(amount: ColumnLike, hour: ColumnLike, limit, night, signed: bool = False) -> Column:
    size = as_col(amount) if signed else F.abs(as_col(amount))
    return is_true((size > limit) | as_col(hour).between(*night))


def internal_transfer(source: ColumnLike, target: ColumnLike) -> Column:
    return as_col(source).isNotNull() & as_col(target).isNotNull()


def mask_card(number: ColumnLike) -> Column:
    return F.concat(F.lit("****-****-****-"), F.substring(as_col(number), -4, 4))


def mask_partial(value: ColumnLike, keep: int = 3) -> Column:
    """The first characters, then a fixed mask."""
    return F.concat(F.substring(as_col(value).cast("string"), 1, keep), F.lit("***"))


def _quotient(part: Column, whole: Column, factor: int, places: int) -> Column:
    """factor * part / whole, rounded half up once; NULL where whole is zero or NULL.

    Whole numbers and decimals are divided with remainder, so no digit is rounded twice; the result is DECIMAL(38, places).
    Their scale may be up to 6, or more as long as all digits and ``places`` fit 38. As soon as one side is floating, both are, and the result
    is a double.
    """
    a = part * F.lit(Decimal(factor * 10**places))  # a decimal, or a double if the column is one
    b = F.nullif(whole * F.lit(Decimal(1)), F.lit(0))
    rest = a % b
    away = F.when((rest < 0) != (b < 0), F.lit(Decimal(-1))).otherwise(F.lit(Decimal(1)))
    units = (a - rest) / b + F.when(F.abs(rest) * 2 >= F.abs(b), away).otherwise(F.lit(Decimal(0)))
    exact = units.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-places))
    scaled = part * F.lit(Decimal(factor))
    floating = F.typeof(scaled / b).isin("double", "float")  # known when the plan is made: one branch remains
    return F.when(floating, F.round(scaled / b, places)).otherwise(exact)


def percent(part: ColumnLike, whole: ColumnLike, other: Column | None = None, places: int = 2) -> Column:
    """100 * part / whole, exact and rounded once; ``other`` where whole is not positive."""
    b = as_col(whole)
    guarded = F.when(b > 0, _quotient(as_col(part), b, 100, places))
    return guarded if other is None else guarded.otherwise(other)


def exact_ratio(part: ColumnLike, whole: ColumnLike, places: int = 2) -> Column:
    """part / whole, exact and rounded half up once; NULL on a zero divisor."""
    return _quotient(as_col(part), as_col(whole), 1, places)


def first_of(conditions: Mapping[str, Column], separator: str, keep_empty: bool = False) -> Column:
    """Join the names of the conditions that hold. ``keep_empty`` leaves a slot for the others."""
    fill = F.lit("") if keep_empty else F.lit(None).cast("string")
    return F.concat_ws(separator, *[F.when(c, name).otherwise(fill) for name, c in conditions.items()])


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
