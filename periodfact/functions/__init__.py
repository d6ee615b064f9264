"""Scalar column expressions (JVM-side, inside whole-stage codegen).

None of these is a Python UDF: each returns a ``Column`` built from
built-in functions, so Catalyst can fold, push down and codegen them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1 -------------------------------------------------------------------------
# Blanks used as thousands separators: space, no-break space, narrow no-break.
_GROUP_BLANKS = "[\\s\\u00A0\\u202F]"


def parse_locale_number(c: ColumnOrName) -> Column:
    """Text like ``5 315``, ``16,0`` or ``252.65`` to double; junk to null.

    Group blanks are removed and a decimal comma becomes a point.  Numeric
    input is cast as is (whole numbers are kept, not dropped).  A value
    that does not parse becomes null; see :func:`is_rejected_number`.
    """
    text = F.regexp_replace(F.regexp_replace(_col(c).cast("string"), _GROUP_BLANKS, ""), ",", ".")
    return text.try_cast("double")


def is_rejected_number(c: ColumnOrName) -> Column:
    """True where a non-null input did not parse as a number."""
    return _col(c).isNotNull() & parse_locale_number(c).isNull()


# X2 -------------------------------------------------------------------------
def period_from_code(c: ColumnOrName, start: int = 2, length: int = 4) -> Column:
    """Integer period cut out of a code such as ``_2012_01``; junk to null."""
    return F.substring(_col(c).cast("string"), start, length).try_cast("int")


# X4 / X5 --------------------------------------------------------------------
def percent_change(cur: ColumnOrName, prev: ColumnOrName, scale: int | None = 2) -> Column:
    """``(cur - prev) / prev * 100``; a zero or null divisor gives null."""
    out = F.try_divide(_col(cur) - _col(prev), _col(prev)) * F.lit(100.0)
    return F.round(out, scale) if scale is not None else out


def share(value: ColumnOrName, total: ColumnOrName) -> Column:
    """``value / total * 100`` (unrounded); a zero total gives null."""
    return F.try_divide(_col(value).cast("double"), _col(total).cast("double")) * F.lit(100.0)


# X6 / X7 / X9 ---------------------------------------------------------------
def casefold_key(c: ColumnOrName) -> Column:
    """Match key: trimmed, inner blanks collapsed, lower case."""
    return F.lower(F.regexp_replace(F.trim(_col(c)), "\\s+", " "))


def strip_prefix(c: ColumnOrName, n: int = 1) -> Column:
    """Drop the first ``n`` characters of a code (``LDVD`` -> ``DVD``)."""
    return F.substring(_col(c), n + 1, 1 << 30)


def normalise_label(c: ColumnOrName, canonical: Iterable[str] = (),
                    aliases: Mapping[str, str] | None = None) -> Column:
    """Map a free-text label onto its canonical spelling.

    The match key is :func:`casefold_key`; canonical labels and aliases are
    matched on that key.  Labels matching nothing come out trimmed in
    ``initcap`` form, so case variants of one unknown label still agree.
    """
    pairs: dict[str, str] = {}
    for label in canonical:
        pairs[_fold(label)] = label
    for alias, target in (aliases or {}).items():
        pairs[_fold(alias)] = target
    key = casefold_key(c)
    fallback = F.initcap(key)
    if not pairs:
        return fallback
    lookup = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.element_at(lookup, key), fallback)


def _fold(s: str) -> str:
    return " ".join(s.strip().split()).lower()


# Exact sums ------------------------------------------------------------------
def scaled_long(c: ColumnOrName, scale: int = 2) -> Column:
    """The value in units of ``10**-scale`` as a long (e.g. cents), half-up.

    ``floor(x * 10**scale + 0.5)`` is a CPU intrinsic; Spark's ``round`` on a
    double goes through a BigDecimal per value, which doubled scan time.
    A value with more decimals than ``scale`` raises instead of being rounded.
    """
    value = _col(c).cast("double") * F.lit(float(10 ** scale))
    whole = F.floor(value + F.lit(0.5))
    return F.when(F.abs(value - whole) > 0.01, F.raise_error(F.lit(f"a value has more than {scale} decimals")).cast("long")).otherwise(whole)


def exact_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Sum of values carrying at most ``scale`` decimals, exact and order-independent.

    Double sums depend on the order partitions are combined in, so two runs
    (or two engines) can differ in the last bits.  Here the values are
    summed as scaled longs (a fixed-width aggregation buffer that stays in
    generated code, unlike wide decimals) and divided once at the end, which
    gives the double nearest to the exact decimal sum.  ANSI mode raises on
    long overflow instead of wrapping.
    """
    return F.sum(scaled_long(c, scale)) / F.lit(float(10 ** scale))


def exact_mean(c: ColumnOrName, scale: int = 2) -> Column:
    """Mean as exact sum divided by the non-null count (double)."""
    return exact_sum(c, scale) / F.count(_col(c))


#: Bits of a limb and the exponent of the lowest one's unit; the top limb has no upper bound of its own.
_LIMB_BITS, _LIMBS, _LOWEST = 26, 6, -90


def order_free_sum(c: ColumnOrName) -> Column:
    """Sum of arbitrary doubles with the same bits under any order and partitioning.

    Each value is cut into fixed-point limbs of 26 bits (units 2^40, 2^14, ..
    2^-90), which are summed as longs; integers add up to the same whatever the
    order.  The sums are carried into each other and turned into one double at
    the end.  A value's bits under 2^-90 (8e-28) are cut off value by value; a
    group may hold 10^11 values under 2^90 (ANSI mode raises beyond).  Infinities
    and NaN sum as usual.  Without values: null.
    """
    x = _col(c).cast("double")
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    size = F.when(~special, F.abs(x))
    sums = []
    for k in range(_LIMBS):  # from the lowest limb
        unit = 2.0 ** (_LOWEST + _LIMB_BITS * k)
        rest = size if k == _LIMBS - 1 else size % F.lit(unit * 2 ** _LIMB_BITS)  # exact, like the division by a power of two
        limb = F.floor(rest / F.lit(unit))
        sums.append(F.coalesce(F.sum(F.when(x < 0, -limb).otherwise(limb)), F.lit(0).cast("long")))
    mask = F.lit((1 << _LIMB_BITS) - 1)

    def carried(parts: Column) -> Column:
        """(carry out of the last limb, the limbs below it as a double)."""
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("low"), F.lit(2.0 ** _LOWEST).alias("unit"))

        def step(state: Column, part: Column) -> Column:
            whole = part + state["carry"]
            return F.struct(F.shiftright(whole, _LIMB_BITS).alias("carry"),
                            (state["low"] + whole.bitwiseAND(mask) * state["unit"]).alias("low"),
                            (state["unit"] * F.lit(float(1 << _LIMB_BITS))).alias("unit"))

        return F.aggregate(parts, start, step)

    lower, top = F.array(*sums[:-1]), sums[-1]
    negative = (top + carried(lower)["carry"]) < 0  # then the sum of the negated limbs is taken
    sign = F.when(negative, F.lit(-1).cast("long")).otherwise(F.lit(1).cast("long"))
    found = carried(F.transform(lower, lambda v: v * sign))
    exact = sign * (found["low"] + (top * sign + found["carry"]) * F.lit(2.0 ** (_LOWEST + _LIMB_BITS * (_LIMBS - 1))))
    return F.when(F.count(x) > 0, F.coalesce(F.sum(F.when(special, x)), exact))


__all__ = [
    "parse_locale_number", "is_rejected_number", "period_from_code",
    "percent_change", "share", "casefold_key", "strip_prefix", "normalise_label",
    "exact_sum", "exact_mean", "scaled_long", "order_free_sum",
]
