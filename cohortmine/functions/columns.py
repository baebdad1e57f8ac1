"""Column helpers. Each returns a ``Column`` made of built-in functions only, so the
expressions stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim strips every char <= U+0020 (tabs, CR, ...); F.trim only spaces.
_JAVA_WS_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Trim all control characters and spaces at both ends, like Java's ``trim``."""
    return F.regexp_replace(_col(c), _JAVA_WS_EDGES, "")


def itemset_string(c: Column | str) -> Column:
    """External itemset text: ``[1, 2, 3]`` -> ``'1;2;3;'``."""
    return F.concat(F.concat_ws(";", _col(c).cast("array<string>")), F.lit(";"))


def parse_itemset_string(c: Column | str) -> Column:
    """``'1;2;3;'`` (or ``'1;2;3'``) -> ``[1, 2, 3]`` as ``ARRAY<INT>``; empties dropped."""
    parts = F.split(F.regexp_replace(_col(c), r"\s+", ""), ";")
    return F.filter(parts, lambda x: x != "").cast("array<int>")


def half_up_milli(num: Column | str, den: Column | str) -> Column:
    """``round(num/den, 3)`` HALF_UP, as an exact integer number of thousandths.

    ``(2000*num + den) div (2*den)`` rounds the exact rational, which equals Java's
    BigDecimal HALF_UP of the printed double for all realistic counts, and is the
    same integer in any SQL engine. Integer division on decimals: exact for any BIGINT.
    """
    n, d = _col(num).cast("decimal(20,0)"), _col(den).cast("decimal(20,0)")
    return F.when(d > 0, F.call_function("div", n * 2000 + d, d * 2).cast("long"))


def milli_to_double(c: Column | str) -> Column:
    """Thousandths -> DOUBLE (one correctly-rounded division, engine-independent)."""
    return _col(c).cast("double") / F.lit(1000.0)


def support_passes(cnt: Column | str, n: int | Column, min_support: float,
                   mode: str = "exact") -> Column:
    """Strict relative-support test ``cnt / n > min_support``.

    ``mode='reference'`` reproduces a 32-bit float quotient: the double quotient
    rounded to float is the correctly-rounded float quotient for counts < 2**24,
    so ``(cnt/n)`` cast to float and widened back compares like the original.
    """
    ratio = _col(cnt).cast("double") / (n if isinstance(n, Column) else F.lit(float(n)))
    if mode == "reference":
        ratio = ratio.cast("float").cast("double")
    elif mode != "exact":
        raise ValueError(f"unknown count mode {mode!r}")
    return ratio > F.lit(float(min_support))


def reference_count(cnt: Column | str, k: int) -> Column:
    """Size-k count as the reference reports it: ``floor(cnt / (k-1)!)`` for k >= 2."""
    if k < 2:
        return _col(cnt)
    return F.call_function("div", _col(cnt).cast("long"), F.lit(math.factorial(k - 1)).cast("long"))


def subset_by_mask(items: Column | str, mask: Column | str, keep: int = 1) -> Column:
    """Elements of ``items`` whose bit in ``mask`` equals ``keep`` (order preserved)."""
    m = _col(mask)
    return F.filter(_col(items),
                    lambda x, i: F.call_function("shiftright", m, i).bitwiseAND(F.lit(1)) == keep)
