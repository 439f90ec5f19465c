"""An exact sum of doubles out of plain integer aggregates.

A double is a whole number of units of its exponent, so it splits without loss into
signed digits to the base 2**LIMB: the nearest whole number and three digits behind the
point, once it has
been scaled by a power of two into [2**-8, 2**13) or lies above. The power, a multiple
of LIMB, is the value's *bin*. Sums by bin are sums of longs: exact, mergeable in any
order, and the digits of neighbouring bins lie on one common grid. :func:`exact_digits`
gives the columns to sum by bin; :func:`truncated_total` adds up the bins of a group.

Amounts in use are all in bin 0, so a group is one row and costs four long sums. A
digit's sum stays within a long for 2**42 rows a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = 21
DIGITS = ["digit0", "digit1", "digit2", "digit3"]
_LEAST = 2.0**-8  # from here on a value stays in bin 0


def exact_bin(value: str) -> str:
    """SQL: how many times a value is scaled by 2**LIMB; 0 for NULL, zero and all from
    _LEAST on. (At a power's edge the logarithm may miss by one; a digit has room for it.)"""
    small = f"abs({value}) > 0D AND abs({value}) < {_LEAST}D"
    return f"CASE WHEN {small} THEN CAST(floor((-8D - log2(abs({value}))) / {LIMB}D) + 1 AS INT) ELSE 0 END"


def exact_digits(value: str) -> dict[str, str]:
    """SQL of the digit columns of a value; their sums by bin are exact. A value beyond a
    long, or none at all (NaN), raises under ANSI."""
    bin_, base = f"({exact_bin(value)})", float(1 << LIMB)
    # two steps: the power of the smallest doubles is no double itself
    half = f"floor({bin_} / 2D)"
    scaled = (
        f"CASE WHEN {bin_} = 0 THEN {value} "
        f"ELSE {value} * pow(2D, {LIMB} * {half}) * pow(2D, {LIMB} * ({bin_} - {half})) END"
    )
    out = {DIGITS[0]: f"CAST(rint({scaled}) AS BIGINT)"}
    for k, name in enumerate(DIGITS[1:]):
        at = f"(({scaled}) * {base**k:.0f}D)"  # the digits before this one are whole now
        out[name] = f"CAST(rint(({at} - rint{at}) * {base:.0f}D) AS BIGINT)"
    return out


def truncated_total(bin_: str, digits: list[str]) -> Column:
    """Aggregate over a group's bins: the exact sum of all values, correctly rounded to a
    double while it is below 2**53 (as a sum of doubles would ideally be: ten million
    times 0.0000004 is 4) and truncated to a long; from there on its whole part as it is.
    NULL when every digit sum is. A total beyond a long raises under ANSI."""
    entry = ", ".join(f"named_struct('place', {bin_} + {k}, 'digit', {d})" for k, d in enumerate(digits))
    known = f"filter(flatten(collect_list(array({entry}))), e -> e.digit IS NOT NULL)"
    # the units' place is always there, so the carry ends in it
    ordered = f"sort_array(concat({known}, array(named_struct('place', 0, 'digit', 0L))), false)"
    # From the smallest place on: move the carry up to the entry's place (shifts round
    # down), then add it. The 63 bits behind the place are kept, and whether more follow.
    bits = f"greatest(least((acc.place - e.place) * {LIMB}, 63), 0)"
    moved, kept = f"shiftright(acc.carry, {bits})", f"shiftright(acc.behind, {bits})"
    step = f"""named_struct(
        'place', e.place,
        'carry', {moved} + e.digit,
        'behind', shiftleft(acc.carry - shiftleft({moved}, {bits}), 63 - {bits}) + {kept},
        'more', acc.more OR shiftleft({kept}, {bits}) != acc.behind)"""
    start = "named_struct('place', 0, 'carry', 0L, 'behind', 0L, 'more', false)"

    def rounded(whole: str, behind: str) -> str:
        """whole, or one more where the nearest double is: the bits behind the point are
        all ones as far as a double reaches."""
        unit = f"CASE WHEN {whole} > 0 THEN length(bin({whole})) - 1 ELSE -1 END"
        near = f"{behind} > {2**63 - 1}L - shiftleft(1L, least(({unit}) + 10, 62))"
        return f"{whole} + CASE WHEN ({unit}) < 53 AND {near} THEN 1 ELSE 0 END"

    # below zero the carry is the floor: turn it into size and bits behind it
    exact = "(acc.behind = 0 AND NOT acc.more)"
    size = f"(CASE WHEN {exact} THEN 0 ELSE -1 END - acc.carry)"
    rest = f"(CASE WHEN {exact} THEN 0L ELSE {2**63 - 1}L - acc.behind + CASE WHEN acc.more THEN 0 ELSE 1 END END)"
    finish = f"CASE WHEN acc.carry >= 0 THEN {rounded('acc.carry', 'acc.behind')} ELSE -({rounded(size, rest)}) END"
    total = f"aggregate({ordered}, {start}, (acc, e) -> {step}, acc -> {finish})"
    return F.expr(f"CASE WHEN count({digits[0]}) > 0 THEN {total} END")
