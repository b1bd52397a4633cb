"""Rolling means and deviations from running sums of whole numbers.

A value is rounded to a multiple of 2**-46 and cut into three limbs of 18 bits. Sums of limbs
and of their products run along the series as longs, without rounding; a window's sums are the
running ones less those of the row before it. So a row costs the same for a window of any
length, and its values depend on the rows in the window only: whole series, chunks and appended
days agree in every bit, and a constant window has a deviation of exactly zero.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Bits behind the point, bits of a limb, and the values beyond which three limbs are too few.
BITS, LIMB, LIMIT = 46, 18, 64.0

#: Limbs, and the pairs of them, low first.
LIMBS = range(3)
PAIRS = list(combinations_with_replacement(LIMBS, 2))


@dataclass(frozen=True)
class Rolling:
    """A mean or deviation of a column over so many trailing rows, all of them with a value."""

    column: str
    rows: int
    deviation: bool = True


def _limbs(name: str) -> list[Column]:
    """The limbs of a value, each within half of 2**LIMB but the highest."""
    value = F.col(name)
    far = F.raise_error(F.concat(F.lit(f"{name} beyond {LIMIT}: "), value.cast("string")))
    whole = F.when(F.abs(value) > LIMIT, far.cast("long")).otherwise(
        F.rint(value * F.lit(2.0**BITS)).cast("long")
    )
    half, size = 1 << (LIMB - 1), 1 << LIMB
    found = []
    for _ in LIMBS[:-1]:
        low = F.pmod(whole + half, F.lit(size)) - half
        found.append(low)
        whole = F.shiftright(whole - low, LIMB)
    return [*found, whole]


def _running(name: str, deviation: bool, w: WindowSpec) -> Column:
    """A struct of running sums: values, limbs and, for deviations, products of limbs."""
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    limbs = [F.col(f"_{name}_{i}") for i in LIMBS]
    sums = [F.count(name).over(upto).alias("n")]
    sums += [F.coalesce(F.sum(limbs[i]).over(upto), F.lit(0)).alias(f"s{i}") for i in LIMBS]
    for i, j in PAIRS if deviation else ():
        product = F.coalesce(F.sum(limbs[i] * limbs[j]).over(upto), F.lit(0))
        sums.append(product.alias(f"p{i}{j}"))
    return F.struct(*sums)


def _value(rolling: Rolling, now: Column, before: Column) -> Column:
    def of_window(field: str) -> Column:
        return now[field] - F.coalesce(before[field], F.lit(0))

    n = rolling.rows
    sums = [of_window(f"s{i}") for i in LIMBS]
    if rolling.deviation:
        # n times the sum of squares less the square of the sum, by pairs of limbs: each exact
        parts = [
            (n * of_window(f"p{i}{j}") - sums[i] * sums[j]).cast("double")
            * F.lit(2.0 ** (LIMB * (i + j) - 2 * BITS) * (1 if i == j else 2))
            for i, j in PAIRS
        ]
        spread = F.greatest(sum(parts[::-1][1:], parts[-1]), F.lit(0.0))
        value = F.sqrt(spread / F.lit(float(n * (n - 1))))
    else:
        total = sum((sums[i].cast("double") * F.lit(2.0 ** (LIMB * i)) for i in LIMBS[1:]), sums[0])
        value = total / F.lit(float(n)) * F.lit(2.0**-BITS)
    return F.when(of_window("n") == n, value)


def add_rolling(df: DataFrame, w: WindowSpec, wanted: dict[str, Rolling]) -> DataFrame:
    """Add the ``wanted`` columns, by name, over the order of ``w``.

    A row's window must lie in its partition, which may have 2**26 rows.
    """
    columns = {r.column for r in wanted.values()}
    deviates = {c: any(r.deviation for r in wanted.values() if r.column == c) for c in columns}
    helpers: list[str] = []

    def add(made: dict[str, Column]) -> None:
        nonlocal df
        df = df.withColumns(made)
        helpers.extend(made)

    ordered = sorted(columns)
    add({f"_{c}_{i}": limb for c in ordered for i, limb in enumerate(_limbs(c))})
    add({f"_{c}_now": _running(c, deviates[c], w) for c in ordered})
    reaches = sorted({(r.column, r.rows) for r in wanted.values()})
    add({f"_{c}_{n}_back": F.lag(f"_{c}_now", n).over(w) for c, n in reaches})
    values = {
        name: _value(r, F.col(f"_{r.column}_now"), F.col(f"_{r.column}_{r.rows}_back"))
        for name, r in wanted.items()
    }
    return df.withColumns(values).drop(*helpers)

