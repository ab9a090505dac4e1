"""Small column functions shared by the layers. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concentration units and their factor to mol/L.
MOLAR_FACTORS = {"M": 1.0, "uM": 1e-6, "nM": 1e-9, "pM": 1e-12}

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_fp(x: ColumnOrName, digits: int) -> Column:
    """Round half away from zero on the binary value.

    Spark's own ``round`` works on the decimal text of a double, so 1.005 becomes 1.01;
    the analytical marts need the binary-value rounding other SQL engines use. Values from
    2**52 / 10**digits on have no digits to round and pass as they are, like infinity and NaN.
    """
    x = _col(x)
    scale = float(10**digits)
    scaled = F.abs(x) * F.lit(scale)
    whole = F.floor(scaled)
    # scaled + 0.5 may itself round up, so the fraction is looked at instead.
    rounded = F.signum(x) * F.when(scaled - whole >= 0.5, whole + 1).otherwise(whole) / F.lit(scale)
    return F.when(scaled < F.lit(2.0**52), rounded).otherwise(x)


def one_decimal(x: ColumnOrName) -> Column:
    """Text of a number with one decimal, rounded on the binary value; exact ties go to the even digit.

    x * 16 and x * 4 are exact, so ``error`` is what their sum lost: it tells on which side of a tie
    10 x * 2 lies when the rounded product sits on one.
    """
    value = _col(x).cast("double")
    x = F.abs(value)
    big, small = x * F.lit(16.0), x * F.lit(4.0)
    double = big + small
    error = small - (double - big)
    below = F.floor(double / 2)
    fraction = double / 2 - below
    up = (fraction > 0.5) | ((fraction == 0.5) & ((error > 0) | ((error == 0) & (below % 2 == 1))))
    tenths = (below + F.when(up, 1).otherwise(0)).cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("string"))


def try_int(x: ColumnOrName, target: str = "int") -> Column:
    """Text or number to integer; '5.0' and '5' are both 5, unreadable text is NULL. Plain integers stay exact.

    The text's shape decides how it is read: a cast that fails is caught as an exception, row by row.
    """
    x = _col(x)
    text = x.cast("string")
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.when(whole, text.try_cast(target)).otherwise(F.rint(x.try_cast("double")).try_cast(target))


def molar_potency(value: ColumnOrName, unit: ColumnOrName) -> Column:
    """-log10 of a concentration in mol/L; NULL for unknown units or values <= 0."""
    unit, value = _col(unit), _col(value)
    factor = F.lit(None).cast("double")
    for name, scale in MOLAR_FACTORS.items():
        factor = F.when(unit == name, F.lit(scale)).otherwise(factor)
    return F.when(value > 0, -F.log10(value * factor))


def display_name(source: ColumnOrName) -> Column:
    """First letter upper-cased, the rest left as it is (``initcap`` would lower it)."""
    source = _col(source)
    return F.concat(F.upper(F.substring(source, 1, 1)), F.substr(source, F.lit(2)))


def lookup_label(code: ColumnOrName, labels: Iterable[tuple[str, str]]) -> Column:
    """Code to display label through a literal map; unknown codes pass through."""
    code = _col(code)
    pairs = [F.lit(v) for pair in labels for v in pair]
    if not pairs:
        return code
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def heavy_atom_efficiency(potency: ColumnOrName, heavy_atoms: ColumnOrName) -> Column:
    """Ligand efficiency, 1.37 * p / heavy atoms; NULL when undefined."""
    heavy_atoms = _col(heavy_atoms)
    return F.when(heavy_atoms != 0, F.lit(1.37) * _col(potency) / heavy_atoms)


def lipophilic_efficiency(potency: ColumnOrName, logp: ColumnOrName) -> Column:
    """Lipophilic efficiency, p - logP."""
    return _col(potency) - _col(logp)
