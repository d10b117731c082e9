"""Column expressions shared by the operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` only,
so all of it stays inside whole-stage code generation.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens import config as C

#: 15 hex digits of md5 = 60 bits, which fit a signed BIGINT.
HASH_BITS = 60
HASH_SPACE = 1 << HASH_BITS
#: Marker for a NULL field inside a hash key (``concat_ws`` would skip it).
NULL_MARK = "\\N"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` when the denominator is positive, else the
    undivided numerator as a double (NULL denominators take that branch too)."""
    num, den = col(numerator), col(denominator)
    return F.when(den > 0, num / den).otherwise(num.cast("double"))


def flag(condition: Column) -> Column:
    """A boolean condition as a 0/1 integer (NULL stays NULL)."""
    return condition.cast("int")


def rule_holds(sql_predicate: str) -> Column:
    """A named data-quality rule: it holds only when its predicate is TRUE."""
    return F.coalesce(F.expr(sql_predicate), F.lit(False))


def all_rules_hold(rules: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [rule_holds(e) for e in rules.values()])


def risk_band(probability: str | Column) -> Column:
    """BAJO / MEDIO / ALTO on right-closed bands; NULL or NaN gives NULL."""
    p = col(probability)
    return (
        F.when(p.isNull() | F.isnan(p), F.lit(None).cast("string"))
        .when(p <= C.BAND_LOW_MAX, F.lit(C.BAND_LOW))
        .when(p <= C.BAND_MEDIUM_MAX, F.lit(C.BAND_MEDIUM))
        .otherwise(F.lit(C.BAND_HIGH))
    )


def key_field(c: str, dtype: str) -> Column:
    """One field of a hash key as text; doubles go through decimal(38,2) so
    the text does not depend on an engine's double formatting (a value out
    of that range, or NaN, becomes the NULL marker instead of an error)."""
    value = F.col(c)
    if dtype in ("double", "float"):
        value = value.try_cast("decimal(38,2)")
    return F.coalesce(value.cast("string"), F.lit(NULL_MARK))


def row_key(df, columns: list[str], seed: int) -> Column:
    """A text key of the listed columns, prefixed with the seed."""
    types = dict(df.dtypes)
    return F.concat_ws("|", F.lit(str(seed)), *[key_field(c, types[c]) for c in columns])


def hash60(key: Column, part: int = 0) -> Column:
    """60 uniformly distributed bits of ``md5(key)`` as a BIGINT in [0, 2^60).

    ``part`` 0 uses hex digits 1-15, part 1 digits 16-30, so two parts of the
    same key are independent draws.
    """
    return F.conv(F.substring(F.md5(key), 1 + 15 * part, 15), 16, 10).cast("bigint")


def fraction_cut(fraction: float) -> int:
    """Exact integer threshold: ``hash < cut`` has probability ``fraction``."""
    return int(Fraction(str(fraction)) * HASH_SPACE)


def positive_probability(vector_col: str | Column) -> Column:
    """Probability of class 1 out of an ML probability vector, JVM-side."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(col(vector_col)).getItem(1)


def tolerant_cast(c: Column, source: str, target: str) -> Column:
    """``c`` of type ``source`` as ``target``, NULL where it doesn't parse: text
    like `30.0` is the whole number 30 (decimals are cut off), NaN and
    infinities are NULL."""
    if source in ("double", "float"):
        c = F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    if source == "string":
        if target in ("int", "bigint", "smallint", "tinyint"):
            return F.trim(c).try_cast("decimal(38,10)").try_cast(target)
        if target in ("double", "float"):
            number = F.trim(c).try_cast("double")
            return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number).cast(target)
    return c.try_cast(target)
