"""Scalar functions (K1, K2, L1-L9) as native Spark expressions.

K1 is the JVM string hash ``s[0]*31^(n-1) + ... + s[n-1]`` over UTF-16 code
units, times a factor, wrapped to a signed 32-bit int.  It is written as a
SQL expression -- the string's UTF-16 code units, as 4-digit hex, folded
once -- so it runs inside the JVM with no Python round trip, and the same
text backs the SQL function.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from eventide.functions.time import ms_to_ntz

_TWO32 = 4294967296
_TWO31 = 2147483648


def hash_code_sql(arg: str, factor: int = 1) -> str:
    """SQL text of ``arg.hashCode * factor`` (32-bit wrap), null for null."""
    units = f"regexp_extract_all(hex(encode({arg}, 'UTF-16BE')), '([0-9A-F]{{4}})', 1)"
    fold = (f"aggregate({units}, CAST(0 AS BIGINT), "
            f"(acc, u) -> pmod(acc * 31 + CAST(conv(u, 16, 10) AS BIGINT), {_TWO32}))")
    # pmod(x + 2^31, 2^32) - 2^31 is x wrapped to a signed 32-bit value; an
    # empty string folds to 0 and a null string stays null.
    return f"CAST(pmod(({fold}) * {int(factor)} + {_TWO31}, {_TWO32}) - {_TWO31} AS INT)"


def hash_code(col: str, factor: int = 1) -> Column:
    """K1: DataFrame form of the hash UDF with a constructor parameter."""
    return F.expr(hash_code_sql(f"`{col}`", factor))


def register_hash_code(spark: SparkSession, name: str = "hash_code", factor: int = 10) -> None:
    """K2: register the hash as a SQL function ``name(s STRING) RETURNS INT``."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT "
              f"RETURN {hash_code_sql('s', factor)}")


def split_keep_java(col: Column | str, sep_regex: str) -> Column:
    """L1: regex split with trailing empty strings removed (JVM ``String.split``).

    An input with no separator match stays a one-element array (so '' gives
    ['']); otherwise trailing empty pieces are dropped.
    """
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, sep_regex)
    # Drop trailing empties: keep elements up to the last non-empty one.
    last_nonempty = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    trimmed = F.slice(parts, 1, last_nonempty)
    return F.when(F.size(parts) == 1, parts).otherwise(
        F.when(last_nonempty == 0, F.array().cast("array<string>")).otherwise(trimmed))


def epoch_ms_text(col: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Epoch ms -> timestamp text (UTC wall clock)."""
    c = F.col(col) if isinstance(col, str) else col
    # Through a zone-free timestamp: the text is the same in every session zone.
    return F.date_format(ms_to_ntz(c), fmt)
