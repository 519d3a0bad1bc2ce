"""Scalar column expressions used by the cleaning, payload and synthesis operators.

All builders return ``Column`` objects made from built-in Spark SQL functions,
so they are evaluated JVM-side in generated code - no Python UDFs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's constants.
# ---------------------------------------------------------------------------
# Tokens pandas' CSV reader treats as missing by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
UNKNOWN = "Unknown"
OTHER = "Other"
# Origin normalisation: first matching rule wins, in this order.
ORIGIN_RULES = (
    (("human",), "Human"),
    (("mutate", "mutant"), "Mutant"),
    (("asgardian",), "Asgardian"),
    (("alien",), "Alien"),
    (("symbiote",), "Symbiote"),
    (("robot",), "Robot"),
    (("cosmic being",), "Cosmic Being"),
)
MAGIC_KEYWORDS = ("magic",)
MUTANT_KEYWORDS = ("mutate", "mutant")
IDENTITY_VALUES = ("Public", "Secret", "Unknown")
GENDER_VALUES = ("Male", "Female")
MARITAL_VALUES = ("Single", "Married", "Widowed", "Engaged", "Unknown")
ALIVE_VALUES = ("Alive", "Dead")
# ---------------------------------------------------------------------------

UNIFORM_HEX, UNIFORM_RANGE = 13, 4503599627370496.0  # 52 bits of an md5: exact in a double


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Text equal to one of ``tokens`` becomes null (pandas' missing-value reading)."""
    c = as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def nan_to_null(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def fill_unknown(c: str | Column, token: str = UNKNOWN) -> Column:
    return F.coalesce(as_col(c), F.lit(token))


def replace_value(c: str | Column, old: str, new: str) -> Column:
    """Whole-value replacement; other values (and nulls) pass unchanged."""
    c = as_col(c)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def presence_flag(c: str | Column) -> Column:
    return as_col(c).isNotNull().cast("int")


def whitelist_other(c: str | Column, allowed: Sequence[str], other: str = OTHER) -> Column:
    """Values outside ``allowed`` (nulls included) become ``other``."""
    c = as_col(c)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(other))


def _contains_any(lowered: Column, keywords: Sequence[str]) -> Column:
    cond = None
    for kw in keywords:
        term = lowered.contains(kw.lower())
        cond = term if cond is None else (cond | term)
    return cond


def keyword_flag(c: str | Column, keywords: Sequence[str]) -> Column:
    """1 if the lower-cased text contains any keyword, else 0 (null text -> 0)."""
    return F.coalesce(_contains_any(F.lower(as_col(c)), keywords).cast("int"), F.lit(0))


def keyword_category(c: str | Column, rules: Sequence[tuple[Sequence[str], str]],
                     default: str = OTHER) -> Column:
    """First matching rule wins; rules are ``(keywords, label)`` pairs in priority order."""
    lowered = F.lower(as_col(c))
    out = None
    for keywords, label in rules:
        cond = _contains_any(lowered, keywords)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def binary_target(c: str | Column, positive: str) -> Column:
    """1 where the value equals ``positive``, else 0 (nulls -> 0, as pandas' ``==``)."""
    return F.coalesce((as_col(c) == F.lit(positive)).cast("int"), F.lit(0))


def epoch_ms(ts: str | Column) -> Column:
    """Whole seconds since the epoch times 1000 (sub-second part dropped).

    Works for TIMESTAMP and TIMESTAMP_NTZ; the session must be UTC so the
    NTZ -> TIMESTAMP cast shifts nothing.
    """
    return F.unix_seconds(as_col(ts).cast("timestamp")) * F.lit(1000)


def clip_scale(c: str | Column, floor: float = 0.1, factor: float = 1.0) -> Column:
    """``max(floor, c) * factor`` with null kept null (``greatest`` alone skips nulls)."""
    c = as_col(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(floor)), c.cast("double")) * F.lit(float(factor)))


def label_text(c: str | Column) -> Column:
    """1 -> "alive", anything else -> "dead"."""
    return F.when(as_col(c) == 1, F.lit("alive")).otherwise(F.lit("dead"))


def hash_text(seed: str | int, *cols: str | Column) -> Column:
    """md5 hex of ``seed:col1:col2...`` - identical in Spark SQL and DuckDB; a null counts as ``\\N``."""
    parts = [F.lit(str(seed))] + [F.coalesce(as_col(c).cast("string"), F.lit("\\N")) for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def md5_uniform(seed: str | int, *cols: str | Column) -> Column:
    """Uniform in [0, 1): first 52 bits of md5(seed:cols) / 2^52.

    Independent of partitioning, so reruns and other engines agree.
    """
    h = hash_text(seed, *cols)
    return F.conv(F.substring(h, 1, UNIFORM_HEX), 16, 10).cast("long") / F.lit(UNIFORM_RANGE)


def md5_open_uniform(seed: str | int, *cols: str | Column) -> Column:
    """Uniform in (0, 1): (first 52 bits + 0.5) / 2^52, safe for logarithms."""
    h = hash_text(seed, *cols)
    return (F.conv(F.substring(h, 1, UNIFORM_HEX), 16, 10).cast("long") + F.lit(0.5)) / F.lit(UNIFORM_RANGE)


def md5_normal(seed: str | int, *cols: str | Column) -> Column:
    """Standard normal draw by Box-Muller over two independent md5 uniforms."""
    u1 = md5_open_uniform(f"{seed}:n1", *cols)
    u2 = md5_open_uniform(f"{seed}:n2", *cols)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def md5_parity_arm(c: str | Column, odd: str = "A", even: str = "B") -> Column:
    """Arm by parity of md5(id as text) read as a number: odd -> ``odd``."""
    last_digit = F.conv(F.substring(F.md5(as_col(c).cast("string")), 32, 1), 16, 10).cast("int")
    return F.when(last_digit % 2 == 1, F.lit(odd)).otherwise(F.lit(even))
