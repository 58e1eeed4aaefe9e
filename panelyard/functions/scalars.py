"""Column functions: missing tokens, units, labels, keys, transforms, masks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "missing", and texts of an inactive result.
MISSING = ("", "nan", "none", "null", "na", "<na>", "n/a")
INACTIVE = ("inactive", "not active")
# Factors to nM.
UNIT_FACTORS = {"nm": 1.0, "um": 1e3, "µm": 1e3, "μm": 1e3, "mm": 1e6, "m": 1e9}


def is_missing(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*MISSING)


def is_inactive(c: Column) -> Column:
    """Never null: an absent comment is not inactive."""
    return F.coalesce(F.lower(F.trim(c)).isin(*INACTIVE), F.lit(False))


def to_number(c: Column) -> Column:
    """Double; null for what is not a finite number."""
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def unit_factor(units: Column) -> Column:
    u = F.lower(F.trim(units))
    return reduce(lambda w, kv: w.when(u == kv[0], kv[1]), list(UNIT_FACTORS.items())[1:], F.when(u == "nm", 1.0))


def label_of(direct: Column, nm: Column) -> Column:
    """The direct value, else 9 - log10(nM) of a positive concentration."""
    return F.coalesce(direct, F.when(nm > 0, 9 - F.log10(F.when(nm > 0, nm))))


def key_text(c: Column) -> Column:
    """Text key: trimmed, lower case, white space collapsed; null when empty."""
    return F.nullif(F.lower(F.regexp_replace(F.trim(c), r"\s+", " ")), F.lit(""))


def largest_fragment(c: Column, separator: str = ".") -> Column:
    """Lexical structure key: the longest fragment that holds a carbon letter, else the longest of all; the first of equals."""
    parts = F.filter(F.transform(F.split(c, F.lit("\\" + separator)), lambda x: F.trim(x)), lambda x: x != "")
    carbon = F.filter(parts, lambda x: F.contains(F.lower(x), F.lit("c")))
    pool = F.when(F.size(carbon) > 0, carbon).otherwise(parts)
    return F.nullif(F.aggregate(pool, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best)), F.lit(""))


def sigmoid(x: Column, center: float, k: float = 1.0) -> Column:
    return 1 / (1 + F.exp(-k * (x - center)))


def reverse_sigmoid(x: Column, center: float, k: float = 1.0) -> Column:
    return 1 - sigmoid(x, center, k)


def double_sigmoid(x: Column, low: float, high: float, k: float = 1.0) -> Column:
    return sigmoid(x, low, k) * reverse_sigmoid(x, high, k)


TRANSFORMS: dict[str, tuple[Callable[..., Column], frozenset[str]]] = {
    "sigmoid": (sigmoid, frozenset({"center"})),
    "reverse_sigmoid": (reverse_sigmoid, frozenset({"center"})),
    "double_sigmoid": (double_sigmoid, frozenset({"low", "high"})),
}


def transformed(name: str, x: Column, **params: float) -> Column:
    """A transform by name; unknown names and wrong parameters are errors when the plan is made."""
    if name not in TRANSFORMS:
        raise ValueError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}")
    made, needed = TRANSFORMS[name]
    if not needed <= params.keys() <= needed | {"k"}:
        raise ValueError(f"{name} takes {sorted(needed)} and k, not {sorted(params)}")
    return made(x, **params)


def masked_address(c: Column) -> Column:
    """Mail addresses cut to the first characters of their two parts."""
    return F.regexp_replace(c, r"([A-Za-z0-9])[^@\s]*@([A-Za-z0-9])\S*", "$1***@$2***")


def hash_bucket(c: Column, seed: int = 0) -> Column:
    """0 to 2^32 - 1 from an integer id, on any partitioning alike."""
    return (c % 1000003 * 2654435761 + seed * 40503) % 4294967296


DESCRIPTORS: dict[str, Callable[[str], Column]] = {
    "n_chars": lambda c: F.length(c),
    "n_lines": lambda c: F.size(F.split(c, "\n")),
    "n_words": lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda w: w != "")),
    "n_digits": lambda c: F.length(c) - F.length(F.translate(F.col(c), "0123456789", "")),
    "n_commas": lambda c: F.length(c) - F.length(F.replace(F.col(c), F.lit(","), F.lit(""))),
}
DEFAULT_DESCRIPTORS = ("n_chars", "n_lines", "n_words")


def descriptors(column: str, names: list[str] | None = None) -> list[Column]:
    """Named descriptor columns: the default ones when names is None, none when it is empty; unknown names are errors."""
    wanted = DEFAULT_DESCRIPTORS if names is None else names
    if unknown := [n for n in wanted if n not in DESCRIPTORS]:
        raise ValueError(f"unknown descriptors {unknown}; known: {sorted(DESCRIPTORS)}")
    return [DESCRIPTORS[n](column).cast("bigint").alias(n) for n in wanted]


def group_key(group: Column, own: Column) -> Column:
    """The group's name; where it is null or empty, the row's own key."""
    return F.coalesce(F.nullif(group, F.lit("")), own)
