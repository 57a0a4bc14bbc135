"""User functions and systematic variations of a configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP = "#"  # fixed mark: leave the default value


def skim(df: DataFrame, fn: Callable[..., DataFrame], **args) -> DataFrame:
    """Run a user function on the lazy table; it stays part of one plan."""
    return df.transform(lambda d: fn(d, **args))


def expand_variations(defaults: Mapping[str, str], variations: DataFrame) -> DataFrame:
    """Full parameter set of every active variation: (category, variation, idx, param, value, changed).

    ``variations``: category, variation, idx, active, param, value.  The value ``#``
    keeps the default; parameters that the configuration does not know are ignored.
    The defaults are configuration, so they enter as literals.
    """
    chosen = variations.where("active").groupBy("category", "variation", "idx").agg(
        F.map_from_entries(F.collect_list(F.struct("param", "value"))).alias("m"))
    base = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])
    full = chosen.select("category", "variation", "idx", "m", F.explode(base).alias("param", "default"))
    new = F.try_element_at("m", F.col("param"))
    changed = new.isNotNull() & (new != KEEP)
    return full.select("category", "variation", "idx", "param", F.when(changed, new).otherwise(F.col("default")).alias("value"), changed.alias("changed"))
