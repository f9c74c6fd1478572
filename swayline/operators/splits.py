"""Deterministic splits: a member's side depends on its id and a seed, so lost tasks recompute the same rows."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from swayline.functions.columns import hash32, hash_share
from swayline.operators.running import exact_percentiles


def in_holdout(member: Column, seed: int | str = 42, share: float = 0.2) -> Column:
    return hash_share(member, F.lit(seed)) < share


def hold_out(df: DataFrame, seed: int | str = 42, share: float = 0.2,
             member: str = "member_id") -> tuple[DataFrame, DataFrame]:
    """(train, held out). Each arm is hit at the same rate because the hash does not know the arm.

    Splitting a part again needs another seed: with the same one the same members would be drawn.
    """
    side = in_holdout(F.col(member), seed, share)
    return df.filter(~side), df.filter(side)


def stratified_hold_out(df: DataFrame, by: str = "treatment", seed: int | str = 42, share: tuple[int, int] = (1, 5),
                        member: str = "member_id") -> tuple[DataFrame, DataFrame]:
    """(train, held out) with exactly the share of every arm, rounded up: members with the lowest hashes.

    Two members of an arm with the same 32-bit hash at the cut stay together.
    """
    hashed = df.withColumn("_share", hash_share(F.col(member), F.lit(seed)))
    cuts = exact_percentiles(hashed, ["_share"], [share], [by]).select(F.col(by).alias("_arm"), F.col("value").alias("_cut"))
    marked = hashed.join(F.broadcast(cuts), F.col(by).eqNullSafe(F.col("_arm")))  # one row per arm, the missing one too
    low = F.col("_share") <= F.col("_cut")
    return tuple(marked.filter(side).select(df.columns) for side in (~low, low))


def fold_of(member: Column, folds: int, repeat: int = 0, seed: int = 42) -> Column:
    return (hash32(member, F.lit(seed), F.lit(repeat)) % folds).cast("int")


def draw_parameters(space: Mapping[str, Sequence], trials: int, seed: int = 42) -> list[dict]:
    """Independent uniform choices per parameter, the same list for the same seed."""
    rng = random.Random(seed)
    return [{name: rng.choice(list(options)) for name, options in space.items()} for _ in range(trials)]


def space_size(space: Mapping[str, Sequence]) -> int:
    size = 1
    for options in space.values():
        size *= len(options)
    return size
