"""How the ordered operators grow with rows: ``python -m checks.growth [rows ...]``. Scores are made by Spark; six members in ten share one."""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, functions as F

from checks.session import local_session
from swayline.operators import curves
from swayline.operators.running import exact_percentiles
from swayline.sources.storage import materialise


def score_table(spark, rows: int) -> DataFrame:
    mixed = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    return materialise(spark.range(rows).select(
        F.col("id").alias("member_id"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3).cast("int").alias("y"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2)).cast("int").alias("treatment"),
        F.when(mixed % 10 < 6, 0.25).otherwise(mixed / F.lit(1024.0)).alias("uplift"), (mixed / F.lit(7.0)).alias("a"), F.sqrt(mixed.cast("double")).alias("b")), "growth")


CASES = {
    "gain curve": lambda df: curves.qini_gain_curve(df),
    "optimal target": lambda df: curves.optimal_target(df),
    "first 1000 ranks": lambda df: curves.rank_members(df, first=1000),
    "Qini area": lambda df: curves.qini_auc(df),
    "quartiles by arm": lambda df: exact_percentiles(df, ["uplift", "a", "b"], [(1, 4), (1, 2), (3, 4)], ["treatment"]),
}


def main() -> None:
    spark = local_session(memory="16g")
    for rows in [int(a) for a in sys.argv[1:]] or [1_000_000, 5_000_000]:
        df = score_table(spark, rows)
        for name, case in CASES.items():
            start = time.perf_counter()
            case(df).write.format("noop").mode("overwrite").save()
            print(f"{rows} | {name} | {time.perf_counter() - start:.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
