"""Run in its own process: tasks fail on their first attempt, Spark retries."""

import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from strata.operators import gold, silver  # noqa: E402
from strata.plans import jobs  # noqa: E402
from strata.plans.tables import Lake  # noqa: E402
from strata.registry import LIMITS  # noqa: E402
from strata.session import build_session  # noqa: E402


def _fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    sf_dir = sys.argv[1]
    spark = build_session("local[4,3]", app_name="strata-retry", shuffle_partitions=8)
    flaky = F.udf(_fail_first_attempt, T.BooleanType())
    lake = Lake(spark, tempfile.mkdtemp(prefix="retry-lake-"), prefix="retry_")
    bronze = jobs.bronze_from_tables(spark, sf_dir, loaded_at="l").filter(flaky(F.lit(1)))
    landed = jobs.land_bronze(lake, bronze)
    stats = jobs.build_silver(lake, processed_at="p", limits=LIMITS).collect()
    stg = gold.staging(lake.table("silver", jobs.TRIPS).read()).filter(flaky(F.lit(1)))
    fact = gold.fact_trips(stg).filter(flaky(F.lit(2)))  # second injection after the window shuffle
    keys = fact.select("trip_sk").collect()
    clean = silver.clean(jobs.bronze_from_tables(spark, sf_dir, loaded_at="l"), LIMITS).count()
    print(
        json.dumps(
            {
                "landed": landed["rows"],
                "bronze_rows": lake.table("bronze", jobs.TRIPS).read().count(),
                "silver_rows": sum(r.output_rows for r in stats),
                "expected_silver": clean,
                "fact_rows": len(keys),
                "distinct_keys": len({r.trip_sk for r in keys}),
            }
        )
    )


if __name__ == "__main__":
    main()
