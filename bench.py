"""Times the headline queries and prints one line of JSON.  BENCH_SF_DIR and BENCH_CPUS choose the tables and cores."""

from __future__ import annotations

import json
import os
import time

from skeinwork.plans import QUERIES
from skeinwork.session import get_spark

HEADLINE = [
    "inner_join_groupby_having", "left_join_default_if_empty", "semi_any", "lateral_top2_orders", "nth_order_dynamic_offset", "scalar_subquery_projection", "include_orders_collection", "union_distinct",
    "string_join_nulls_ordered", "filtered_aggregates", "count_distinct", "arithmetic", "string_replace_case_concat", "math_trig", "bitwise_shift", "date_parts", "offset_timestamps",
    "json_scalar_read", "json_rowset_aggregate", "json_set_replace_remove", "fulltext_boolean", "temporal_as_of", "temporal_all", "portion_update", "exec_update_join", "delete_limit_ordered", "spatial_predicates", "distance_sphere",
]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()  # starts the engine
    times: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
