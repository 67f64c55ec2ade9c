"""Seconds per headline query, the median of BENCH_RUNS runs (3): one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores.

duckdb holds the seconds of the same queries as SQL in DuckDB with as many threads, over the same files.
"""

import json
import os
import statistics
import time
from collections.abc import Callable

from probeloom import plans
from probeloom.plans.registry import TABLES
from probeloom.session import local_session

HEADLINE = (
    "sample_summary", "repool_decision", "dense_umi_table", "combine_runs", "assign_haplotype_ids", "estimate_copy_counts", "redistribute_multimapped", "haplotype_fraction_filter",
    "call_genotypes", "keep_variants", "prevalence_by_site", "aggregate_aa", "merge_intervals", "overlap_join", "subtract_intervals", "probe_normalize", "integer_calls",
)


def medians(run: Callable[[str], object]) -> dict[str, float]:
    """All queries in turn, several times over."""
    took: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for name in HEADLINE:
            began = time.time()
            run(name)
            took[name].append(time.time() - began)
    return {name: round(statistics.median(x), 3) for name, x in took.items()}


def duckdb_seconds(sf_dir: str, cores: int) -> dict[str, float]:
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect(config={"threads": cores})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return medians(lambda name: con.execute(plans.ORACLE[name]).fetchall())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cores, memory="16g", partitions=cores)
    plans.QUERIES["sample_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the engine and compiles
    took = medians(lambda name: plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    other = duckdb_seconds(sf_dir, cores)
    line = {"metric": "headline queries, total wall time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
    print(json.dumps(line | {"duckdb_value": round(sum(other.values()), 3), "duckdb": other}))


if __name__ == "__main__":
    main()
