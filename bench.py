"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3): each query
runs once to warm up (skipped when BENCH_RUNS is 1) and its median time is reported.  Results are fully
computed and thrown away (noop sink).  The claim, beneficiary and raw tables are made from the test tables
once beforehand, and so are the tables that several queries read (features, scenarios, forest); that time is
reported as load_sec, part by part in load_parts.  So is the boosted model (300 rounds, trained once, then read from its node
table).  The streaming refresh runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ledgerlark.checks import learning_checks, registry, score_checks
from ledgerlark.session import local_session
from ledgerlark.sources import sample_views

HEADLINE = [
    "feat_provider_year",
    "feat_code_mix",
    "feat_near_dups",
    "feat_ratio_p95",
    "claim_clean",
    "bene_clean",
    "outpatient_clean",
    "claim_dedup",
    "merge_insert_ignore",
    "dup_claim_pairs",
    "inc_history_semijoin",
    "inc_next_batch",
    "inc_refresh",
    "score_decile",
    "if_train_nodes",
    "if_score",
    "explain_shapley",
    "explain_reason_text",
    "inj_phantom_rows",
    "sup_gbt",
    "sup_metrics_by_scenario",
    "reg_promote",
    "rpt_overview",
]
ONCE = ["stream_refresh"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="ledgerlark-bench")
    queries = registry.queries()
    parts: dict[str, float] = {}
    for part, build in (
        ("raw_views", lambda: sample_views.stage(spark, sf_dir)),
        ("features", lambda: score_checks.feature_table(spark, sf_dir)),
        ("scenarios", lambda: learning_checks.labelled(spark, sf_dir)),
        ("forest", lambda: score_checks.model(spark, sf_dir)),
        ("boosted", lambda: learning_checks.boosted_model(spark, sf_dir)),
    ):
        started = time.perf_counter()
        build()
        parts[part] = round(time.perf_counter() - started, 3)
    times: dict[str, float] = {}
    for name in [*HEADLINE, *ONCE]:
        taken = []
        for _ in range(runs if name in HEADLINE else 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    result = {
        "metric": "headline queries, sum of median warm seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "load_sec": round(sum(parts.values()), 3),
        "load_parts": parts,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
