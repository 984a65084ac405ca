"""Headline benchmark: runs the B1–B7 queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is run once to warm up (JIT, file listing) and then timed on a second run; results
are consumed with a full action (``count`` of the final DataFrame, or a ``noop`` write for
index builds) so the whole plan executes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from searchlake.session import get_session, table  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="searchlake-bench")

    from searchlake.operators import facets as fc
    from searchlake.operators import grouping as grp
    from searchlake.operators import index as ix
    from searchlake.operators import scoring, signatures

    T = lambda n: table(spark, sf_dir, n)

    def b1():
        return fc.facet_field(T("lineitem"), "l_returnflag")

    def b2():
        return fc.facet_range(T("orders"), "o_orderdate", "1992-01-01T00:00:00Z", "2002-01-01T00:00:00Z",
                              "+1MONTH", other="all")

    from searchlake.session import scratch_dir
    index_dir = scratch_dir(spark, "bench-index")

    def b3():
        # build + persist (postings sorted by term, stats from the written postings)
        d = T("documents")
        ix.write_index(ix.build_index(d, "doc_id", "text"), index_dir, docs=d)
        return spark.read.parquet(f"{index_dir}/field_stats")

    def b4():
        idx = ix.read_index(spark, index_dir)
        return scoring.top_hits(scoring.bm25(idx, ["the", "ment", "eau"]), 10)

    def b5():
        return fc.facet_pivot(T("lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])

    def b6():
        o = T("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        return grp.group_by_field(o, "o_custkey", key="o_orderkey", sort="o_totalprice desc", limit=-1,
                                  group_limit=3)

    def b7():
        d = T("documents")
        s = signatures.signature_text_profile(d, "doc_id", "text")
        return signatures.dedupe_by_signature(s, "signature", "doc_id")

    benches = {"b1_facet_field": b1, "b2_facet_range_month": b2, "b3_index_build": b3,
               "b4_bm25_top10": b4, "b5_pivot_3_levels": b5, "b6_group_top3": b6, "b7_text_profile_dedupe": b7}
    only = [a for a in sys.argv[1:]]
    times = {}
    for name, fn in benches.items():
        if only and not any(o in name for o in only):
            continue
        for attempt in range(2):
            t0 = time.time()
            df = fn()
            df.write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
        times[name] = round(dt, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "searchlake_bench_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
