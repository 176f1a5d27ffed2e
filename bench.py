"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Every query is executed to completion through the ``noop``
sink (full computation, nothing collected) except the learning run, whose
product is a handful of metrics.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerowx.operators.observations import complete_lists  # noqa: E402
from aerowx.operators.packed import pack, widen_packed  # noqa: E402
from aerowx.operators.windows import ORIGIN, attach_window  # noqa: E402
from aerowx.plans import preprocess as PP  # noqa: E402
from aerowx.plans.learn import learn  # noqa: E402
from aerowx.session import get_spark, scratch_path  # noqa: E402
from aerowx.sources import chunks as CH  # noqa: E402
from aerowx.sources import fixtures as FX  # noqa: E402
from aerowx.sources.liststore import store_lists  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = {"spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = get_spark("aerowx-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus, conf=conf)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aerowx-bench-"))

    def inputs():
        return FX.flights(spark, sf_dir), FX.weather(spark, sf_dir), FX.stations(spark, sf_dir)

    def run_noop(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    failed: dict[str, str] = {}

    def timed(name, fn):
        """Time one query and report it on stderr as it ends; a failing one
        is noted and does not lose the others."""
        t = time.perf_counter()
        try:
            fn()
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e).splitlines()[0][:300]
            print(f"{name}: failed: {failed[name]}", file=sys.stderr, flush=True)
            return
        timings[name] = round(time.perf_counter() - t, 3)
        print(f"{name}: {timings[name]} s", file=sys.stderr, flush=True)

    # warm-up: JVM, parquet footers, codegen caches (not timed)
    f, w, s = inputs()
    run_noop(PP.prepare(f, w, s).trips)

    def q_observations():
        f, w, s = inputs()
        run_noop(PP.prepare(f, w, s).observations)

    def q_origin_window():
        f, w, s = inputs()
        p = PP.prepare(f, w, s)
        run_noop(attach_window(p.trips, complete_lists(p.observations), *ORIGIN))

    def q_ml_table_list():
        run_noop(PP.ml_table(*inputs(), method="list"))

    def q_ml_table_frame():
        run_noop(PP.ml_table(*inputs(), method="frame"))

    def q_ml_table_shuffled():
        """The path that large lists take: no broadcast, lists stored in
        buckets, hash tables per partition."""
        keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
        before = {k: spark.conf.get(k, None) for k in keys}
        for k in keys:
            spark.conf.set(k, "-1")
        try:
            p = PP.prepare(*inputs())
            with store_lists(pack(complete_lists(p.observations))) as store:
                run_noop(widen_packed(PP.packed_windows(p, colocate=True, persist_lists=store)))
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    def q_write_chunks():
        CH.write_chunks(PP.ml_table(*inputs()), scratch_path(spark, "bench-chunks"))

    def q_learn():
        ml = PP.ml_table(*inputs())
        learn(ml, threshold=45, num_trees=10)  # depth 20, 270 bins

    timed("observations", q_observations)
    timed("origin_window", q_origin_window)
    timed("ml_table_list", q_ml_table_list)
    timed("ml_table_frame", q_ml_table_frame)
    timed("ml_table_shuffled", q_ml_table_shuffled)
    timed("write_chunks", q_write_chunks)
    timed("learn_forest", q_learn)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {"metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
              "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(result | ({"failed": failed} if failed else {})))
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
