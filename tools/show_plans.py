"""Print the physical plans of the key operators as they would run at scale.

Broadcast joins are switched off (at 100 TB no vault table fits), so the
plans show which inputs are exchanged: the daily hub load and satellite
change detection read the bucketed history without any exchange, and the
star join exchanges only the re-keyed sides.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from vaultmart.operators import vault
    from vaultmart.plans import marts
    from vaultmart.plans.pipeline import SATELLITES, Pipeline
    from vaultmart.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    run = Pipeline(spark, sf_dir, buckets=8).run()
    sat = vault.load_satellite(
        run.staged("stg_owners", 3), "owner_hk", SATELLITES["sat_owner_details"][2],
        run.store.read_open("sat_owner_details", 2), None, materialize=run._materializer("show_plans", 3))
    plans = {
        "satellite write, untouched rows": run.store._by_bucket(sat.untouched, "owner_hk"),
        "satellite write, touched rows": run.store._by_bucket(sat.touched, "owner_hk"),
        "hub load (batch 3 against batches 1-2)": vault.load_hub(
            run.staged("stg_transactions", 3), "transaction_hk", "transaction_id",
            run.hub("hub_transaction", 2)),
        "satellite change detection": vault.changed_rows(
            run.staged("stg_properties", 3).select("property_hk", "hashdiff", "load_date"),
            "property_hk", run.store.read_open("sat_property_details", 2)),
        "satellite history with version numbers": vault.history(
            run.satellite("sat_property_details", 3), "property_hk"),
        "M1 star join": marts.mart_property_sales(run.vault_view(3)),
    }
    for title, df in plans.items():
        print(f"==== {title}")
        plan = df._jdf.queryExecution().executedPlan().toString()
        shown = [line for line in plan.splitlines()
                 if any(k in line for k in ("Join", "Exchange", "Window", "FileScan", "Scan "))]
        print("\n".join(shown))
        print(f"exchanges: {plan.count('Exchange hashpartitioning')}\n")
    spark.stop()


if __name__ == "__main__":
    main()
