import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal


from vaultmart.plans import marts
from vaultmart.plans.pipeline import Pipeline
from vaultmart.sources import files, fixtures
from vaultmart.streaming import feed_stream, micro_batch_loader

from conftest import SF_SMALL


def test_micro_batches_feed_the_vault(spark, run):
    """Two CSV drops through foreachBatch give the same hubs as the batch run."""
    root = f"{run.root}/stream"
    for b in (1, 2):
        raw = fixtures.property_raw(spark, SF_SMALL, b).drop("_loaded_at")
        files.write_property_csv(raw.coalesce(1), f"{root}/drops/d{b}")
    # one drop per directory; each stream run (availableNow) loads one drop as one batch
    p = Pipeline(spark, SF_SMALL, root=f"{root}/run")

    def crm(batch):
        return {"src_crm_owners": fixtures.with_loaded_at(fixtures.crm_owners(spark, SF_SMALL, batch), batch),
                "src_crm_agents": fixtures.with_loaded_at(fixtures.crm_agents(spark, SF_SMALL, batch), batch)}

    load = micro_batch_loader(p, crm, lambda b: fixtures.BATCH_LOADED_AT[b], with_marts=False)
    for b in (1, 2):  # one query; its epochs are given as two one-drop runs
        q = (feed_stream(spark, f"{root}/drops/d{b}")
             .writeStream.foreachBatch(lambda df, epoch, b=b: load(df, b - 1))
             .option("checkpointLocation", f"{root}/ckpt{b}")
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
    assert p.hub("hub_transaction", 2).count() == run.hub("hub_transaction", 2).count()
    assert p.hub("hub_property", 2).count() == run.hub("hub_property", 2).count()
    a = Counter(tuple(r) for r in p.satellite("sat_property_details", 2).drop("record_source").collect())
    b = Counter(tuple(r) for r in run.satellite("sat_property_details", 2).drop("record_source").collect())
    assert a == b


def _view(spark, n_tx=3000):
    """A tiny vault where one property and one agent hold a third of all sales
    and a fifth of the sales have no agent."""
    rnd = random.Random(5)
    D1 = dt.datetime(2024, 1, 1)
    tx, lp, la = [], [], []
    for i in range(n_tx):
        thk = f"t{i:05d}"
        prop = "p_hot" if i % 3 == 0 else f"p{rnd.randint(0, 50)}"
        agent = None if i % 5 == 0 else ("a_hot" if i % 3 == 1 else f"a{rnd.randint(0, 9)}")
        tx.append((thk, str(i), Decimal(rnd.randint(100000, 900000)), dt.date(2020, 1 + i % 12, 1),
                   dt.date(2020, 1 + i % 12, 2), 10 + i % 50, "auction"))
        lp.append((thk, prop, D1, "s"))
        la.append((thk, agent, D1, "s"))
    props = [f"p{i}" for i in range(51)] + ["p_hot"]
    agents = [f"a{i}" for i in range(10)] + ["a_hot"]
    s = spark.createDataFrame
    sat_t = s(tx, "transaction_hk string, transaction_id string, sale_price decimal(14,2), "
                  "sale_date date, settlement_date date, days_on_market int, sale_type string")
    view = marts.VaultView(
        hub_transaction=sat_t.select("transaction_hk", "transaction_id"),
        hub_property=s([(p, p) for p in props], "property_hk string, property_id string"),
        hub_owner=s([], "owner_hk string, owner_id string"),
        hub_agent=s([(a,) for a in agents], "agent_hk string"),
        lnk_transaction_property=s(lp, "transaction_hk string, property_hk string, "
                                       "load_date timestamp_ntz, record_source string"),
        lnk_transaction_buyer=s([], "transaction_hk string, owner_hk string"),
        lnk_transaction_seller=s([], "transaction_hk string, owner_hk string"),
        lnk_transaction_agent=s(la, "transaction_hk string, agent_hk string, "
                                    "load_date timestamp_ntz, record_source string"),
        sat_transaction_details=sat_t.drop("transaction_id"),
        sat_property_details=s([(p, f"addr {p}", "sub", "0001", "ST", 3, 2, Decimal("100.00"),
                                 "house", 1990, Decimal("500000.00")) for p in props],
                               "property_hk string, address string, suburb string, postcode string, "
                               "state string, bedrooms int, bathrooms int, land_size_sqm decimal(18,2), "
                               "property_type string, year_built int, listing_price decimal(14,2)"),
        sat_owner_details=s([], "owner_hk string, full_name string, suburb string, state string, "
                                "investor_flag boolean"),
        sat_agent_details=s([(a, f"name {a}", "agency", "region") for a in agents],
                            "agent_hk string, full_name string, agency_name string, region string"),
    )
    return view, tx, lp, la


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_star_join_is_exact_under_skew(spark):
    """A property and an agent with a third of all sales: AQE splits both joins."""
    import contextlib
    import io

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, val in SKEW_CONF.items():
        spark.conf.set(k, val)
    try:
        view, tx, lp, la = _view(spark)
        sales = marts.mart_property_sales(view)
        got = {r.transaction_id: (r.agent_name, r.price_vs_listing_pct) for r in sales.collect()}
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            sales.explain()
        assert plan.getvalue().count("skew=true") >= 2
    finally:
        for k, val in old.items():
            if val is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, val)
    assert len(got) == len(tx)
    agent_of = {t: a for t, a, _, _ in la}
    for thk, tid, price, *_ in tx:
        a = agent_of[thk]
        want_pct = (Decimal(100) * (price - Decimal("500000.00")) / Decimal("500000.00")).quantize(
            Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[tid] == ((f"name {a}" if a else None), want_pct)
    perf = marts.mart_agent_performance(sales).collect()
    hot = [r for r in perf if r.agent_name == "name a_hot"][0]
    assert hot.total_transactions == sum(1 for _, a, _, _ in la if a == "a_hot")
