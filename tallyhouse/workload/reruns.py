"""Queries over a warehouse that was stored, changed at its sources and run again, and over its staging checks.

Each equals the fact built at once: late orders and refunds, cancellations, orders refunded in full,
customers who lapse and events that are withdrawn have all reached the stored rows. Keys of customer
versions differ, as the history really has one version more, and are not compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallyhouse.operators import quality as Q
from tallyhouse.plans.checks import STAGING_KEYS, staging_checks
from tallyhouse.plans.store import MERGES
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import NOT_COMPARED, REGISTRY, Lab, Query, register

COVERS = {
    "fact_orders": "SNK-2 SNK-3 SNK-6 FCT-1", "fact_inventory_movements": "SNK-3 SNK-7 FCT-9", "fact_inventory_snapshot": "SNK-3 SNK-5 FCT-8",
    "fact_customer_state_daily": "SNK-3 FCT-7", "fact_order_lines": "SNK-3 SNK-4 FCT-2", "fact_refunds": "SNK-3 SNK-4 FCT-3",
    "fact_marketing_spend": "SNK-3 FCT-4", "fact_web_sessions": "SNK-3 FCT-5", "fact_email_engagement": "SNK-3 FCT-6",
    "int_web_sessions": "SNK-3 STR-1 INT-3",
}
ONCE = {"int_web_sessions": "web_sessions"}  # the query over the model built at once, where it has another name

for _fact in sorted(MERGES):
    _once = REGISTRY[ONCE.get(_fact, _fact)]
    _columns = tuple(c for c in _once.columns if c[0] not in NOT_COMPARED)
    REGISTRY[f"rerun_{_fact}"] = Query(f"rerun_{_fact}", COVERS[_fact], _columns, lambda w, fact=_fact: w.rerun(fact).read(fact), _once.sql, _once.extra)

# The registered query that lists each staging model's rows.
STAGING_QUERIES = dict(zip(STAGING_KEYS, (
    "stg_orders", "stg_order_line_items", "stg_customers", "stg_refunds", "stg_transactions", "stg_products", "stg_product_variants", "stg_inventory_items", "stg_inventory_levels",
    "stg_inventory_snapshots", "stg_locations", "stg_charges", "stg_payment_customers", "stg_processor_refunds", "stg_disputes", "stg_payment_methods", "stg_web_events", "stg_web_users",
    "stg_ad_campaigns", "stg_ad_sets", "stg_ads", "stg_ad_insights", "stg_email_events", "stg_email_profiles", "stg_email_campaigns", "stg_email_flows"), strict=True))


def _staging_checks(w: Lab) -> DataFrame:
    """Keys and audit columns of all staging models."""
    parts = []
    for model in STAGING_KEYS:
        checks = [c for c in staging_checks(model, w[model].columns) if c.name.startswith(("not_null", "unique"))]
        parts.append(Q.run_checks(model, w[model], checks, PARAMS))
    return reduce(DataFrame.unionByName, parts)


def _staging_sql() -> str:
    """The same counts on the SQL side of each staging query: keys by distinct counting, audit columns as always filled."""
    parts = []
    for model, name in STAGING_QUERIES.items():
        query, keys = REGISTRY[name], STAGING_KEYS[model]
        source = query.sql if " " not in query.sql.strip() else f"({query.sql})"
        of = {n: e for n, _, e in query.columns}
        held = f"(select {', '.join(f'{of[k]} as {k}' for k in keys)} from {source} q)"
        for k in keys:
            parts.append(f"select '{model}' as table_name, 'not_null_{k}' as check_name, count(*) filter (where {k} is null) as failures from {held}")
        parts += [f"select '{model}', 'not_null_{c}', 0" for c in ("_source_system", "_source_record_id", "_loaded_at", "_record_hash")]
        present = " and ".join(f"{k} is not null" for k in keys)
        parts.append(f"select '{model}', 'unique_{'_'.join(keys)}', count(*) from (select 1 from {held} where {present} group by {', '.join(keys)} having count(*) > 1)")
    return " union all ".join(parts)


register("dq_staging", "DQ-1 DQ-2 DQ-5", "table_name s, check_name s, failures l", _staging_checks, _staging_sql())
