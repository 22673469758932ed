"""Independent ANSI SQL for the registered queries, built from named common table expressions."""

from __future__ import annotations

AS_OF = "2001-05-15 00:00:00"

# name -> (names it reads, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body)


def with_ctes(needs: str, final: str) -> str:
    """``final`` preceded by the expressions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTES[name][0]:
            visit(dep)
        ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return final
    bodies = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {bodies}\n{final}"


cte("raw_suppliers", "", """
select s_suppkey as supplier_id, s_name as name, r_name as region,
 case s_suppkey % 3 when 0 then 'Preferred' when 1 then 'Approved' else 'Probation' end as tier,
 case when s_suppkey % 20 = 7 then cast(1.4 as double)
      else cast(0.82 as double) + cast(s_suppkey % 18 as double) / 100 end as on_time_rate,
 case when s_suppkey % 10 = 3 then -1 else cast(50 + (s_suppkey * 37) % 3951 as int) end as defect_rate_ppm,
 cast(10 + s_suppkey % 90 as varchar) || '-' || cast(1000000 + s_suppkey * 7919 % 9000000 as varchar) as tax_id,
 'ops' || cast(s_suppkey as varchar) || '@supplier' || cast(s_suppkey as varchar) || '.example.com' as contact_email,
 case when s_suppkey % 10 = 5 then 2 when s_suppkey % 14 = 0 then 0 else 1 end as active
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")

cte("raw_purchases", "", """
select l_orderkey * 10 + l_linenumber as purchase_id, l_partkey as part_id, l_suppkey as supplier_id,
 case when (l_orderkey * 7 + l_linenumber) % 200 = 0 then -1 else cast(l_quantity as int) end as qty,
 case when (l_orderkey * 3 + l_linenumber) % 250 = 1 then cast(0 as double) else l_extendedprice / l_quantity end as unit_price_usd,
 l_shipdate as purchased_at,
 case when (l_orderkey * 11 + l_linenumber) % 300 = 2 then cast(1.5 as double) else l_discount end as discount_pct
from lineitem""")

cte("raw_parts", "", """
select p_partkey as part_id,
 case when p_partkey % 33 = 8 then null else 'PS-' || upper(substring(p_type, 1, 3)) || '-' || lpad(cast(p_partkey as varchar), 6, '0') end as sku,
 p_name as name, p_type as category, p_brand as manufacturer,
 case when p_partkey % 33 = 0 then cast(0 as double) when p_partkey % 33 = 10 then p_retailprice * 64 else p_retailprice end as list_price_usd,
 case when p_partkey % 33 = 7 then cast(0 as double) else cast(p_size as double) / 2 end as weight_kg, case when p_partkey % 33 = 5 then 1 else 0 end as hazmat_flag,
 timestamp '2019-01-01 00:00:00' as created_at
from part""")

cte("raw_inventory", "", """
select p_partkey * 5 + w as inventory_id, p_partkey as part_id,
 case w when 0 then 'CLE-01' when 1 then 'CHI-02' when 2 then 'DAL-03' when 3 then 'ATL-04' else 'LAX-05' end as warehouse,
 case when (p_partkey * 5 + w) % 97 = 13 then -1 else cast((p_partkey * 31 + w * 97) % 501 as int) end as on_hand_qty,
 case when (p_partkey * 5 + w) % 97 = 29 then 0 else cast(5 + (p_partkey * 17 + w * 13) % 96 as int) end as reorder_point,
 timestamp '2026-04-01 00:00:00' as updated_at
from part cross join (values (0), (1), (2), (3), (4)) as t(w)""")

cte("raw_work_orders", "", """
select work_order_id, part_id, customer_id, opened_at,
 case when status <> 'closed' then null
      when work_order_id % 50 = 1 then opened_at - to_hours(cast(1 + work_order_id % 48 as int))
      else opened_at + to_hours(cast(2 + (work_order_id * 37) % 239 as int)) end as closed_at,
 status, priority, 'Replaced unit ' || cast(work_order_id as varchar) as technician_notes
from (select o_orderkey as work_order_id, (o_orderkey * 13) % 200 as part_id, o_custkey as customer_id,
   o_orderdate as opened_at,
   case when o_orderkey % 50 = 7 then 'unknown' when o_orderkey % 50 = 0 then 'cancelled' when o_orderstatus = 'F' then 'closed'
        when o_orderstatus = 'O' then 'open' else 'in_progress' end as status,
   case when o_orderkey % 50 = 9 then 'P9' else case substring(o_orderpriority, 1, 1) when '1' then 'P1' when '2' then 'P2' when '3' then 'P3' else 'P4' end end as priority
 from orders) x""")

cte("raw_customers", "", """
select c_custkey as customer_id, c_name as facility_name, c_mktsegment as type, r_name as region,
 case when c_custkey % 50 = 3 then 0 else cast(30 + c_custkey % 871 as int) end as beds, cast(1000 + (c_custkey * 7919) % 9000 as varchar) as ssn_last4_contact,
 case when c_custkey % 50 = 4 then 'Unknown' else case c_custkey % 3 when 0 then 'Gold' when 1 then 'Silver' else 'Bronze' end end as contract_tier
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")

# Typed rows before and after the drop expectations.
cte("typed_suppliers", "raw_suppliers", """
select supplier_id, name as supplier_name, region, tier, on_time_rate, defect_rate_ppm, tax_id, contact_email,
 active from raw_suppliers""")
cte("typed_purchases", "raw_purchases", """
select purchase_id, part_id, supplier_id, qty, unit_price_usd,
 unit_price_usd * (1 - discount_pct) as net_unit_price_usd, purchased_at, discount_pct from raw_purchases""")
cte("typed_parts", "raw_parts", """
select part_id, sku, name as part_name, category, manufacturer, list_price_usd, weight_kg, hazmat_flag, created_at
from raw_parts""")
cte("typed_inventory", "raw_inventory", "select * from raw_inventory")
cte("typed_customers", "raw_customers", """
select customer_id, facility_name, type as facility_type, region, beds, ssn_last4_contact, contract_tier
from raw_customers""")
cte("typed_work_orders", "raw_work_orders", "select * from raw_work_orders")

cte("silver_suppliers", "typed_suppliers", "select * from typed_suppliers where on_time_rate >= 0 and on_time_rate <= 1")
cte("silver_purchases", "typed_purchases", "select * from typed_purchases where qty > 0")
cte("silver_parts", "typed_parts", "select * from typed_parts where list_price_usd > 0")
cte("silver_inventory", "typed_inventory", "select * from typed_inventory")
cte("silver_customers", "typed_customers", "select * from typed_customers")
cte("silver_work_orders", "typed_work_orders", "select * from typed_work_orders")

cte("supplier_spend", "silver_purchases", """
select supplier_id, sum(qty * net_unit_price_usd) as total_spend_usd,
 count(distinct purchase_id) as purchase_count, avg(net_unit_price_usd) as avg_net_price_usd,
 max(purchased_at) as last_purchase_at
from silver_purchases group by supplier_id""")
cte("gold_supplier_performance", "silver_suppliers supplier_spend", """
select s.supplier_id, supplier_name, region, tier,
 round(0.6::double * on_time_rate + 0.4::double * (1 - defect_rate_ppm / 5000.0::double), 3) as composite_score,
 round(on_time_rate, 3) as on_time_rate, defect_rate_ppm, round(total_spend_usd, 2) as total_spend_usd,
 purchase_count, round(avg_net_price_usd, 2) as avg_net_price_usd, last_purchase_at
from silver_suppliers s left join supplier_spend p on s.supplier_id = p.supplier_id""")
cte("paid_stats", "silver_purchases", """
select part_id, cast(sum(cast(net_unit_price_usd as decimal(28,10))) as double) / count(net_unit_price_usd) as avg_paid_usd, min(net_unit_price_usd) as best_paid_usd,
 count(purchase_id) as purchase_count, max(purchased_at) as last_purchase_at
from silver_purchases group by part_id""")
cte("gold_part_pricing_benchmark", "silver_parts paid_stats", """
select s.part_id, sku, part_name, category, manufacturer, round(list_price_usd, 2) as list_price_usd,
 cast(round(cast(avg_paid_usd as decimal(28,8)), 2) as double) as avg_paid_usd, cast(round(cast(best_paid_usd as decimal(28,8)), 2) as double) as best_paid_usd, purchase_count,
 round(case when list_price_usd > 0 then (list_price_usd - avg_paid_usd) / list_price_usd end, 4) as savings_vs_list_pct,
 last_purchase_at
from silver_parts s left join paid_stats p on s.part_id = p.part_id""")
cte("gold_reorder_needed", "silver_inventory silver_parts", f"""
select i.part_id, sku, part_name, category, manufacturer, warehouse, on_hand_qty, reorder_point,
 round(list_price_usd, 2) as list_price_usd, reorder_point - on_hand_qty as shortfall_qty,
 timestamp '{AS_OF}' as generated_at
from silver_inventory i left join silver_parts p on i.part_id = p.part_id
where on_hand_qty <= reorder_point""")
cte("gold_work_order_volume", "silver_work_orders", """
select strftime(opened_at, '%Y-%m') as month, priority, status, count(work_order_id) as work_orders
from silver_work_orders group by 1, 2, 3""")
cte("gold_part_demand_monthly", "silver_work_orders", """
select part_id, strftime(opened_at, '%Y-%m') as month, count(work_order_id) as work_orders,
 round(avg(case when closed_at is not null then (epoch(closed_at) - epoch(opened_at)) / 3600.0::double end), 2)
  as avg_duration_hours
from silver_work_orders group by 1, 2""")


def sla_over(rows: str) -> str:
    return f"""
select priority, count(work_order_id) as closed_orders,
 cast(sum(case when hours <= case priority when 'P1' then 48 when 'P2' then 120 else 240 end then 1 else 0 end) as bigint)
  as orders_meeting_sla,
 round(avg(hours), 2) as avg_duration_hours,
 round(sum(case when hours <= case priority when 'P1' then 48 when 'P2' then 120 else 240 end then 1 else 0 end)
  / count(work_order_id), 4) as sla_pct
from (select *, (epoch(closed_at) - epoch(opened_at)) / 3600.0::double as hours from {rows}
      where status = 'closed' and closed_at is not null and closed_at >= opened_at) c
group by priority"""


cte("gold_sla_performance", "silver_work_orders", sla_over("silver_work_orders"))
cte("reorder_alerts_feed", "gold_reorder_needed", """
select part_id, sku, part_name, category, warehouse, on_hand_qty, reorder_point, shortfall_qty, list_price_usd,
 cast(shortfall_qty * list_price_usd as decimal(18,2)) as est_reorder_value_usd, generated_at
from gold_reorder_needed where shortfall_qty > 10""")
cte("parts_searchable", "silver_parts", """
select part_id, sku, part_name, category, manufacturer, list_price_usd, hazmat_flag,
 part_name || ' Category:' || category || ' Manufactured by' || manufacturer || ' ' ||
 case when hazmat_flag = 1 then 'Hazardous material handling required.' else '' end ||
 ' List price USD' || cast(list_price_usd as varchar) as description
from silver_parts""")

EXPECTATIONS = {
    "suppliers": (
        ("on_time_rate_in_range", "drop", "on_time_rate >= 0 and on_time_rate <= 1"),
        ("defect_rate_ppm_nonneg", "warn", "defect_rate_ppm >= 0"),
        ("active_flag_known", "warn", "active in (0, 1)"),
    ),
    "purchases": (
        ("qty_positive", "drop", "qty > 0"),
        ("unit_price_positive", "warn", "unit_price_usd > 0"),
        ("discount_in_range", "warn", "discount_pct >= 0 and discount_pct <= 1"),
    ),
    "parts": (
        ("list_price_positive", "drop", "list_price_usd > 0"),
        ("weight_positive", "warn", "weight_kg > 0"),
        ("sku_present", "warn", "sku is not null and length(sku) > 0"),
    ),
    "inventory": (
        ("on_hand_nonneg", "warn", "on_hand_qty >= 0"),
        ("reorder_point_positive", "warn", "reorder_point > 0"),
    ),
    "customers": (
        ("beds_positive", "warn", "beds > 0"),
        ("contract_tier_known", "warn", "contract_tier in ('Gold', 'Silver', 'Bronze')"),
    ),
    "work_orders": (
        ("closed_at_after_opened_at", "warn", "closed_at is null or closed_at >= opened_at"),
        ("status_known", "warn", "status in ('closed', 'in_progress', 'open', 'cancelled')"),
        ("priority_known", "warn", "priority in ('P1', 'P2', 'P3', 'P4')"),
    ),
}


def expectation_sql(datasets: list[str], action: str | None = None) -> str:
    """Passed and failed counts of the given datasets' expectations."""
    arms = [
        f"select '{d}' as dataset, '{n}' as expectation, '{a}' as action, "
        f"cast(count(*) filter (where coalesce({p}, false)) as bigint) as passed, "
        f"cast(count(*) filter (where not coalesce({p}, false)) as bigint) as failed from typed_{d}"
        for d in datasets
        for n, a, p in EXPECTATIONS[d]
        if action in (None, a)
    ]
    return with_ctes(" ".join(f"typed_{d}" for d in datasets), "\nunion all ".join(arms))


def settled(expr: str, places: int) -> str:
    """Rounded for comparison only. The offset keeps exact halves, which means of short
    decimals often are, off the rounding boundary: two engines add in different order."""
    return f"round({expr} + 1e-{places + 3}, {places})"


def table_sql(name: str) -> str:
    return with_ctes(name, f"select * from {name}")
