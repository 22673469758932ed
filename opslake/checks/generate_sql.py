"""SQL for the generated datasets: the same integer draws, written out as text."""

from __future__ import annotations

from opslake.functions.hashing import MODULUS, stream_constants
from opslake.sources import generate as g
from opslake.sources.generate import WAREHOUSES


class Draws:
    def __init__(self, dataset: str, seed: int = g.SEED) -> None:
        self.dataset, self.seed = dataset, seed

    def draw(self, column: str) -> str:
        a, b, c, d = stream_constants(self.seed, f"{self.dataset}.{column}")
        m = f"{MODULUS}::bigint"
        x = f"(((id % {m}) * {a} + (id >> 31) * {b}) % {m})"
        y = f"(({x} * {x} + {x} * {c} + {d}) % {m})"
        return f"(({y} * {y} + {y} * {d} + {a}) % {m})"

    def int(self, column: str, low: int, high: int) -> str:
        return f"({self.draw(column)} % {high - low + 1} + {low})"

    def fraction(self, column: str, low: int, high: int, scale: int) -> str:
        return f"({self.int(column, low, high)} / {scale}.0::double)"

    def pick(self, column: str, values: list) -> str:
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::double" for v in values)
        return f"([{listed}])[1 + {self.draw(column)} % {len(values)}]"

    def weighted(self, column: str, weights: dict) -> str:
        slot, arms, upper = f"({self.draw(column)} % {sum(weights.values())})", "", 0
        for value, weight in weights.items():
            upper += weight
            arms += f" when {slot} < {upper} then {value!r}"
        return f"(case{arms} end)"

    def permille(self, column: str, share: int) -> str:
        return f"({self.int(column, 0, 999)} < {share})"

    def time(self, column: str, start: str, days: int = 0, hours: int = 0) -> str:
        d, h = self.int(f"{column}.days", 0, days), self.int(f"{column}.hours", 0, hours)
        return f"(timestamp '{start}' + to_days(({d})::int) + to_hours({h}))"


def generated(dataset: str, ids: str, **sizes: int) -> str:
    """SQL for one generator over ``ids``, a query with a column ``id``."""
    d = Draws(dataset)
    n_parts = sizes.get("n_parts", g.ROWS["parts"])
    if dataset == "parts":
        return f"""select id as part_id, 'PS-' || upper(substring(category, 1, 3)) || '-' || lpad(id::varchar, greatest(6, length(id::varchar))::int, '0') as sku,
 manufacturer || ' ' || category || ' Part ' || id::varchar as name, category, manufacturer,
 case when {d.permille('bad_price', g.BAD_PRICE_PERMILLE)} then 0::double else {d.fraction('list_price', 2500, 1800000, 100)} end as list_price_usd,
 {d.fraction('weight', 5, 4500, 100)} as weight_kg, {d.weighted('hazmat', g.HAZMAT_WEIGHTS)} as hazmat_flag,
 {d.time('created', '2019-01-01 00:00:00', days=2400)} as created_at
from (select id, {d.pick('category', g.CATEGORIES)} as category, {d.pick('manufacturer', g.MANUFACTURERS)} as manufacturer from ({ids}) i) p"""
    if dataset == "suppliers":
        return f"""select id as supplier_id, 'Supplier ' || lpad(id::varchar, greatest(3, length(id::varchar))::int, '0') || ' ' || {d.pick('kind', g.SUPPLIER_KINDS)} as name,
 {d.pick('region', g.REGIONS)} as region, {d.pick('tier', g.TIERS)} as tier,
 case when {d.permille('bad_rate', g.BAD_RATE_PERMILLE)} then {d.pick('wrong_rate', [-0.1, 1.4])} else {d.fraction('on_time_rate', 820, 995, 1000)} end as on_time_rate,
 {d.int('defect_rate_ppm', 50, 4000)} as defect_rate_ppm,
 {d.int('tax_prefix', 10, 99)}::varchar || '-' || {d.int('tax_number', 1000000, 9999999)}::varchar as tax_id,
 'ops' || id::varchar || '@supplier' || id::varchar || '.example.com' as contact_email,
 {d.weighted('active', g.ACTIVE_WEIGHTS)} as active from ({ids}) i"""
    if dataset == "customers":
        return f"""select id as customer_id, {d.pick('first_name', g.FACILITY_NAMES)} || ' ' || {d.pick('kind', g.FACILITY_KINDS)} || ' ' || id::varchar as facility_name,
 {d.pick('type', g.FACILITY_TYPES)} as type, {d.pick('region', g.REGIONS)} as region, {d.int('beds', 30, 900)} as beds,
 {d.int('ssn', 1000, 9999)}::varchar as ssn_last4_contact, {d.pick('contract_tier', g.CONTRACT_TIERS)} as contract_tier from ({ids}) i"""
    if dataset == "work_orders":
        hours = (
            f"(case when {d.permille('bad_close', g.BAD_CLOSE_PERMILLE)} then -{d.int('early_hours', 1, 48)} "
            f"else {d.int('open_hours', 2, 240)} end)"
        )
        return f"""select id as work_order_id, {d.int('part', 1, n_parts)} as part_id,
 {d.int('customer', 1, sizes.get('n_customers', g.ROWS['customers']))} as customer_id, opened_at,
 case when status = 'closed' then opened_at + to_hours({hours}) end as closed_at, status,
 {d.pick('priority', g.PRIORITIES)} as priority, 'Replaced unit ' || id::varchar as technician_notes
from (select id, {d.time('opened', '2025-10-01 00:00:00', days=200, hours=23)} as opened_at,
 {d.weighted('status', g.STATUS_WEIGHTS)} as status from ({ids}) i) w"""
    if dataset == "purchases":
        return f"""select id as purchase_id, {d.int('part', 1, n_parts)} as part_id,
 {d.int('supplier', 1, sizes.get('n_suppliers', g.ROWS['suppliers']))} as supplier_id,
 (case when {d.permille('bad_qty', g.BAD_QTY_PERMILLE)} then -1 else {d.int('qty', 1, 25)} end)::int as qty,
 {d.fraction('unit_price', 2000, 1500000, 100)} as unit_price_usd,
 {d.time('purchased', '2023-01-01 00:00:00', days=1200)} as purchased_at,
 {d.fraction('discount', 0, 350, 1000)} as discount_pct from ({ids}) i"""
    if dataset == "inventory":
        return f"""select id as inventory_id, {d.int('part', 1, n_parts)} as part_id, {d.pick('warehouse', list(WAREHOUSES))} as warehouse,
 {d.int('on_hand', 0, 500)} as on_hand_qty, {d.int('reorder_point', 5, 100)} as reorder_point,
 {d.time('updated', '2026-04-01 00:00:00', hours=500)} as updated_at from ({ids}) i"""
    raise KeyError(dataset)
