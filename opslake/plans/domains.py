"""All datasets by name, in the order their domains run.

The column names, types, expectation names and predicates of the datasets are fixed values:
they are the contract that readers of the tables and of the event log rely on.
"""

from __future__ import annotations

from opslake.plans.contracts import Dataset
from opslake.plans.parts import INVENTORY, PARTS
from opslake.plans.service_ops import CUSTOMERS, WORK_ORDERS
from opslake.plans.suppliers import PURCHASES, SUPPLIERS

DATASETS: dict[str, Dataset] = {
    d.name: d for d in (SUPPLIERS, PURCHASES, PARTS, INVENTORY, CUSTOMERS, WORK_ORDERS)
}
DOMAINS = ("suppliers", "parts", "service_ops")
