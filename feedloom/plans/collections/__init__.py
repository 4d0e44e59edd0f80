"""The collection registry: one text table per collection (fixed values)."""

from ...operators.mapping import Collection
from . import archives, contacts, customers, operations, orders, payments

REGISTRY: dict[str, Collection] = {
    name: Collection.parse(name, table)
    for module in (customers, orders, payments, contacts, archives, operations)
    for name, table in module.TABLES.items()
}

DEFAULT_COLLECTION = "customers"
