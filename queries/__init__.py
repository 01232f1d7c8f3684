"""Every operator as a query over the driver tables, with its SQL to check against."""

import importlib

MODULES = ["cleaning", "relational", "normalised", "star"]


def load_all() -> None:
    """Import the query modules, which register their queries.

    Column expressions need a running Spark session, so this is called late.
    """
    for module in MODULES:
        importlib.import_module(f"queries.{module}")
