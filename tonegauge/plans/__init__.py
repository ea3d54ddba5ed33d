"""Named queries over a table folder, each with equivalent SQL where SQL can say it."""

from tonegauge.plans import cleaning, dashboard, models, profile, streams, text

MODULES = [cleaning, text, dashboard, profile, models, streams]


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
