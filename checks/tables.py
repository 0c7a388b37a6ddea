"""Bronze and silver tables."""

from __future__ import annotations

from coinloft.sources.banking import STAGE_TABLES

from . import base  # noqa: F401  (fills the views)
from .core import check


def _bronze(name):
    extra = (
        ", year(transaction_date) AS transaction_year, month(transaction_date) AS transaction_month"
        if name == "transactions" else ""
    )

    @check(f"load_bronze_{name}", f"SELECT *, 'test.{name}' AS source_file{extra} FROM raw_{name}")
    def run(lake):
        return lake.bronze[name]


def _silver(name):
    @check(f"silver_{name}", f"SELECT * FROM sv_{name}")
    def run(lake):
        return lake.silver[name]


for _name in STAGE_TABLES:
    _bronze(_name)
    _silver(_name)
