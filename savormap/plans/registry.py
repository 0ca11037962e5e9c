"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from savormap.session import apply_runtime_conf

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """One query: the operators it covers, its plan, and equivalent SQL if there is any."""

    covers: tuple[str, ...]
    plan: Plan
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register the function under its own name; ``covers`` lists operator ids."""

    def register(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(apply_runtime_conf(spark), sf_dir)

        REGISTRY[plan.__name__] = Entry(tuple(covers.split()), run, sql)
        return plan

    return register
