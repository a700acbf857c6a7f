"""All registered queries of the rail operators, gathered from the modules beside this one."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import railtable.plans as here


def _modules() -> list:
    names = sorted(m.name for m in pkgutil.iter_modules(here.__path__) if m.name.startswith("q_"))
    return [importlib.import_module(f"{here.__name__}.{n}") for n in names]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _modules() for k, s in m.ORACLES.items()}
