"""Configuration as a mapping of strings, kept in Spark's session settings under a prefix, and in the process without a session."""

from __future__ import annotations

from collections.abc import Iterator, MutableMapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

PREFIX = "spark.hypercell."
#: How shaped columns leave as Arrow: "fixed" or "list". A key may have a prefix before ``convert.strategy``.
STRATEGY = "convert.strategy"


class Configuration(MutableMapping):
    """Keys and values are strings; iteration is in sorted order; a missing key raises KeyError."""

    def __init__(self) -> None:
        self._own: dict[str, str] = {}

    def _all(self) -> dict[str, str]:
        spark = SparkSession.getActiveSession()
        if spark is None:
            return dict(self._own)
        held = {k[len(PREFIX) :]: v for k, v in spark.conf.getAll.items() if k.startswith(PREFIX)}
        return self._own | held

    def __getitem__(self, key: str) -> str:
        return self._all()[key]

    def __setitem__(self, key: str, value: str) -> None:
        if not isinstance(key, str) or not isinstance(value, str):
            raise TypeError("configuration keys and values are strings")
        self._own[key] = value
        spark = SparkSession.getActiveSession()
        if spark is not None:
            spark.conf.set(PREFIX + key, value)

    def __delitem__(self, key: str) -> None:
        if key not in self._all():
            raise KeyError(key)
        self._own.pop(key, None)
        spark = SparkSession.getActiveSession()
        if spark is not None:
            spark.conf.unset(PREFIX + key)

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(self._all()))

    def __len__(self) -> int:
        return len(self._all())


config = Configuration()


@contextmanager
def settings(**values: str):
    """Set some keys for the time of a ``with`` block; nestable; what was there before comes back, after an error too."""
    before = {k: config.get(k) for k in values}
    try:
        for k, v in values.items():
            config[k] = v
        yield config
    finally:
        for k, v in before.items():
            if v is None:
                config.pop(k, None)
            else:
                config[k] = v


def strategy() -> str:
    """"fixed" unless a conversion strategy names "list" only."""
    for k in config:
        if k == STRATEGY or k.endswith("." + STRATEGY):
            value = config[k]
            if "fixed" in value:
                return "fixed"
            if "list" in value:
                return "list"
            raise ValueError(f"{k}: {value!r} names neither fixed nor list")
    return "fixed"
