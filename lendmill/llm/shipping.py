"""Python code for executors travels with the job, so they need no copy of the library."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Functions of this module are sent to executors whole, not by their import name."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
