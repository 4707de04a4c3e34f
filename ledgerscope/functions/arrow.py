"""``mapInArrow`` for functions of this library."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` where workers that were started elsewhere find this library in its folder."""
    packed, root = cloudpickle.dumps(function), ROOT

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        yield from cloudpickle.loads(packed)(batches)

    return df.mapInArrow(run, schema)
