"""Curbside: curb-parking analytics on Spark DataFrames."""

from curbside import functions, operators, plans, sources, streaming
from curbside.operators import *  # noqa: F403
from curbside.plans import *  # noqa: F403
from curbside.sources import *  # noqa: F403
from curbside.streaming import *  # noqa: F403

__all__ = [
    *operators.__all__,
    *plans.__all__,
    *sources.__all__,
    *streaming.__all__,
    "functions",
]
