"""All registered queries."""

from millrace.plans import (  # noqa: F401
    dimension,
    listings,
    loads,
    pages,
    rates,
    retail,
    reviews,
    scalars,
    streams,
    weather,
)
from millrace.plans.registry import QUERIES  # noqa: F401
