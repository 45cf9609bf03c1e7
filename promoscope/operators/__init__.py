"""DataFrame -> DataFrame operators of the shopper-log analyses."""

from promoscope.operators import (  # noqa: F401
    demographics, features, fill, filters, popularity, scoring, topk,
)
