"""All registered queries: importing their modules fills the catalog."""

from bundleflow.plans import queries_io, queries_ops, queries_stream  # noqa: F401
from bundleflow.plans.catalog import ORACLES, QUERIES  # noqa: F401
