"""Every operator as a query over the benchmark tables, beside its plain SQL equivalent where one exists."""

from fitmesh.queries.registry import QUERIES, SQL  # noqa: F401
from fitmesh.queries import data, ensembles, models, outliers, outputs  # noqa: F401,E402
