"""Import every catalog module so all queries are registered."""

from jobsmith.plans import catalog_batch  # noqa: F401
from jobsmith.plans import catalog_stream  # noqa: F401
