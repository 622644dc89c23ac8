"""Imports every query module so that each registers its queries."""

from . import q_enrich  # noqa: F401
from . import q_clean  # noqa: F401
from . import q_text  # noqa: F401
