"""Every query of the study, registered by name with its reference SQL."""

from registry.core import QUERIES, SQL  # noqa: F401
from registry import cleaning, labelling, features, scoring, models, inference, streams, stored  # noqa: E402,F401
