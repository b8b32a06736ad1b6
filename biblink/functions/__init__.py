"""Scalar column expressions (S-series)."""

from biblink.functions.ids import *  # noqa: F401,F403
from biblink.functions.text import *  # noqa: F401,F403
