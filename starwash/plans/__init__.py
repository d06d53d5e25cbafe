"""End-to-end plans: the registrations pipeline and the dirty fixture view."""

from .fixtures import DIRTY_TIE_BREAK, dirty
from .pipeline import run_registrations_etl

__all__ = ["DIRTY_TIE_BREAK", "dirty", "run_registrations_etl"]
