"""Whole jobs: loading a period and answering the daily reports."""

from paytally.plans.load import load_payments, run_period
from paytally.plans.reports import (
    report,
    top_pair_ids,
    top_pairs,
    top_receivers,
    top_senders,
    top_spenders,
)

__all__ = [
    "load_payments",
    "report",
    "run_period",
    "top_pair_ids",
    "top_pairs",
    "top_receivers",
    "top_senders",
    "top_spenders",
]
