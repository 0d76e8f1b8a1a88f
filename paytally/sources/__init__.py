"""Where payments come from."""

from paytally.sources.payments import parse_payments, scan_lines, scan_payments
from paytally.sources.periods import landing_path, period_path

__all__ = ["landing_path", "parse_payments", "period_path", "scan_lines", "scan_payments"]
