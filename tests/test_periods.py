import pytest
from records import line

from paytally.sources import landing_path, period_path, scan_payments


def test_paths():
    assert period_path("s3a://raw/", 2016) == "s3a://raw/2016_*"
    assert period_path("s3a://raw", "2016", "5") == "s3a://raw/2016_05/*"
    assert period_path("s3a://raw", 2016, 5, 7) == "s3a://raw/2016_05/payments_2016_05_07.json"
    assert period_path("r", 2016, 11, 21, prefix="p") == "r/2016_11/p_2016_11_21.json"
    assert landing_path("r", 2016, 5, 7) == "r/unprocessed/payments_2016_05_07.json"


def test_a_day_needs_a_month():
    with pytest.raises(ValueError):
        period_path("r", 2016, None, 7)


def test_scans_cover_their_period(spark, tmp_path):
    root = str(tmp_path)
    days = [(2016, 5, 1), (2016, 5, 2), (2016, 11, 1), (2017, 5, 1)]
    for n, (y, m, d) in enumerate(days):
        path = tmp_path / f"{y}_{m:02}" / f"payments_{y}_{m:02}_{d:02}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(line(str(n), at=f"{y}-{m:02}-{d:02}T10:00:00Z"))

    def senders(*period):
        return {r.sender_id for r in scan_payments(spark, period_path(root, *period)).collect()}

    assert senders(2016) == {0, 1, 2}
    assert senders(2016, 5) == {0, 1}
    assert senders(2016, "5", "2") == {1}
    assert senders(2017) == {3}
