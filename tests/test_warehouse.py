"""Warehouse build: first run full, second run incremental, both equal to a
full rebuild; snapshots are readable through the pointer table."""

from __future__ import annotations

from dayledger.operators import sinks as K
from dayledger.plans import warehouse as WH
from tests.conftest import SF_SMALL


def test_build_twice_full_then_incremental(spark, tmp_path):
    base = str(tmp_path / "wh")
    first = WH.build(spark, SF_SMALL, base=base)
    assert first.modes == {"dim_user": "full", "int01_collapsed": "full",
                           "int02_wearable_day": "full", "pnl01_user_day": "full"}
    assert all(v == 0 for v in first.checks.values())
    second = WH.build(spark, SF_SMALL, base=base, lookback_days=7)
    assert second.modes["int01_collapsed"] == "incremental"
    assert second.modes["int02_wearable_day"] == "incremental"
    assert all(v == 0 for v in second.checks.values())
    for name in ("int01_collapsed", "int02_wearable_day"):
        days = first.written[name]
        # seven days and the one that the cutoff lies in
        assert second.written[name] and days[-8:] == second.written[name] and len(days) > 8
        table = WH.partitioned(spark, name, base)
        old = [f for f in table.folders() if f.value not in second.written[name]]
        assert len({f.path.split("/commit=")[1].split("/")[0] for f in old}) == 1  # named, not copied
    assert WH.partitioned(spark, "int02_wearable_day", base).read().count() > 0
    panel = K.current_snapshot(spark, "pnl01_user_day", base)
    assert "panel_month" in panel.columns and panel.count() > 0
