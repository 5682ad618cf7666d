"""The registered queries depend on the rules they are there for: the wrong
rule gives another result on the driver's tables."""

import os

import pytest

SF = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("table, least", [("gold_volatility", 100), ("gold_spread", 100), ("gold_liquidity", 100)])
def test_first_and_last_write_differ(spark, table, least):
    from ticklake.plans.catalog import _SEED_ROWS, _gold, _silver_for

    silver = _silver_for(table, spark, SF).persist()
    seed, full = (_gold(table, s) for s in (silver.filter(_SEED_ROWS[table]), silver))
    keys = ["symbol", "window_start", *(["side"] if table == "gold_liquidity" else [])]
    changed = seed.exceptAll(full).join(full.select(*keys), keys, "left_semi").count()
    added = full.join(seed.select(*keys), keys, "left_anti").count()
    silver.unpersist()
    assert changed > least  # last write wins would show in so many rows
    assert table == "gold_liquidity" or added > least  # and the second insert does add rows


def test_late_trades_are_kept_and_dropped(spark):
    from ticklake.plans.catalog import _gold, _replayed, _silver_for, q_late_trades_stream

    kept = q_late_trades_stream(spark, SF).collect()
    none = q_late_trades_stream(spark, SF, late=lambda trades: trades.filter("false")).collect()
    on_time = _gold("gold_volatility", _replayed(_silver_for("gold_volatility", spark, SF))).collect()
    total = lambda rows: sum(r.trade_count for r in rows if r.symbol == "SIGNUP")
    assert total(kept) - total(none) > 100  # late rows that count
    assert total(on_time) - total(kept) > 500  # and late rows that don't


def test_the_mixed_feed_has_rows_for_each_silver_filter(spark):
    from ticklake.operators.silver import silver_agg_trade
    from ticklake.plans.catalog import _envelopes

    envelopes = _envelopes(spark, SF).persist()
    trades = envelopes.filter("stream_type = 'aggTrade'").count()
    assert envelopes.count() > 2 * trades  # other types are left out
    silver = silver_agg_trade(envelopes)
    assert 50 < trades - silver.count()  # without data, or data null
    assert 50 < silver.filter("price is null").count()  # {} and text stay
    envelopes.unpersist()
