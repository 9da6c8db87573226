"""The physical plans that the library is built for."""

import pytest

from checks import fixtures as fx
from checks.queries import QUERIES
from floorwatch.operators import match
from floorwatch.plans.channel import build_channel


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize(
    "name",
    ["join_mapping_contains", "join_contains_ngram", "best_match", "floor_range", "gap_report",
     "clear_window", "merge_window", "channel_dcomm", "channel_hsm", "channel_minis", "channel_haba"],
)
def test_no_query_pairs_everything_with_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not any(bad in text for bad in NO_PAIRS)


def test_large_mapping_does_not_pair_everything_either(spark, sf_dir):
    names = match.distinct_names(fx.obs(spark, sf_dir))
    text = plan(match.contains_pairs(names, fx.mapping(spark, sf_dir), limit=0))
    assert not any(bad in text for bad in NO_PAIRS)


def test_channel_scans_its_rows_once_and_shuffles_them_once(spark, sf_dir):
    """Rows read from one file of observations, so that only the channel's own shuffles show."""
    from floorwatch.sources.shared import materialise

    rows = materialise(fx.obs(spark, sf_dir), "plan-obs")
    result = build_channel(
        fx.DCOMM_TEST, {"ALL": rows}, {"ALL": fx.mapping(spark, sf_dir)}, fx.floors(spark, sf_dir)
    )
    text = plan(result.track)
    lines = text.split("\n")
    assert sum("plan-obs" in line for line in lines) == 1
    scan = next(line for line in lines if "plan-obs" in line)
    assert "location" not in scan.split("Batched")[0]
    assert "LessThanOrEqual(finalPrice,60000.0)" in scan
    # From the scan up to the root: one exchange, the final deduplication.
    depth = lines.index(scan)
    indent = len(scan) - len(scan.lstrip(" :+-"))
    above = []
    for line in reversed(lines[:depth]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < indent:
            above.append(line)
            indent = here
    assert sum("Exchange" in line for line in above) == 1
    assert sum("BroadcastHashJoin" in line for line in above) == 2


def test_single_pass_floors_scan_once(spark, sf_dir):
    single = plan(QUERIES["floor_single_pass"](spark, sf_dir)).count("lineitem.parquet")
    union = plan(QUERIES["floor_union"](spark, sf_dir)).count("lineitem.parquet")
    assert single == 1 and union == 3


def test_gap_counts_neither_expand_nor_join_names_by_sku(spark, sf_dir):
    """Names meet the floors of the week by broadcast; counting them needs no copies of the rows."""
    text = plan(QUERIES["gap_counts"](spark, sf_dir))
    by_sku = [line for line in text.split("\n") if "SortMergeJoin" in line and "sku" in line.lower()]
    assert "Expand" not in text and not by_sku


def test_grams_are_dropped_before_they_are_shuffled(spark, sf_dir):
    names = match.distinct_names(fx.obs(spark, sf_dir))
    pairs = match.contains_pairs(names, fx.mapping(spark, sf_dir), limit=0)
    lines = pairs._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    inner = next(i for i, line in enumerate(lines) if "Join Inner" in line and "_salt" in line)
    generate = next(i for i, line in enumerate(lines) if "Generate explode" in line and "name" in line)
    assert inner < semi < generate


def test_gap_report_over_all_accounts_has_no_pairs(spark, sf_dir):
    text = plan(QUERIES["gap_join_contains"](spark, sf_dir))
    assert not any(bad in text for bad in NO_PAIRS)
