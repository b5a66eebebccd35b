"""Plans that must hold at any size: what scans read, and no product of tables."""

import contextlib
import io

import pytest

import loomlex.plans.queries  # noqa: F401
from loomlex.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    ("name", "reads", "not_reads"),
    [("q18_stratum_counts", "lang:string,source:string", "text"), ("q26_active_anti_join", "o_orderkey", "o_totalprice"), ("q48_page_markup_scan", "html:string", "url"), ("q46_batches_of_25", "doc_id", "text:string")],
)
def test_scans_read_what_is_asked_for(spark, name, reads, not_reads):
    schemas = [line for line in plan(QUERIES[name](spark, SF)).splitlines() if "ReadSchema" in line]
    assert any(reads in s for s in schemas) and not any(not_reads in s for s in schemas)


def test_filters_reach_the_scan(spark):
    lines = [line for line in plan(QUERIES["q26_active_anti_join"](spark, SF)).splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(c_acctbal,0.0)" in line for line in lines)


@pytest.mark.parametrize("name", ["q01_lexical_match", "q13_delta_classify", "q21_reconcile", "q24_duplicate_pairs", "q30_collision_check", "q35_slot_occupancy", "q45_receipt_cache_join"])
def test_no_products(spark, name):
    assert "CartesianProduct" not in plan(QUERIES[name](spark, SF))


def test_frames_of_neighbours_do_not_reach_forward(spark):
    """A frame from each row to the end of its range is walked anew for each row, the square of a range's rows."""
    from loomlex.operators import labels

    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(0, 100, 2)], "name string")
    found = labels.neighbours(spark.createDataFrame([("n003",), ("n004",), ("n099",), ("a",)], "query string"), names)
    assert "currentrow$(), unboundedfollowing$()" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {("n003", "n002", "n004"), ("n004", "n002", "n004"), ("n099", "n098", None), ("a", None, "n000")}


def test_exported_lines_are_dealt_before_they_are_made_distinct(spark):
    """Else a task that reads many rows holds all their lines at once."""
    text = plan(QUERIES["q38_triples_export"](spark, SF))
    assert "REPARTITION_BY_COL" in text
