"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import __spark_entry__ as E
from conftest import SF_MID

Q = E.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_prunes_columns(spark):
    p = plan(Q["clean_articles"](spark, SF_MID))
    schemas = [line for line in p.splitlines() if "ReadSchema" in line]
    assert schemas and all("lang" not in s for s in schemas)


def test_dedup_combines_map_side(spark):
    p = plan(Q["dedup_first_url"](spark, SF_MID))
    # partial aggregate below the exchange, final above it
    assert p.count("SortAggregate") + p.count("HashAggregate") + p.count("ObjectHashAggregate") >= 2
    assert "Window" not in p


def test_split_read_prunes_partitions(spark):
    p = plan(Q["scan_split_parquet"](spark, SF_MID))
    assert "PartitionFilters: [isnotnull(split" in p and "(split" in p


def test_packing_holds_no_group_in_a_window(spark):
    # prefix sums over keys: no window over articles, in any session
    p = plan(Q["pack_multidoc"](spark, SF_MID))
    assert "WindowGroupLimit" not in p and "row_number()" not in p


def test_dedup_chooses_on_keys(spark):
    p = plan(Q["dedup_first_url"](spark, SF_MID))
    assert "HashAggregate" in p and "SortAggregate" not in p and "ObjectHashAggregate" not in p
    for q in ("topk_sources", "agg_category_kept"):
        schemas = [line for line in plan(Q[q](spark, SF_MID)).splitlines() if "ReadSchema" in line]
        assert schemas and all("text" not in s for s in schemas), q


def test_group_inputs_pack_without_shuffle_of_articles(spark):
    # the pre-grouped path packs inside the row: no window at all
    p = plan(Q["build_group_inputs"](spark, SF_MID))
    assert "Window" not in p


def test_no_unpartitioned_window_on_rows(spark):
    # dense ids: only the per-partition offset table uses an unpartitioned window
    p = plan(Q["rank_dense_id"](spark, SF_MID))
    assert "row_number()" not in p
