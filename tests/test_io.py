"""Sources, sinks and the streaming path."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventlens.operators import clean as C
from eventlens.sources import files as IO
from eventlens.sources import fixtures as FX
from eventlens.streaming import live as LV


def test_unknown_split_rejected(spark):
    with pytest.raises(ValueError):
        IO.read_split(spark, "/nonexistent", "dev")


def test_alignment_mismatch_raises(spark):
    a = spark.range(5).withColumnRenamed("id", "ord")
    v = spark.range(4)
    with pytest.raises(ValueError):
        IO.check_alignment(a, v)
    IO.check_alignment(a, spark.range(5))


def test_latest_snapshot_empty_raises(spark):
    root = IO.scratch_dir(spark, "empty")
    spark.range(1).write.json(root + "/other")
    with pytest.raises(Exception):
        IO.read_latest_snapshot(spark, root, IO.RAW_ARTICLE).count()


def test_bad_response_status_raises(spark):
    raw = FX.raw_articles(spark, SF_SMALL)
    root = IO.land_responses(raw, IO.scratch_dir(spark, "bad"), status="error")
    with pytest.raises(Exception):
        IO.read_responses(spark, root).count()


def test_stream_earlier_file_wins(spark):
    """One file per trigger: a duplicate URL in a later file is dropped."""
    schema = LV.LANDED_ARTICLE
    root = IO.scratch_dir(spark, "landing")
    base = dict(source={"id": None, "name": "S"}, author=None, description=None, publishedAt="2024-01-01T00:00:00Z",
                category_rank=0)
    words = " ".join(["word"] * 25)
    first = [dict(base, title="First", content=words, url="https://x/1", category="business", ord=1)]
    second = [dict(base, title="Second", content=words, url="https://x/1", category="sports", ord=2),
              dict(base, title="Other", content=words, url="https://x/2", category="sports", ord=3)]
    spark.createDataFrame(first, schema).coalesce(1).write.json(root + "/a")
    spark.createDataFrame(second, schema).coalesce(1).write.json(root + "/b")
    out, ck = IO.scratch_dir(spark, "out"), IO.scratch_dir(spark, "ck")
    LV.run_available_now(LV.live_dedup_stream(spark, root + "/*", max_files_per_trigger=1), out, ck)
    got = {r["url"]: r["title"] for r in spark.read.parquet(out).collect()}
    assert got == {"https://x/1": "First", "https://x/2": "Other"}


def test_stream_drops_later_copies_of_short_articles(spark):
    """A first copy under 20 words is dropped with its URL; a longer later copy does not come through."""
    base = dict(source={"id": None, "name": "S"}, author=None, description=None, publishedAt="2024-01-01T00:00:00Z", category="business")
    long = " ".join(["word"] * 25)
    rows = [dict(base, title="Later", content=long, url="https://x/1", category_rank=1, ord=5),
            dict(base, title="Short", content="few words", url="https://x/1", category_rank=0, ord=9),
            dict(base, title="Second", content=long, url="https://x/2", category_rank=1, ord=1),
            dict(base, title="First", content=long, url="https://x/2", category_rank=0, ord=2)]
    root, out, ck = (IO.scratch_dir(spark, n) for n in ("landing", "out", "ck"))
    spark.createDataFrame(rows, LV.LANDED_ARTICLE).repartition(3).write.json(root + "/a")
    LV.run_available_now(LV.live_dedup_stream(spark, root + "/*"), out, ck)
    assert {r["url"]: r["title"] for r in spark.read.parquet(out).collect()} == {"https://x/2": "First"}


def test_stream_equals_batch(spark):
    raw = FX.raw_articles(spark, SF_SMALL)
    landing = LV.land_articles(raw.select(*[f.name for f in IO.RAW_ARTICLE.fields], "category", "ord", "category_rank"),
                               IO.scratch_dir(spark, "landing"))
    out, ck = IO.scratch_dir(spark, "out"), IO.scratch_dir(spark, "ck")
    LV.run_available_now(LV.live_dedup_stream(spark, landing), out, ck)
    stream = sorted((r["url"], r["title"]) for r in spark.read.parquet(out).collect())
    assert stream == sorted((r["url"], r["title"]) for r in C.clean_unique(raw).collect())


def test_empty_newest_snapshot_counts(spark):
    root = IO.scratch_dir(spark, "snapshots")
    rows = FX.raw_articles(spark, SF_SMALL).drop("category_rank")
    IO.save_snapshot(rows, root, "articles_20240101T000000Z")
    IO.save_snapshot(rows.limit(0), root, "articles_20240102T000000Z")
    for by_name in (False, True):
        assert IO.read_latest_snapshot(spark, root, IO.RAW_ARTICLE, by_name).count() == 0


def test_checkpoint_folder_must_be_shared_off_local_mode(spark):
    from types import SimpleNamespace as N

    from eventlens.session import ensure_checkpoint_dir
    none = N(isDefined=lambda: False)
    sc = N(master="spark://host:7077", getConf=lambda: N(get=lambda k, d: None), _jsc=N(sc=lambda: N(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=sc, conf=N(get=lambda k, d: None)))


def test_stream_forgets_after_its_horizon_and_keeps_late_rows(spark):
    """A URL may come again after its horizon; a row older than the horizon goes to the late output."""
    from datetime import datetime

    from pyspark.sql.types import StructField, StructType, TimestampType

    day = lambda n: datetime(2024, 1, n)
    words = " ".join(["word"] * 25)
    base = dict(source={"id": None, "name": "S"}, author=None, description=None, publishedAt=None, category="business", category_rank=0, content=words)

    def batch(rows):
        schema = StructType([*LV.LANDED_ARTICLE.fields, StructField("event_time", TimestampType())])
        df = spark.createDataFrame([dict(base, **r) for r in rows], schema)
        return df.withColumn("expires", F.col("event_time") + F.expr("INTERVAL 3 days"))

    out, state = IO.scratch_dir(spark, "out"), IO.scratch_dir(spark, "state")
    empty = StructType([f for f in LV.SEEN.fields if f.name != "batch"])
    spark.createDataFrame([], empty).withColumn("_order", F.lit(None).cast("long")).write.parquet(f"{state}/seen/batch=-1")
    step = LV._first_copies(out, state)
    step(batch([dict(title="A", url="u1", ord=1, event_time=day(1))]), 0)
    again = [dict(title="B", url="u1", ord=2, event_time=day(3)), dict(title="C", url="u2", ord=3, event_time=day(3))]
    step(batch(again), 1)
    step(batch(again), 1)  # run again after a failure: the same rows
    step(batch([dict(title="D", url="u1", ord=4, event_time=day(9)), dict(title="D", url="u1", ord=4, event_time=day(9))]), 2)
    step(batch([dict(title="E", url="u9", ord=5, event_time=day(2))]), 3)
    got = sorted((r["url"], r["title"]) for r in spark.read.parquet(f"{out}/batch=0", f"{out}/batch=1", f"{out}/batch=2", f"{out}/batch=3").collect())
    assert got == [("u1", "A"), ("u1", "D"), ("u2", "C")]
    assert [r["title"] for r in spark.read.json(f"{out}-late/batch=3").collect()] == ["E"]
