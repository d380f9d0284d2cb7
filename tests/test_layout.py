import datetime as dt
import json

import pytest

from murmur.operators.filters import filter_epoch_between, filter_in_list
from murmur.schemas import POST_FIELDS
from murmur.sources.tables import load_posts_layout, load_posts_table, write_posts_layout

DAY = 86400
START = 1730419200  # 2024-11-01


def posts(spark, days=10, per_day=2000):
    rows = [
        (f"p{d * per_day + i:06d}"[::-1], f"s{i % 20:02d}", json.dumps({"author": f"u{i % 7}", "score": i, "created_utc": START + d * DAY + i}))
        for d in range(days)
        for i in range(per_day)
    ]
    return spark.createDataFrame([*rows, ("none", "s00", "{}"), ("bad", "s01", "nope")], "post_id string, subreddit string, data string")


def rows_scanned(frame):
    """Rows that the scan handed on, after row groups were skipped."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("layout")
    raw, layout = str(folder / "raw"), str(folder / "layout")
    posts(spark).repartition(4).write.parquet(raw)
    write_posts_layout(
        spark.read.parquet(raw), layout, POST_FIELDS, file_rows=5000, row_group_bytes=16 << 10
    )
    return raw, layout


def rows(frame):
    return sorted((r.post_id, r.subreddit, r.author, r.votes, r.created) for r in frame.collect())


def test_the_same_table(spark, stored):
    raw, layout = stored
    assert rows(load_posts_layout(spark, layout)) == rows(load_posts_table(spark, raw, POST_FIELDS))


def test_a_time_range_opens_its_days(spark, stored):
    raw, layout = stored
    span = (START + 3 * DAY + 100, START + 4 * DAY + 50)
    got = load_posts_layout(spark, layout, start=span[0], end=span[1])
    want = load_posts_table(spark, raw, POST_FIELDS).where(f"created between {span[0]} and {span[1]}")
    assert rows(got) == rows(want) and got.count() == 1951
    assert rows_scanned(got) <= 4000 < rows_scanned(load_posts_table(spark, raw, POST_FIELDS))
    # the plain filters are pushed into the scan as well
    again = filter_epoch_between(load_posts_layout(spark, layout), *span)
    assert rows(again) == rows(want)


def test_communities_and_keys_skip_row_groups(spark, stored):
    raw, layout = stored
    whole = rows_scanned(load_posts_layout(spark, layout))
    some = load_posts_layout(spark, layout, communities=["s07"])
    assert rows(some) == rows(load_posts_table(spark, raw, POST_FIELDS).where("subreddit = 's07'"))
    assert rows_scanned(some) < whole / 2
    assert rows(filter_in_list(load_posts_layout(spark, layout), "subreddit", ["s07"])) == rows(some)
    one = load_posts_layout(spark, layout, keys=["p000042"[::-1]])
    assert rows(one) == [("p000042"[::-1], "s02", "u0", 42, START + 42)]
    assert rows_scanned(one) < whole / 4
    assert load_posts_layout(spark, layout, keys=["absent"]).count() == 0


def test_bloom_filters_are_written(spark, stored):
    import glob

    import pyarrow.parquet as pq

    _, layout = stored
    files = glob.glob(f"{layout}/day=2024-11-0*/*.parquet")
    assert len(files) >= 4
    # a key inside the range of a file that does not hold it: ranges say nothing, the filter does
    reader = pq.ParquetFile(files[0])
    keys = reader.read(columns=["post_id"]).column(0).to_pylist()
    assert min(keys) < "30000zp" < max(keys)
    assert rows_scanned(load_posts_layout(spark, layout, keys=["30000zp"])) == 0


def test_rows_without_a_time_and_a_given_schema(spark, stored, tmp_path):
    _, layout = stored
    schema = "post_id string, subreddit string, author string, votes int, created bigint"
    got = load_posts_layout(spark, layout, schema)
    assert sorted(r.post_id for r in got.where("created is null").collect()) == ["bad", "none"]
    months = str(tmp_path / "months")
    write_posts_layout(posts(spark, 3, 50), months, POST_FIELDS, per="month")
    some = load_posts_layout(spark, months, schema, start=START + DAY, end=START + DAY + 9, per="month")
    assert some.count() == 10
    assert spark.read.parquet(months).select("day").distinct().count() == 2
    assert spark.read.parquet(months).where("day is not null").first().day == dt.date(2024, 11, 1)
