"""Archived messages: start positions and lost offsets."""

import pytest
from helpers import messages, plan, texts

from sluicegate.sources.archive import LostOffsets, from_offsets, from_timestamps, offset_gaps, whole


def archive(spark, offsets, partition=0):
    rows = messages(spark, ["00"] * (max(offsets) + 1)).where(f"offset in ({','.join(map(str, offsets))})")
    return rows.selectExpr(
        "* except (partition, timestamp)", f"{partition} as partition", "timestamp_millis(1000 * offset) as timestamp"
    )


def test_start_positions(spark):
    rows = archive(spark, range(10)).unionByName(archive(spark, range(4), partition=1))
    count = lambda start: from_offsets(rows, start).count()
    assert [count("earliest"), count("latest"), count("{}")] == [14, 0, 14]
    assert count('{"raw-a": {"0": 7}}') == 3 + 4
    assert count('{"raw-a": {"0": -1, "1": 2}}') == 2
    assert count('{"raw-a": {"0": -2, "1": 99}, "other": {"0": 3}}') == 10
    assert from_offsets(rows, '{"raw-a": {"0": 7}}').columns == rows.columns
    assert "hashpartitioning" not in plan(from_offsets(rows, '{"raw-a": {"0": 7}}'))
    for bad in ("soon", "[1]", '{"a": 1}', '{"a": {"x": 1}}'):
        with pytest.raises(ValueError, match="start positions"):
            from_offsets(rows, bad)


def test_start_times(spark):
    rows = archive(spark, range(10)).unionByName(archive(spark, range(4), partition=1))
    late = rows.selectExpr("* except (timestamp)", "if(offset = 8, timestamp_millis(0), timestamp) as timestamp")
    found = from_timestamps(late, '{"raw-a": {"0": 6500}}')
    assert found.columns == late.columns
    assert texts(found.where("partition = 0"), "offset") == [7, 8, 9]  # the order of offsets counts
    assert found.where("partition = 1").count() == 4
    assert from_timestamps(late, '{"raw-a": {"0": 99000, "1": 3000}}').count() == 1


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
def test_gaps(spark, block):
    offsets = [3, 4, 4, 7, 8, 20, 21, 40]
    rows = archive(spark, offsets).unionByName(archive(spark, offsets)).unionByName(archive(spark, [0, 2], 1))
    found = sorted(tuple(r) for r in offset_gaps(rows, block).collect())
    assert found == [("raw-a", 0, 5, 6, 2), ("raw-a", 0, 9, 19, 11), ("raw-a", 0, 22, 39, 18), ("raw-a", 1, 1, 1, 1)]


def test_an_archive_that_must_be_whole(spark):
    rows = archive(spark, range(5))
    assert whole(rows) is rows
    with pytest.raises(LostOffsets, match="raw-a-0: 2 to 3"):
        whole(archive(spark, [0, 1, 4]))
    assert offset_gaps(rows.where("false")).collect() == []
