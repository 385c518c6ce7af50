"""How the streaming query lays out its input."""

from pathlib import Path

import pytest

from ledgerlark.checks import stream_checks


def test_second_delivery_is_not_one_file(spark, monkeypatch):
    class Seen(Exception):
        pass

    def stop(spark, path, *rest, **more):
        raise Seen(path)

    monkeypatch.setattr(stream_checks, "refresh_from_files", stop)
    with pytest.raises(Seen) as seen:
        stream_checks.stream_refresh(spark, "/root/testdata/sf0.001")
    path = str(seen.value)
    files = list(Path(path.removeprefix("file:")).glob("part-*.parquet"))
    counts = [spark.read.parquet(str(f)).count() for f in files]
    assert len(counts) == 8 and max(counts) < sum(counts) / 4
