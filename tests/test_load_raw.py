"""Landing raw files: each row is staged once, and loading a batch again replaces it."""

from making import rows
from test_event_index import land, line

from tallyflow.plans import daily
from tallyflow.sources import lake as lk


def test_raw_rows_are_staged_once_and_a_batch_is_replaced(spark, lake, tmp_path, monkeypatch):
    folder, names, kept = str(tmp_path / "in"), [], lk.stage
    monkeypatch.setattr(lk, "stage", lambda df, name="stage": names.append(name) or kept(df, name))
    land(folder, 1, line("a", "2024-01-01T08:00:00", 5), line("b", "2024-01-01T09:00:00", 2))
    for _ in range(2):
        assert daily.load_raw(lake, folder, source="API", batch_id="b1", ingest_ts="2024-01-02 00:00:00") == ["b1"]
    assert names == []
    stored = lake.read(lk.USAGE_RAW)
    assert rows(stored.select("batch_id")) == [("b1",), ("b1",)]
