"""An upsert keeps no copy of its staged keys."""

from wardloom.sinks import snapshot


def test_upsert_writes_no_staged_keys(spark, tmp_path, monkeypatch):
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "id long, v string")
    table = snapshot.SnapshotTable(spark, f"{tmp_path}/t").create_if_absent(rows([], ""), bucket_by=["id"], buckets=4)
    table.append(rows([1, 2, 2, None, 5], "old"))
    written = []
    monkeypatch.setattr(snapshot, "materialize", lambda df, label, *rest: written.append(label) or df)
    counts = table.upsert(rows([2, 2, 3, None], "new"), ["id"])
    assert not written
    assert (counts.rows_in, counts.rows_deleted, counts.rows_out) == (4, 2, 7)
    assert sorted((r["id"] or 0, r["v"]) for r in table.read().collect()) == [(0, "new"), (0, "old"), (1, "old"), (2, "new"), (2, "new"), (3, "new"), (5, "old")]
