"""Several writers of one model store."""

import datetime as dt
import threading

from tallyglass.operators import registry
from tallyglass.sources.modelstore import ModelStore


def in_parallel(jobs):
    failed = []

    def run(job):
        try:
            job()
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed, failed


def test_parallel_writers_get_distinct_versions(spark, tmp_path):
    root, got = str(tmp_path / "store"), []
    stores = [ModelStore(spark, root) for _ in range(4)]
    in_parallel([lambda s=s, w=w: [got.append(s.register("m", f"r{w}-{i}")) for i in range(5)] for w, s in enumerate(stores)])
    assert sorted(got) == list(range(1, 21))
    rows = ModelStore(spark, root).versions().collect()
    assert sorted(r.version for r in rows) == list(range(1, 21)) and len({r.run_id for r in rows}) == 20


def test_parallel_promotions_leave_one_champion(spark, tmp_path):
    root = str(tmp_path / "store")
    aucs = {"a": 0.7, "b": 0.9, "c": 0.8, "d": 0.9}
    stores = {run: ModelStore(spark, root) for run in aucs}
    for run, auc in aucs.items():
        stores[run].log_run(run, "nightly", metrics={"auc": auc, "accuracy": 0.5, "f1": 0.5})
    outcome = {}
    in_parallel([lambda r=run: outcome.update({r: stores[r].promote("m", r, aucs[r])}) for run in aucs])
    assert sorted(v for v, _ in outcome.values()) == [1, 2, 3, 4]
    # In the order of their commits each was champion exactly if it was strictly better than all before it.
    best = float("-inf")
    for run, (_, alias) in sorted(outcome.items(), key=lambda o: o[1][0]):
        assert alias == ("champion" if aucs[run] > best else "challenger")
        best = max(best, aucs[run])
    store = ModelStore(spark, root)
    champion = {r.alias: r.version for r in registry.current_aliases(store.aliases()).collect()}["champion"]
    assert [run for run, (v, _) in outcome.items() if v == champion][0] in ("b", "d") and store.lookup("m") == champion


def test_times_and_texts_survive(spark, tmp_path):
    store, at = ModelStore(spark, str(tmp_path / "store")), dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    assert store.versions().count() == 0 and store.aliases().count() == 0
    store.register("m", "r", description='a "quoted"\ntext', ts=at)
    store.set_alias("m", 1, "champion", "é", ts=at)
    row, alias = store.versions().first(), store.aliases().first()
    assert (row.ts, row.description, row.version) == (at, 'a "quoted"\ntext', 1) and (alias.ts, alias.description) == (at, "é")
