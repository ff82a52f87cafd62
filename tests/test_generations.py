"""The store of generations: one commit for all tables, written deletes (s2, s3, i9, i10)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import deletes
from ledgerlens.operators import integrity as I
from ledgerlens.plans.inspect import plan_text
from ledgerlens.sources import files
from ledgerlens.sources import schemas as S
from ledgerlens.sources.generations import CommitConflict, Store


def contents(tables):
    return {t: sorted(map(tuple, df.collect()), key=str) for t, df in tables.items()}


@pytest.fixture(scope="module")
def small(spark, ledger):
    """A consistent fifth of the ledger, and the same without a twentieth of it."""
    def some(k):
        customers = ledger.customers.where(f"customer_id % {k} = 0")
        accounts = ledger.accounts.join(customers.select("customer_id"), "customer_id", "left_semi")
        transactions = ledger.transactions.join(accounts.select("account_id"), "account_id", "left_semi")
        keys = transactions.select("transaction_id")
        tables = {"customers": customers, "accounts": accounts, "merchants": ledger.merchants, "transactions": transactions,
                  "settlements": ledger.settlements.join(keys, "transaction_id", "left_semi"), "fraud_flags": ledger.fraud_flags.join(keys, "transaction_id", "left_semi")}
        return {t: tables[t].select(S.SCHEMAS[t].fieldNames()).cache() for t in S.LOAD_ORDER}

    return some(5), some(10)


class Stopped(Exception):
    pass


def test_a_load_stopped_after_any_step_leaves_the_old_generation(spark, small, tmp_path):
    old, new = (files.dump_csv(t, str(tmp_path / f"csv{i}")) for i, t in enumerate(small))
    target = str(tmp_path / "store")
    files.ordered_load(spark, old, target)
    before = contents(Store(spark, target).tables())
    assert before == contents(small[0])
    steps = []
    stopped_at = [f"staged {t}" for t in S.LOAD_ORDER] + ["checked"]
    for stop in stopped_at:
        def on_step(step, stop=stop):
            steps.append(step)
            if step == stop:
                raise Stopped
        with pytest.raises(Stopped):
            files.ordered_load(spark, new, target, on_step=on_step)
        assert Store(spark, target).current().number == 1
    assert set(stopped_at) == set(steps)
    assert contents(Store(spark, target).tables()) == before
    files.ordered_load(spark, new, target)
    assert contents(Store(spark, target).tables()) == contents(small[1])
    assert contents(Store(spark, target).tables(Store(spark, target).generation(1))) == before  # kept until released


def test_a_half_written_manifest_is_passed_over(spark, small, tmp_path):
    store = Store(spark, str(tmp_path))
    first = store.replace({"merchants": small[0]["merchants"]})

    class Torn(Store):
        def _write(self, number, text):
            super()._write(number, text[: len(text) // 2])
            raise Stopped

    with pytest.raises(Stopped):
        Torn(spark, str(tmp_path)).replace({"merchants": small[0]["merchants"].limit(1)})
    assert store.current() == first
    assert store.replace({"merchants": small[0]["merchants"].limit(2)}).number == 3
    assert store.read("merchants").count() == 2
    assert store.release() == [1, 2]
    assert store.read("merchants").count() == 2 and store.generation(1) is None


def test_of_two_writers_from_one_generation_one_fails(spark, small, tmp_path):
    store = Store(spark, str(tmp_path))
    base = store.replace({"customers": small[0]["customers"]})
    parts = store.stage("merchants", small[0]["merchants"])
    store.commit(base, {"merchants": parts})
    with pytest.raises(CommitConflict):
        store.commit(base, {"merchants": []})
    assert store.read("merchants").count() == small[0]["merchants"].count()


def test_a_reader_keeps_its_generation(spark, small, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace({"customers": small[0]["customers"]})
    held = store.read("customers")
    store.replace({"customers": small[1]["customers"]})
    assert held.count() == small[0]["customers"].count() != store.read("customers").count() == small[1]["customers"].count()


def test_lookup_opens_only_parts_whose_range_holds_the_key(spark, ledger, tmp_path):
    store = Store(spark, str(tmp_path))
    gen = store.replace({"transactions": ledger.transactions}, parts=16)
    assert len(gen.tables["transactions"]) == 16 and sum(p.rows for p in gen.tables["transactions"]) == ledger.transactions.count()
    account = ledger.transactions.agg(F.max("account_id")).first()[0] // 2
    found = store.lookup("transactions", account)
    assert len(found.inputFiles()) <= 2
    assert sorted(found.collect()) == sorted(ledger.transactions.where(F.col("account_id") == account).select(found.columns).collect())


def test_empty_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace({t: spark.createDataFrame([], S.SCHEMAS[t]) for t in S.LOAD_ORDER})
    assert all(df.count() == 0 for df in store.tables().values()) and len(store.tables()) == 6
    assert deletes.delete(store, "customers", spark.createDataFrame([(1,)], "x long")).number == 1


@pytest.fixture(scope="module")
def stored(spark, ledger, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    return store, store.replace(ledger.as_dict(), parts=12)


def test_cascade_rewrites_only_touched_parts(spark, ledger, stored):
    store, base = stored
    doomed = ledger.customers.orderBy("customer_id").limit(3).select("customer_id").cache()
    new = deletes.delete(store, "customers", doomed)
    expected = I.cascade_delete(ledger.as_dict(), doomed)
    assert contents(store.tables(new)) == contents({t: expected[t].select(S.SCHEMAS[t].fieldNames()) for t in S.LOAD_ORDER})
    for t in ("customers", "accounts", "transactions"):  # neighbouring keys lie in few parts
        assert len(set(base.tables[t]) - set(new.tables[t])) <= 2, t
        assert len(set(base.tables[t]) & set(new.tables[t])) >= 10, t
    assert new.tables["merchants"] == base.tables["merchants"]


def test_the_rewrite_reads_touched_parts_only(spark, ledger, stored, monkeypatch):
    store, base = stored
    read, hit = [], {}
    real_stage, real_touched = Store.stage, deletes.touched_parts
    monkeypatch.setattr(Store, "stage", lambda self, table, rows, parts=None: (read.append((table, rows.inputFiles())), real_stage(self, table, rows, parts))[1])
    monkeypatch.setattr(deletes, "touched_parts", lambda store, at, table, *a: hit.setdefault(table, real_touched(store, at, table, *a)))
    deletes.delete(store, "accounts", ledger.accounts.where("account_id % 97 = 0").select("account_id"))
    assert {t for t, _ in read} >= {"accounts", "transactions"}
    for table, names in read:
        folders = {n.split("file://")[-1].rpartition("/")[0] for n in names if f"/{table}/generation=" in n}
        assert folders == {f"{store.root}/{p.path}" for p in hit[table]}


def test_set_null_and_stops(spark, ledger, stored):
    store, _ = stored
    at = store.current()
    doomed = ledger.merchants.where("merchant_id % 3 = 0").select("merchant_id")
    before = contents(store.tables())
    for stop in ("rewrote merchants", "rewrote transactions"):
        def on_step(step, stop=stop):
            if step == stop:
                raise Stopped
        with pytest.raises(Stopped):
            deletes.delete(store, "merchants", doomed, on_step)
        assert store.current() == at
    kept, tx = I.set_null_delete(store.read("merchants"), store.read("transactions"), doomed)
    expected = before | contents({"merchants": kept.select(S.SCHEMAS["merchants"].fieldNames()), "transactions": tx.select(S.SCHEMAS["transactions"].fieldNames())})
    deletes.delete(store, "merchants", doomed)
    assert contents(store.tables()) == expected
    assert contents(store.tables(at)) == before


def test_a_hot_account_is_spread_over_tasks(spark):
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("account_id"), F.col("id").alias("transaction_id"))
    gone = spark.createDataFrame([(7,)], "_key long")
    left, right = deletes._salted(rows, gone, "account_id", "transaction_id")
    sizes = [r["count"] for r in left.groupBy("_salt").count().collect()]
    assert len(sizes) == deletes.SALTS == right.count() and max(sizes) < 2 * 20_000 / deletes.SALTS
    assert deletes.without(rows, gone, "account_id", "transaction_id").count() == 0
    assert deletes.among(rows, gone, "account_id", "transaction_id").count() == 20_000


def test_doomed_keys_times_salts_are_never_broadcast(spark, ledger, monkeypatch):
    """few keys are broadcast once each, many meet the rows in a merge join; the planner sees a small file either way."""
    tx = ledger.transactions.where("transaction_id % 5 <> 0 OR merchant_id > 3").unionByName(ledger.transactions.limit(40).withColumn("merchant_id", F.lit(None).cast("long")))
    keys = ledger.merchants.where("merchant_id % 2 = 0").select(F.col("merchant_id").alias("_key"))
    found = {}
    for most in (1_000_000, 1):
        monkeypatch.setattr(deletes, "BROADCAST_KEYS", most, raising=False)
        frames = [change(tx, keys, "merchant_id", "transaction_id") for change in (deletes.without, deletes.among, deletes.nulled)]
        for text in map(plan_text, frames):
            broadcast = text.partition("BroadcastExchange")[2]
            assert ("Generate" in text) != bool(broadcast) and ("SortMergeJoin" in text) != bool(broadcast)
            assert bool(broadcast) == (most > 1)
        found[most] = [sorted(map(tuple, f.collect()), key=str) for f in frames]
    (without, among, nulled), other = found.values()
    assert other == [without, among, nulled]
    doomed = {r._key for r in keys.collect()}
    rows = [tuple(r) for r in tx.collect()]
    at = tx.columns.index("merchant_id")
    assert without == sorted((r for r in rows if r[at] not in doomed), key=str)
    assert among == sorted((r for r in rows if r[at] in doomed), key=str)
    assert nulled == sorted((r[:at] + (None if r[at] in doomed else r[at],) + r[at + 1:] for r in rows), key=str)


def test_a_delete_by_merge_joins_leaves_what_one_by_broadcasts_leaves(spark, ledger, tmp_path, monkeypatch):
    """the rows left in all six tables are the same either way, and every join with doomed keys has the way that was chosen."""
    ways = []
    real = deletes._sides
    monkeypatch.setattr(deletes, "_sides", lambda *a: ways.append(len((found := real(*a))[2])) or found, raising=False)
    doomed = ledger.customers.where("customer_id % 4 = 1").select("customer_id")
    left = []
    for most in (1_000_000, 0):
        monkeypatch.setattr(deletes, "BROADCAST_KEYS", most)
        store = Store(spark, str(tmp_path / str(most)))
        store.replace(ledger.as_dict(), parts=5)
        deletes.delete(store, "customers", doomed)
        left.append(contents(store.tables()))
    expected = I.cascade_delete(ledger.as_dict(), doomed)
    assert left[0] == left[1] == contents({t: expected[t].select(S.SCHEMAS[t].fieldNames()) for t in S.LOAD_ORDER})
    assert len(ways) == 14 and ways == [1] * 7 + [2] * 7


def test_null_keys_are_never_doomed(spark, small, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace({t: df for t, df in small[0].items()})
    n = store.read("transactions").count()
    deletes.delete(store, "merchants", spark.createDataFrame([(None,)], "x long"))
    assert store.current().number == 1 and store.read("transactions").count() == n


def test_parts_are_written_with_one_sort(spark, small, tmp_path, monkeypatch):
    """F5, F6, F8, F10, F13-F15: the writer's order by part is the rows' own, so the rows are sorted once."""
    log, writer = [], type(small[0]["accounts"].write)
    real = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **k: (log.append(self._df), real(self, path, *a, **k))[1])
    store = Store(spark, str(tmp_path / "one"))
    parts = store.stage("accounts", small[0]["accounts"], 3)
    (df,) = log
    order = [str(o) for o in _scala(df._jdf.queryExecution().optimizedPlan().outputOrdering())]
    assert order[0].startswith("part") and len(order) == 3  # what the writer asks for comes first
    keys = [(r.customer_id, r.account_id) for p in parts for r in store.read_parts("accounts", [p]).collect()]
    assert keys == sorted(keys) and len(parts) == 3


def _scala(seq):
    return [seq.apply(i).child().name() for i in range(seq.size())]
