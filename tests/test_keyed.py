"""K4-K6 keyed tables: replay safety and compaction."""

import pytest

from clickflow.sinks.keyed import KeyedTable


def _batches():
    # batch n writes key k%4 with value n for a few keys
    return [[(f"k{(n + j) % 4}", n * 10 + j) for j in range(2)] for n in range(8)]


def _state(spark, t, upto=None):
    return sorted(tuple(r) for r in t.current(spark, upto=upto).collect())


@pytest.mark.parametrize("kind", ["latest", "sum"])
def test_compaction_does_not_change_reads(spark, tmpdir_, kind):
    plain = KeyedTable(f"{tmpdir_}/plain", "k STRING, v BIGINT", ["k"], kind)
    comp = KeyedTable(f"{tmpdir_}/comp", "k STRING, v BIGINT", ["k"], kind, compact_every=3)
    for t in (plain, comp):
        t.ensure(spark)
    for n, rows in enumerate(_batches()):
        df = spark.createDataFrame(rows, "k STRING, v BIGINT")
        plain.write(df, n)
        comp.write(df, n)
        for upto in (n - 1, n):
            assert _state(spark, plain, upto) == _state(spark, comp, upto)
    assert _state(spark, plain) == _state(spark, comp)


def test_replayed_batch_leaves_tables_unchanged(spark, tmpdir_):
    tables = {kind: KeyedTable(f"{tmpdir_}/{kind}", "k STRING, v BIGINT" if kind != "set" else "k STRING",
                               ["k"], kind, compact_every=2) for kind in ("latest", "sum", "set")}
    for t in tables.values():
        t.ensure(spark)
    snapshots = []
    for n, rows in enumerate(_batches()[:4]):
        for kind, t in tables.items():
            df = spark.createDataFrame(rows, "k STRING, v BIGINT")
            t.write(df.select("k") if kind == "set" else df, n)
        snapshots.append({k: _state(spark, t) for k, t in tables.items()})
    # Replay batch 3, a compaction point, as a restarted stream does, twice.
    for n in (3, 3):
        rows = _batches()[n]
        for kind, t in tables.items():
            df = spark.createDataFrame(rows, "k STRING, v BIGINT")
            t.write(df.select("k") if kind == "set" else df, n)
    assert {k: _state(spark, t) for k, t in tables.items()} == snapshots[-1]


def test_latest_keeps_unwritten_keys_and_sum_adds(spark, tmpdir_):
    lt = KeyedTable(f"{tmpdir_}/l", "k STRING, v BIGINT", ["k"], "latest")
    st = KeyedTable(f"{tmpdir_}/s", "k STRING, v BIGINT", ["k"], "sum")
    for t in (lt, st):
        t.ensure(spark)
        t.write(spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v BIGINT"), 0)
        t.write(spark.createDataFrame([("a", 5)], "k STRING, v BIGINT"), 1)
    assert _state(spark, lt) == [("a", 5), ("b", 2)]
    assert _state(spark, st) == [("a", 6), ("b", 2)]
    assert _state(spark, lt, upto=0) == [("a", 1), ("b", 2)]


def test_partitioned_reads_prune_and_agree(spark, tmpdir_):
    t = KeyedTable(f"{tmpdir_}/p", "day STRING, k STRING, v BIGINT", ["day", "k"], "sum",
                   compact_every=2, partition_by="day")
    t.ensure(spark)
    for n in range(5):
        rows = [(f"d{(n + j) % 3}", f"k{j}", n + j) for j in range(3)]
        t.write(spark.createDataFrame(rows, "day STRING, k STRING, v BIGINT"), n)
    full = _state(spark, t)
    part = sorted(tuple(r) for r in t.current(spark, partitions=["d1"]).collect())
    assert part == [r for r in full if r[0] == "d1"]
    files = t.current(spark, upto=4, partitions=["d1"]).inputFiles()
    assert files and all("day=d1/" in f for f in files)


def test_files_stay_flat_over_many_batches(spark, tmpdir_):
    t = KeyedTable(f"{tmpdir_}/t", "day STRING, k STRING, v BIGINT", ["day", "k"], "sum",
                   compact_every=5, partition_by="day")
    t.ensure(spark)
    folders, files = [], []
    for n in range(60):
        df = spark.createDataFrame([(f"d{n // 20}", f"k{n % 3}", 1)], "day STRING, k STRING, v BIGINT").coalesce(1)
        t.write(df, n)
        folders.append(len(t._batches(spark)) + len(t.snapshots(spark)))
        files.append(len(t.current(spark, upto=n, partitions=t.partitions_of(spark, n)).inputFiles()))
    assert max(folders[30:]) <= max(folders[:30]) + 3
    assert max(files[30:]) <= max(files[:30])
    assert _state(spark, t) == sorted((f"d{d}", f"k{k}", sum(1 for n in range(20 * d, 20 * d + 20) if n % 3 == k))
                                      for d in range(3) for k in range(3))
    # Compaction writes changed partitions only; unchanged ones keep their copy.
    last = t.snapshots(spark)[-1]
    assert t._parts(spark, f"{t._snapshots_path()}/upto={last}") == ["day=d2"]


@pytest.mark.parametrize("every", [(0, 2), (2, 0), (3, 2), (2, 5)])
def test_compact_every_may_change_between_runs(spark, tmpdir_, every):
    make = lambda c: KeyedTable(f"{tmpdir_}/t", "k STRING, v BIGINT", ["k"], "sum", compact_every=c)
    for n in range(8):
        t = make(every[n >= 4])
        t.ensure(spark)
        t.write(spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), n)
        assert _state(spark, t, n) == [("a", n + 1)]
    assert _state(spark, make(every[0])) == _state(spark, make(every[1])) == [("a", 8)]
