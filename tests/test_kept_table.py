import pytest

from streamscreen.sources.catalog import current_table
from streamscreen.sources.kept_table import KeptTable
from streamscreen.sources.manifest import Manifest
from tests.conftest import rows


def changed(spark, *pairs):
    return spark.createDataFrame([(k, v) for k, v in pairs], "k string, v long").coalesce(1)


def files(path):
    return {p.name for p in path.iterdir() if p.name.startswith("run-")}


def test_a_hundred_batches_are_read_from_few_runs(spark, tmp_path):
    """Every batch changes two of forty keys; the newest row of each counts, and runs stay few."""
    table, want, most = KeptTable(spark, str(tmp_path / "t"), ["k"]), {}, 0
    for batch in range(100):
        own = [(f"k{batch % 40}", batch), (f"k{batch * 7 % 40}", batch)]
        table.write(changed(spark, *set(own)), batch)
        want.update(own)
        most = max(most, len(table.runs()))
    assert most <= 8
    assert rows(table.read()) == sorted(want.items())
    runs = table.runs()
    assert [r["first"] for r in runs] == [0, *[r["last"] + 1 for r in runs[:-1]]] and runs[-1]["last"] == 99
    # Files that no version of the last few names are gone.
    assert len(files(tmp_path / "t")) <= len(runs) + 4 * (KeptTable.GRACE + 1)


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), ["k"])
    table.write(changed(spark, ("a", 1), ("b", 1)), 0)
    table.write(changed(spark, ("a", 2), ("c", 2)), 1)
    assert rows(table.read(upto=0)) == [("a", 1), ("b", 1)]
    table.write(changed(spark, ("a", 3)), 1)
    assert rows(table.read()) == [("a", 3), ("b", 1)]
    assert rows(table.read(upto=0)) == [("a", 1), ("b", 1)]
    table.write(changed(spark, ("b", 4)), 2)
    table.write(changed(spark, ("b", 5)), 3)
    with pytest.raises(ValueError, match="folded"):
        table.write(changed(spark, ("b", 6)), 1)


@pytest.mark.parametrize("at", ["run", "fold", "manifest"])
def test_a_crash_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, at):
    """A writer that dies while writing a run, after folding, or before naming: readers see the version before, a repeat completes it."""
    table, want = KeptTable(spark, str(tmp_path / "t"), ["k"]), {}
    for batch in range(6):
        own = [("x", batch), (f"k{batch}", batch)]
        table.write(changed(spark, *own), batch)
        want.update(own)
    before = rows(table.read())
    real_put, real_replace, calls = KeptTable._put, Manifest.replace, []

    def put(self, frame, first, last):
        made = real_put(self, frame, first, last)
        calls.append((first, last))
        if at == "run" or (at == "fold" and first < last):
            raise RuntimeError("lost")
        return made

    def replace(self, version, state):
        if at == "manifest":
            raise RuntimeError("lost")
        return real_replace(self, version, state)

    monkeypatch.setattr(KeptTable, "_put", put)
    monkeypatch.setattr(Manifest, "replace", replace)
    crashed = False
    for batch in range(6, 10):
        own = [("x", batch), (f"k{batch}", batch)]
        try:
            table.write(changed(spark, *own), batch)
        except RuntimeError:
            crashed = True
            break
        before = rows(table.read())
    assert crashed and rows(KeptTable(spark, str(tmp_path / "t"), ["k"]).read()) == before
    monkeypatch.undo()
    for again in range(batch, 10):
        table.write(changed(spark, ("x", again), (f"k{again}", again)), again)
    want.update({"x": 9, **{f"k{i}": i for i in range(10)}})
    assert rows(table.read()) == sorted(want.items())


def test_two_writers_are_noticed(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.read() == (0, {})
    manifest.replace(0, {"a": 1})
    with pytest.raises(RuntimeError, match="somebody else"):
        Manifest(spark, str(tmp_path / "m")).replace(0, {"a": 2})
    assert manifest.read() == (1, {"a": 1})


def test_empty_batches_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing has been kept"):
        current_table(spark, path, ["k"])
    table = KeptTable(spark, path, ["k"])
    table.write(changed(spark), 0)
    assert rows(table.read()) == []
    for batch in range(1, 12):
        table.write(changed(spark, *([(None, batch), ("a", None)] if batch % 4 == 0 else [])), batch)
    assert rows(current_table(spark, path, ["k"])) == [("a", None), (None, 8)]
    assert len(table.runs()) <= 4


def test_readers_keep_their_version(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"), ["k"])
    for batch in range(3):
        table.write(changed(spark, (f"k{batch}", batch)), batch)
    seen = table.read()
    for batch in range(3, 3 + KeptTable.GRACE):
        table.write(changed(spark, ("k0", batch)), batch)
    assert rows(seen) == [("k0", 0), ("k1", 1), ("k2", 2)]
