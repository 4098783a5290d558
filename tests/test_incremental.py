from datetime import datetime, timedelta

import pytest

from ouvidoria.operators import incremental as inc

START = datetime(2024, 1, 1)


def hours(h):
    return START + timedelta(hours=h)


@pytest.fixture
def pages(spark):
    """Page 0 is the newest; each page shows its oldest time."""
    data = [(p, hours(100 - 10 * p + r), hours(100 - 10 * p)) for p in range(6) for r in range(3)]
    return spark.createDataFrame(data, "page int, ts timestamp_ntz, page_ts timestamp_ntz")


def walk(mark):
    """Load pages until one is at or below the mark."""
    loaded = [0]
    while mark is not None and hours(100 - 10 * loaded[-1]) > mark and len(loaded) < 6:
        loaded.append(loaded[-1] + 1)
    return loaded


@pytest.mark.parametrize("mark", [None, hours(75), hours(70), hours(100), hours(500), hours(1), hours(50)])
def test_frontier_loads_the_same_pages_as_the_walk(pages, mark):
    got = {r.page for r in inc.frontier(pages, mark).select("page").distinct().collect()}
    assert got == set(walk(mark))
    if mark is not None:
        assert inc.frontier(pages, str(mark)).count() == inc.frontier(pages, mark).count()


def test_gate(pages):
    current = inc.current_mark(pages)
    assert inc.gate(pages, None, current).count() == 0
    assert inc.gate(pages, hours(100), current).count() == 0
    assert inc.gate(pages, hours(99), current).count() == 18


def test_frontier_needs_no_global_order(pages, plan):
    text = plan(inc.frontier(pages, hours(75)))
    assert "Window" not in text and "rangepartitioning" not in text and "Join" not in text


def test_mark_store_keeps_its_newest_entry(spark, tmp_path):
    store = inc.MarkStore(spark, str(tmp_path / "mark"))
    assert store.read() is None
    store.write(hours(5))
    store.write(hours(7).replace(microsecond=250000))
    store.write(hours(6))
    assert store.read() == hours(7).replace(microsecond=250000)
    assert any("01/01/2024 05:00:00" in f.read_text() for f in (tmp_path / "mark").glob("*.txt"))


def test_mark_written_by_hand(spark, tmp_path):
    (tmp_path / "mark.txt").write_text("02/01/2024 03:04:05\n")
    assert inc.MarkStore(spark, str(tmp_path / "mark.txt")).read() == datetime(2024, 1, 2, 3, 4, 5)


@pytest.mark.parametrize("record_level", [False, True])
def test_runs(spark, tmp_path, pages, record_level):
    store, emitted = inc.MarkStore(spark, str(tmp_path / "mark")), []

    def run(df):
        return inc.run_increment(df, store, lambda d: emitted.append({r.ts for r in d.collect()}), record_level)

    old = pages.where("page >= 3")
    assert run(old) is False and emitted == []  # the first run stores the mark only
    assert run(old) is False and emitted == []  # nothing new
    assert run(pages) is True
    new = {hours(100 - 10 * p + r) for p in range(3) for r in range(3)}
    page_at_mark = {hours(70 + r) for r in range(3)}
    assert emitted == [new if record_level else new | page_at_mark]
    assert run(pages) is False


def test_sink_failure_keeps_the_mark(spark, tmp_path, pages):
    store = inc.MarkStore(spark, str(tmp_path / "mark"))
    store.write(hours(60))

    def fail(_):
        raise OSError("sink down")

    with pytest.raises(OSError):
        inc.run_increment(pages, store, fail)
    assert store.read() == hours(60)
    assert inc.run_increment(pages.where("false"), store, fail) is False
