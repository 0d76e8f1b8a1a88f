import pytest
from records import line, rows

from paytally.plans import load_payments
from paytally.schema import TABLES
from paytally.sinks import Warehouse
from paytally.sources import landing_path, parse_payments
from paytally.streaming import ingest, ingest_available


def day_lines(day):
    at = f"2017-01-{day:02}T10:00:00Z"
    return [line("7", "9", at=at), line("9", "7", at=at), line(str(day), "7", at=at), "{bad"]


HIDDEN = {f".payments_2017_01_0{day}.json.crc" for day in (5, 6, 7)}


def stored(warehouse):
    return {table: rows(warehouse.read_table(table)) for table in TABLES}


def test_files_in_steps_equal_one_batch(spark, warehouse, lines, tmp_path):
    root = tmp_path / "bucket"
    landing = root / "unprocessed"
    landing.mkdir(parents=True)
    folders = [str(landing), str(root / "processed"), str(tmp_path / "checkpoint")]

    for day in (5, 6, 7):
        path = landing_path(str(root), 2017, 1, day)
        with open(path, "w") as file:
            file.write("\n".join(day_lines(day)))
        (counts,) = ingest_available(spark, *folders, warehouse)
        assert counts["pair_activity"] == 2

    assert ingest_available(spark, *folders, warehouse) == []

    # Each file has left the landing folder with its run.
    assert list(landing.iterdir()) == []
    archived = {p.name for p in (root / "processed").iterdir()} - HIDDEN
    assert archived == {f"payments_2017_01_0{day}.json" for day in (5, 6, 7)}

    batch = Warehouse(spark, str(tmp_path / "batch"), warehouse.database + "_batch")
    load_payments(parse_payments(lines(*[t for d in (5, 6, 7) for t in day_lines(d)])), batch)
    assert stored(warehouse) == stored(batch)


def test_a_replayed_file_adds_nothing(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text("\n".join(day_lines(5)))
    archive = str(tmp_path / "archive")
    ingest_available(spark, str(landing), archive, str(tmp_path / "one"), warehouse)
    before = stored(warehouse)
    # A fresh checkpoint has forgotten the file, so it comes again.
    (tmp_path / "archive" / "a.json").rename(landing / "a.json")
    (counts,) = ingest_available(spark, str(landing), archive, str(tmp_path / "two"), warehouse)
    assert set(counts.values()) == {0}
    assert stored(warehouse) == before


@pytest.fixture
def backlog(tmp_path):
    """Three days in the landing folder: the 5th in two files, the 6th as a folder of
    parts, the 7th in one file."""
    landing = tmp_path / "bucket" / "landing"
    parts = landing / "payments_2017_01_06.json"
    parts.mkdir(parents=True)
    texts = {day: day_lines(day) for day in (5, 6, 7)}
    (landing / "payments_2017_01_05.json").write_text("\n".join(texts[5][:2]))
    (landing / "late_2017_01_05.json").write_text("\n".join(texts[5][2:]))
    (parts / "part-0").write_text("\n".join(texts[6][:1]))
    (parts / "part [1].txt").write_text("\n".join(texts[6][1:]))
    (parts / "_SUCCESS").touch()
    (landing / "payments_2017_01_07.json").write_text("\n".join(texts[7]))
    folders = [str(landing), str(tmp_path / "bucket" / "done"), str(tmp_path / "checkpoint")]
    return landing, folders, [t for day in texts.values() for t in day]


def test_a_backlog_is_loaded_in_steps_of_whole_days(spark, warehouse, lines, backlog):
    landing, folders, texts = backlog
    counts = ingest_available(spark, *folders, warehouse, step_bytes=1)
    assert [c["pair_activity"] for c in counts] == [2, 2, 2]
    batch = Warehouse(spark, warehouse.location + "_batch", warehouse.database + "_batch")
    load_payments(parse_payments(lines(*texts)), batch)
    assert stored(warehouse) == stored(batch)
    assert list(landing.iterdir()) == []
    assert ingest_available(spark, *folders, warehouse) == []


def test_steps_are_bounded_and_split_no_day():
    files = [("a_2017_01_05.json", 5), ("x/b_2017_01_04.json/part-1", 3), ("c_2017_01_05.json", 5)]
    files += [("d_2017_01_06.json", 1), ("e_2017_01_07.json", 1), ("no day", 2)]
    found = [(list(s), sum(n for day in s.values() for _, n in day)) for s in ingest.steps(files, 6)]
    assert found == [
        (["", "2017-01-04"], 5),
        (["2017-01-05"], 10),
        (["2017-01-06", "2017-01-07"], 2),
    ]
    assert list(ingest.steps([], 6)) == []


def test_a_failed_batch_goes_on_where_it_was(spark, warehouse, lines, backlog, monkeypatch):
    landing, folders, texts = backlog
    fine, seen = ingest.load_payments, []

    def failing(payments, house):
        seen.append(len(payments.inputFiles()))
        if len(seen) == 2:
            raise OSError("disk gone")
        return fine(payments, house)

    monkeypatch.setattr(ingest, "load_payments", failing)
    with pytest.raises(Exception, match="disk gone"):
        ingest_available(spark, *folders, warehouse, step_bytes=1)
    # Nothing has been committed, so nothing is archived.
    assert len(list(landing.rglob("*2017*.json"))) == 4
    counts = ingest_available(spark, *folders, warehouse, step_bytes=1)
    assert len(counts) == 2  # the 6th and the 7th
    batch = Warehouse(spark, warehouse.location + "_batch", warehouse.database + "_batch")
    load_payments(parse_payments(lines(*texts)), batch)
    assert stored(warehouse) == stored(batch)
    assert list(landing.iterdir()) == []


def test_files_of_a_run_that_died_before_archiving_are_moved_by_the_next(
    spark, warehouse, backlog, monkeypatch
):
    landing, folders, _ = backlog
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_archive", lambda *_: None)
        assert len(ingest_available(spark, *folders, warehouse)) == 1
    assert len(list(landing.rglob("*2017*.json"))) == 4
    before = stored(warehouse)
    assert ingest_available(spark, *folders, warehouse) == []
    assert list(landing.iterdir()) == [] and stored(warehouse) == before


def test_an_archived_file_is_never_replaced(spark, warehouse, backlog, tmp_path):
    _, folders, _ = backlog
    done = tmp_path / "bucket" / "done"
    done.mkdir()
    (done / "payments_2017_01_07.json").write_text("of another year")
    ingest_available(spark, *folders, warehouse)
    assert (done / "payments_2017_01_07.json").read_text() == "of another year"
    assert (done / "payments_2017_01_07.json.0").exists()
