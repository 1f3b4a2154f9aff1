"""What readers of a running job see, and compaction of its logs."""

import time

import pytest

from clicksieve.functions.columns import hour_bucket
from clicksieve.plans import job
from clicksieve.schema import EVENT_COLUMNS, PATTERN_1, PATTERN_2, PATTERN_3
from clicksieve.session import names_in, touch
from clicksieve.streaming import logs, sinks
from clicksieve.streaming.commits import commit, committed, last_commit
from clicksieve.streaming.detectors import Rules
from test_random import trace
from test_streaming import WINDOW, Feed


def rows(df):
    return sorted(map(tuple, df.select(*EVENT_COLUMNS).collect()))


def test_commits(spark, tmp_path):
    folder = str(tmp_path)
    assert last_commit(spark, folder) == -1
    for n in (0, 1, 2, 2, 10):
        commit(spark, folder, n)
    touch(spark, f"{folder}/commits/.hidden")
    assert committed(spark, folder) == [2, 10] and last_commit(spark, folder) == 10


@pytest.mark.parametrize("semantics", ["as_coded", "documented"])
def test_readers_see_whole_micro_batches_only(spark, tmp_path, monkeypatch, semantics):
    feed, folder = Feed(spark, tmp_path / "in", trace(11, 120)), str(tmp_path / "outputs")
    rules = Rules(semantics, WINDOW)

    def seen():
        totals = sorted(map(str, job.read_totals(spark, folder).collect()))
        return totals, *[rows(job.read_log(spark, folder, output)) for output in ("all", PATTERN_1, PATTERN_2, PATTERN_3)]

    assert seen() == ([], [], [], [], [])
    feed.send(60)
    job.run_job(feed.stream(), folder, rules, trigger=None)
    before, bucket = seen(), feed.table().select(hour_bucket()).first()[0]
    report = job.hour_report(spark, folder, bucket).collect()
    assert before[1] == rows(feed.table())

    # The second micro-batch breaks after some of its outputs.
    feed.send(60)
    save = sinks.save_by_hour

    def breaking(events, place, *more):
        save(events, place, *more)
        if place.endswith("all"):
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "save_by_hour", breaking)
    with pytest.raises(Exception, match="lost"):
        job.run_job(feed.stream(), folder, rules, trigger=None)
    monkeypatch.undo()
    assert seen() == before and job.hour_report(spark, folder, bucket).collect() == report
    job.run_job(feed.stream(), folder, rules, trigger=None)
    assert seen()[1] == rows(feed.table())


def files(folder):
    return sorted(folder.glob("*.txt"))


def test_compaction_by_size(spark, tmp_path, monkeypatch):
    feed, folder = Feed(spark, tmp_path / "in", trace(12, 200)), str(tmp_path)
    feed.send(200)
    pieces = feed.table().randomSplit([1.0] * 6, 1)
    for n, piece in enumerate(pieces[:5]):
        sinks.save_log(piece, f"{folder}/all", n)
        commit(spark, f"{folder}/work", n)
    # Not complete yet: not read, not compacted.
    sinks.save_log(pieces[5], f"{folder}/all", 5)
    whole = job.read_log(spark, folder, "all")
    expected = rows(whole)
    hours = sorted(names_in(spark, f"{folder}/all"))
    sizes = {hour: sum(f.stat().st_size for n in range(5) for f in files(tmp_path / "all" / hour / f"batch={n}")) for hour in hours}
    assert len(hours) > 2 and expected

    # A call that breaks before the new files count changes nothing.
    write = logs.write_compacted

    def breaking(spark, sources, wanted, target):
        write(spark, sources[:1], dict(list(wanted.items())[:1]), target)
        (tmp_path / "compacted" / "all" / "upto=4-0" / "_SUCCESS").unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(logs, "write_compacted", breaking)
    with pytest.raises(RuntimeError, match="lost"):
        job.compact_logs(spark, folder, "9999", 3000)
    monkeypatch.undo()
    assert rows(job.read_log(spark, folder, "all")) == expected

    before = hours[-1].removeprefix("bucket=")
    written = job.compact_logs(spark, folder, before, 3000)
    assert written == {("all", hour.removeprefix("bucket=")): -(-sizes[hour] // 3000) for hour in hours[:-1]}
    for (_, hour), n in written.items():
        made = files(tmp_path / "compacted" / "all" / "upto=4-0" / f"bucket={hour}")
        assert len(made) == n
        # Lines are dealt evenly.
        assert sum(f.stat().st_size for f in made) == sizes[f"bucket={hour}"]
        assert max(f.stat().st_size for f in made) < 3000 + 3 * 120
    assert rows(job.read_log(spark, folder, "all")) == expected
    # Readers that have started before still find their files.
    assert rows(whole) == expected
    hour = hours[0].removeprefix("bucket=")
    assert rows(job.read_log(spark, folder, "all", hour)) == rows(feed.table().where(hour_bucket() == hour).exceptAll(pieces[5]))

    # Another hour closes before the next micro-batch.
    assert set(job.compact_logs(spark, folder, "9999")) == {("all", hours[-1].removeprefix("bucket="))}
    assert rows(job.read_log(spark, folder, "all")) == expected

    # The next call removes what has been replaced, and takes late lines in.
    commit(spark, f"{folder}/work", 5)
    everything = rows(feed.table())
    assert rows(job.read_log(spark, folder, "all")) == everything
    again = job.compact_logs(spark, folder, "9999")
    assert set(again.values()) == {1}
    assert rows(job.read_log(spark, folder, "all")) == everything
    job.compact_logs(spark, folder, "9999")
    assert rows(job.read_log(spark, folder, "all")) == everything
    assert not any(files(tmp_path / "all" / h / f"batch={n}") for h in hours for n in range(6))
    assert len([f for h in hours for f in (tmp_path / "compacted" / "all").glob(f"upto=*/{h}/*.txt")]) == len(hours)
    assert job.compact_logs(spark, folder, "9999") == {}


def test_idle_hours_are_closed(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path / "in", trace(13, 40)), str(tmp_path)
    feed.send(40)
    sinks.save_log(feed.table(), f"{folder}/all", 0)
    commit(spark, f"{folder}/work", 0)
    assert job.compact_logs(spark, folder) == {}
    later = logs.compact(spark, folder, None, 0, clock=lambda: time.time() + logs.IDLE_SECONDS + 1)
    assert {hour for _, hour in later} == {r[0] for r in feed.table().select(hour_bucket()).distinct().collect()}
    assert rows(job.read_log(spark, folder, "all")) == rows(feed.table())
