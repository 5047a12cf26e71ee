"""Cleaning of streams against cleaning all lines at once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from surtido.operators.cleaning import clean_lines
from surtido.streaming import lines as stream


def shown(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def parts(raw_lines):
    """Nine parts of lines with copies, nulls in any column, and equal hashes of moved nulls."""
    rng = random.Random(4)
    rows = [dict(InvoiceNo=rng.choice(("1", "2", "C3", None)),
                 Description=rng.choice(("x", None)), Country=rng.choice(("x", None)),
                 Quantity=rng.choice((1, 2, -1, None)), UnitPrice=rng.choice((0.0, 1.5, None)),
                 InvoiceDate=rng.choice((None, dt.datetime(2011, rng.randrange(1, 13), 3, 8))))
            for _ in range(60)]
    return [raw_lines(*rng.choices(rows, k=20)) for _ in range(9)]


def test_copies_go_however_far_apart_they_arrive(spark, parts, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(
            source)
        stream.clean_lines_as_they_come(arriving, folder, str(tmp_path / "state"),
                                        merged=2).awaitTermination()
        got = stream.read_clean_lines(spark, folder)
        assert shown(got) == shown(clean_lines(spark.read.parquet(source)))
    levels = {f.name for f in (tmp_path / "out" / "indice").iterdir()}
    assert levels >= {"nivel=0", "nivel=1", "nivel=2", "nivel=3"}
    assert len(list((tmp_path / "out" / "indice" / "nivel=0").iterdir())) <= 4


def test_a_repeated_batch_writes_the_same(spark, parts, tmp_path, monkeypatch):
    folder = str(tmp_path)
    whole = stream._write_index
    for number, part in enumerate(parts[:6]):
        def lost(rows, *place):
            whole(rows, *place)
            raise RuntimeError("lost")
        for _ in range(2):
            with monkeypatch.context() as patch:
                patch.setattr(stream, "_write_index", lost)
                with pytest.raises(RuntimeError):
                    stream.clean_batch(part, folder, number, 2)
        stream.clean_batch(part, folder, number, 2)
        stream.clean_batch(part, folder, number, 2)
    rows = parts[0]
    for part in parts[1:6]:
        rows = rows.unionByName(part)
    assert shown(stream.read_clean_lines(spark, folder)) == shown(clean_lines(rows))


def test_only_touched_months_of_the_index_are_read(spark, raw_lines, tmp_path):
    folder = str(tmp_path)
    for number in range(2):
        stream.clean_batch(raw_lines(*[{"InvoiceDate": dt.datetime(2011, m, 3), "Quantity": m}
                                       for m in range(1, 13)]), folder, number)
    known = stream._index(spark, folder, stream.open_folders(2)).where("mes = '2011-05-01'")
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PushedFilters: []" in text
    files = {r[0] for r in known.select(F.input_file_name()).collect()}
    assert len(files) == 2 == known.count() and all("mes=2011-05-01" in f for f in files)


def test_open_folders_hold_every_batch_once():
    def batches(level, number, merged):
        if not level:
            return [number]
        return [b for k in range(number * merged, (number + 1) * merged)
                for b in batches(level - 1, k, merged)]

    for merged in (2, 3, 16):
        for batch in range(300):
            held = [b for f in stream.open_folders(batch, merged) for b in batches(*f, merged)]
            assert sorted(held) == list(range(batch))
            assert len(stream.open_folders(batch, merged)) <= merged * 10
