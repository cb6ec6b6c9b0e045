"""T-01: ingest twice = ingest once; the batch twin adds only unseen files."""

import os

from pyspark.sql import functions as F

from wellspring.session import scratch_path
from wellspring.streaming.ingest import append_unseen, ingest_new_files, refresh_stats, stats_from_state


def _write_logger(spark, folder, rows):
    df = spark.createDataFrame(rows, "Geraet int, DatumUhrzeit string, Leitfaehigkeit double, Temperatur double")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def test_stream_ingest_is_idempotent(spark):
    src = scratch_path(spark, "t-src")
    sink, ckpt = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    _write_logger(spark, os.path.join(src, "K09"), [
        (4182018, "2022-09-27 10:55:00", 900.5, 11.2),  # before installation
        (4182018, "2022-09-27 11:00:00", 25000.0, None),
    ])
    ingest_new_files(spark, src, sink, ckpt, installed_since="2022-09-27 10:00:00")
    first = spark.read.parquet(sink).count()
    assert first == 2  # two parameters of the row at 11:00 local (10:00 UTC)
    ingest_new_files(spark, src, sink, ckpt, installed_since="2022-09-27 10:00:00")
    assert spark.read.parquet(sink).count() == first
    _write_logger(spark, os.path.join(src, "K10"), [(4182001, "2022-09-28 12:00:00", 800.0, 10.0)])
    ingest_new_files(spark, src, sink, ckpt, installed_since="2022-09-27 10:00:00")
    assert spark.read.parquet(sink).count() == first + 2
    stats = {(r.sensor_id, r.parameter): r for r in refresh_stats(spark, sink).collect()}
    assert stats[(4182018, "Leitfaehigkeit")].max is None  # 25000 > 20000 is nulled
    assert stats[(4182018, "Leitfaehigkeit")].number_of_samples == 1


def test_append_unseen(spark):
    old = spark.createDataFrame([("a.csv", 1)], "file string, v int")
    new = spark.createDataFrame([("a.csv", 1), ("b.csv", 2)], "file string, v int")
    out = append_unseen(old, new)
    assert sorted(r.file for r in out.collect()) == ["a.csv", "b.csv"]
    assert out.where(F.col("file") == "a.csv").count() == 1


def test_files_that_do_not_fit_are_set_aside(spark, tmp_path):
    """One good and several bad files in one run; the next run takes the next good file only."""
    src, sink = tmp_path / "K 09 ä+", str(tmp_path / "sink")
    src.mkdir()
    header = "Geraet,DatumUhrzeit,Leitfaehigkeit,Temperatur\n"
    (src / "good [1].csv").write_text(header + "1,2023-01-01 00:00:00,900,11.5\n1,2023-01-01 00:05:00,,\n")
    (src / "swapped.csv").write_text("Geraet,DatumUhrzeit,Temperatur,Leitfaehigkeit\n1,2023-01-01 00:00:00,11.5,900\n")
    (src / "text.csv").write_text(header + "2,2023-01-01 00:00:00,much,1\n2,2023-01-01 00:05:00,1,1\n")
    (src / "more.csv").write_text(header.strip() + ",x\n3,2023-01-01 00:00:00,1,1,1\n")
    (src / "none.csv").write_text("")
    assert ingest_new_files(spark, str(src), sink, str(tmp_path / "ck")) == 0
    rows = spark.read.parquet(sink).collect()
    assert {(os.path.basename(r.file), r.sensor_id, r.parameter, r.messwert) for r in rows} == {
        ("good [1].csv", 1, "Leitfaehigkeit", 900.0), ("good [1].csv", 1, "Temperatur", 11.5), ("good [1].csv", 1, "Leitfaehigkeit", None), ("good [1].csv", 1, "Temperatur", None)}
    bad = {os.path.basename(r.file): (r.reason, r.n_rows, r.n_misfits) for r in spark.read.parquet(sink + "_quarantine").collect()}
    assert bad == {"swapped.csv": ("header does not fit", 2, 1), "text.csv": ("rows do not fit", 2, 1), "more.csv": ("header does not fit", 2, 2)}
    (src / "later.csv").write_text(header + "4,2023-01-02 00:00:00,1,2\n")
    assert ingest_new_files(spark, str(src), sink, str(tmp_path / "ck")) == 1
    assert ingest_new_files(spark, str(src), sink, str(tmp_path / "ck")) is None
    assert spark.read.parquet(sink).count() == 6


def test_statistics_from_the_state(spark, tmp_path):
    """Counts of values add up over runs; the rows of earlier runs are not needed."""
    header = "Geraet,DatumUhrzeit,Leitfaehigkeit,Temperatur\n"
    src, sink, state, ck = (str(tmp_path / n) for n in ("src", "sink", "state", "ck"))
    os.mkdir(src)
    for run in range(3):
        lines = [f"{i % 2},2023-01-0{run + 1} 00:{i:02d}:00,{(i * 37 + run) % 23 * 1000},{'' if i % 5 == 0 else i % 7}" for i in range(40)]
        with open(f"{src}/{run}.csv", "w") as f:
            f.write(header + "\n".join(lines) + "\n")
        ingest_new_files(spark, src, sink, ck, state_dir=state)
    expected = {(r.sensor_id, r.parameter): r for r in refresh_stats(spark, sink).collect()}
    os.rename(sink, sink + "_elsewhere")
    found = stats_from_state(spark, state).collect()
    assert len(found) == len(expected) == 4
    for r in found:
        want = expected[r.sensor_id, r.parameter]
        assert r.asDict().keys() == want.asDict().keys()
        for c in ("datetime_min", "datetime_max", "min", "q10", "median", "q90", "max", "number_of_samples"):
            assert r[c] == want[c], c
        assert abs(r["mean"] - want["mean"]) < 1e-9
