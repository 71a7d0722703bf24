"""The CSV data source against Python's reader over whole files, in batches and in streams."""

import csv
import io
import os
import random

import pytest

from tablefolio.sources.csv_records import CsvRecords, csv_files, read_csv_records


def plain(text):
    text = text.removeprefix("﻿")
    return [] if text.count('"') % 2 else [r for r in csv.reader(io.StringIO(text, newline="")) if r]


def files():
    rng = random.Random(9)
    out = {"none.csv": "", "open.csv": 'a,"b\nc\n', "bom.csv": '﻿a,b\r\n\r\n"c\r\nd",\r\n', "last.csv": "a\n\n\nb,c",
           "long.csv": "x," + '"' + "é\n" * 30_000 + '"\ny\n', "odd name+%20 é.csv": "p,q\n", "blank.csv": "\n\n", "quote.csv": '""""\n"",\n'}
    for k in range(4):
        buffer = io.StringIO(newline="")
        writer = csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
        for _ in range(30):
            writer.writerow(["".join(rng.choice('ab,"\n é') for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(2, 4))])
            if rng.random() < 0.1:
                buffer.write("\n")
        out[f"random{k}.csv"] = buffer.getvalue()
    return out


@pytest.mark.parametrize("range_bytes", [97, 400, 1 << 26])
def test_as_whole_files(spark, tmp_path, range_bytes):
    texts = files()
    if range_bytes < 100:
        del texts["long.csv"]  # too many ranges for a small test
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = {}
    for r in read_csv_records(spark, str(tmp_path), range_bytes).collect():
        got.setdefault(os.path.basename(r.file_path), {})[r.record_idx] = r.fields
    want = {name: dict(enumerate(plain(text))) for name, text in texts.items() if plain(text)}
    assert got == want
    assert {os.path.basename(r.file_path) for r in csv_files(spark, str(tmp_path)).collect()} == set(texts) - {"none.csv"}


def test_empty_folder_has_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv_records(spark, str(tmp_path)).collect() == []


def test_stream_takes_each_file_once(spark, tmp_path):
    """Bounded runs over a growing folder: a restart goes on after the last file taken, in batches of two files."""
    spark.dataSource.register(CsvRecords)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.mkdir(folder)

    def put(name, text, time):
        path = f"{folder}/{name}"
        with open(f"{folder}/_{name}", "w") as f:
            f.write(text)
        os.utime(f.name, (time, time))
        os.rename(f.name, path)

    def run():
        stream = spark.readStream.format("csv_records").option("path", folder).option("maxFiles", 2).load()
        stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination(120)
        return sorted(tuple(r.fields) for r in spark.read.parquet(out).collect())

    for k in range(3):
        put(f"f{k}.csv", f'{k},"two\nlines"\nx,y\n', 1000 + k)
    put("bad.csv", 'a,"b\n', 1001)
    first = run()
    assert set(first) <= {(str(k), "two\nlines") for k in range(3)} | {("x", "y")}
    while len(first) < 6:
        before, first = first, run()
        assert len(first) > len(before)
    put("late.csv", "late,1\n", 2000)
    put("same-time.csv", "late,2\n", 2000)
    assert run() == sorted([*first, ("late", "1"), ("late", "2")])
    assert run() == sorted([*first, ("late", "1"), ("late", "2")])
