"""WARC files: exact round trip, same files again, bounded sizes."""

import gzip
import hashlib
import random

import pytest
from pyarrow import fs

from tablefolio.llm import warc
from tablefolio.llm.common import at, fresh_folder

PAGES = "page_id long, url string, html string, k string, sha1 string, size string, shard string, kind string"


def pages():
    rng = random.Random(2)
    big = ["".join(rng.choices("abc é😀<>\r\n", k=n)) for n in (1000, 1500, 40_000)]
    rows = [(i, f"http://x/{i}", rng.choice([None, "", "<p>short", "<p>short", *big, f"own {i} " * rng.randint(1, 400)])) for i in range(300)]
    rows += [(None, "http://none", big[0]), (None, None, "x"), (7, "http://x/7", big[1]), (7, "http://x/7", big[1]),
             (10**12, "http://x/a b\r\nEvil: 1", big[2]), (-5, "http://minus", big[2]), (500, "u", "a" * 999), (501, "u", "a" * 999)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], PAGES)


def brute(rows):
    latest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            latest[data] = max(latest.get(data, -(1 << 63)), i if i is not None else -(1 << 63))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = latest.get(data)
        again = to is not None and to != (i if i is not None else -(1 << 63))
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def archive(spark):
    folder = fresh_folder(spark, "test-warc")
    manifest = warc.write_warc(frame(spark, pages()), folder, shard_bytes=200_000, roll_bytes=20_000).collect()
    return folder, manifest


def test_round_trip(spark, archive):
    got = warc.read_warc(spark, archive[0], keep=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(pages())
    whole = {(i, (h or "").encode()) for i, _, h in pages()}
    assert all((r.page_id, bytes(r.payload)) in whole for r in got if r.record_type == "response")
    assert "http://x/a%20b%0D%0AEvil:%201" in {r.target_uri for r in got}


def test_files_are_ordered_bounded_and_named_in_the_manifest(spark, archive):
    folder, manifest = archive
    files, base = at(folder)
    assert len(manifest) > 5 and max(m.bytes for m in manifest) < 20_000 + 60_000
    last = None
    for m in sorted(manifest, key=lambda m: m.file):
        data = files.open_input_file(f"{base}/{m.file}").read()
        assert len(data) == m.bytes and hashlib.sha256(data).hexdigest() == m.sha256
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        ids = [int(f["X-Page-ID"]) for _, _, f, _ in warc.records(folder, m.file) if "X-Page-ID" in f]
        assert ids == sorted(ids) and (last is None or not ids or last <= ids[0])
        last = ids[-1] if ids else last
        for offset, length, fields, _ in warc.records(folder, m.file):
            assert gzip.decompress(data[offset:offset + length]).startswith(b"WARC/1.1")
    uids = [f["WARC-Record-ID"] for m in manifest for _, _, f, _ in warc.records(folder, m.file)]
    assert len(uids) == len(set(uids))
    assert not [f for f in files.get_file_info(fs.FileSelector(base)) if "_temporary" in f.base_name]


def test_same_files_from_other_partitions(spark, archive):
    folder = fresh_folder(spark, "test-warc")
    again = warc.write_warc(frame(spark, pages()[::-1]).repartition(7), folder, shard_bytes=200_000, roll_bytes=20_000).collect()
    assert sorted(tuple(m) for m in again) == sorted(tuple(m) for m in archive[1])


def test_unlisted_files_are_not_read(spark, archive):
    folder, _ = archive
    files, base = at(folder)
    with files.open_output_stream(f"{base}/_temporary-9-9-shard-000000-0000.warc.gz", compression=None) as out:
        out.write(b"half a file")
    assert warc.read_warc(spark, folder).count() == len(pages())


def test_damage_is_found(spark, archive, tmp_path):
    name = archive[1][0].file
    files, base = at(archive[0])
    data = bytearray(files.open_input_file(f"{base}/{name}").read())
    (tmp_path / name).write_bytes(data[:-3])
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(str(tmp_path), name))


def test_empty(spark):
    folder = fresh_folder(spark, "test-warc")
    assert warc.write_warc(frame(spark, []), folder).collect() == [] and warc.read_warc(spark, folder).collect() == []
