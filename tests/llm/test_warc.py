import gzip
import hashlib
from pathlib import Path

from pyspark.sql import functions as F

from loomtext.llm import warc

PAGES = "page_id bigint, url string, html string, file int, record_no string"
ROWS = [(i, f"http://host/{i}", f"<html>{'é ' * (i % 7)}page {i}\r\n\r\n</html>", 1, None) for i in range(200)]
ROWS += [(500, None, None, None, None), (501, "http://a/\r\nb", "", 1, "x"), (None, None, None, None, None), (7, "http://twin", "<p>", 1, "")]


def replica(spark, tmp_path, name="a", rows=ROWS, file_records=30):
    path = str(tmp_path / name)
    records = warc.archive(spark.createDataFrame(rows, PAGES), file_records)
    warc.write_warc(records, path)
    return path


def test_files_are_warc_and_read_back_whole(spark, tmp_path):
    path = replica(spark, tmp_path)
    files = sorted(Path(path).glob("file=*/*.gz"))
    assert len(files) == -(-len(ROWS) // 30)
    payloads = []
    for f in files:
        data = gzip.decompress(f.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.0\r\n")
            n = int(head.rpartition(b"Content-Length: ")[2])
            payloads.append(rest[:n])
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]
    assert sorted(payloads) == sorted((r[2] or "").encode() for r in ROWS)
    back = warc.read_warc(spark, path).collect()
    assert sorted(bytes(r["record"]).partition(b"\r\n\r\n")[2] for r in back) == sorted(payloads)
    assert sorted(str(r["page_id"]) for r in back) == sorted(str(r[0]) for r in ROWS)


def test_offsets_lead_to_the_records(spark, tmp_path):
    path = replica(spark, tmp_path)
    for r in warc.leaves(warc.read_warc(spark, path)).collect():
        data = gzip.decompress(next(Path(path).glob(f"file={r['file']}/*.gz")).read_bytes())
        assert hashlib.sha256(data[r["start"] : r["end"]]).hexdigest() == r["hash"]


def audit(spark, one, two, fan=4):
    a, b = (warc.leaves(warc.read_warc(spark, p)) for p in (one, two))
    return {(r["file"], r["record_no"], r["kind"]) for r in warc.audit(a, b, fan).collect()}, a


def test_equal_replicas_have_equal_roots(spark, tmp_path):
    one = replica(spark, tmp_path)
    two = replica(spark, tmp_path, "b", ROWS[::-1])
    assert audit(spark, one, two)[0] == set()


def test_damage_is_located(spark, tmp_path):
    one, two = replica(spark, tmp_path), str(tmp_path / "b")
    records = warc.read_warc(spark, one)
    tree = warc.leaves(records)
    warc.write_warc(warc.aged(records, tree), two, order="at", exchange=False)
    want = set()
    last = {r["file"]: r["n"] for r in tree.groupBy("file").agg(F.max("no").alias("n")).collect()}
    for r in tree.collect():
        chance = hashlib.md5(str("" if r["page_id"] is None else r["page_id"]).encode()).hexdigest()[:2]
        if r["file"] % 3 == 1 and r["no"] == last[r["file"]]:
            want.add((r["file"], r["no"], "missing"))
        elif chance < "06":
            want.add((r["file"], r["no"], "changed"))
        elif chance >= "fd":
            want.add((r["file"], r["no"], "resized"))
    got, _ = audit(spark, one, two)
    assert got == want and {k for _, _, k in want} >= {"missing", "changed"}
    swapped, _ = audit(spark, two, one)
    assert {(f, n) for f, n, _ in swapped} == {(f, n) for f, n, _ in want}


def test_lost_files_and_empty_archives(spark, tmp_path):
    one, two = replica(spark, tmp_path), replica(spark, tmp_path, "b", ROWS[:20])
    got, tree = audit(spark, one, two)
    assert len(got) >= len(ROWS) - 20 - 10
    empty = tree.limit(0)
    assert warc.audit(tree, empty).count() == len(ROWS)
    assert warc.audit(empty, empty).collect() == []
    assert warc.archive(spark.createDataFrame([], PAGES)).collect() == []


def test_repeated_pages_and_ties(spark, tmp_path):
    rows = [(1, "u", "same", 1, None)] * 50 + [(1, "u", "other", 1, None)] * 3
    path = replica(spark, tmp_path, "t", rows, file_records=10)
    assert warc.read_warc(spark, path).count() == 53
