import base64
import gzip
import hashlib
import random

import pytest

from dayledger.llm import op2_warc as op
from dayledger.llm.common import new_path
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    assert compare(op.op2_warc(spark, SF), op.SQL, SF)["match"]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(12))) for _ in range(k)]
    out = [runs[r][i] for r, i in op.loser_tree(runs)]
    assert out == sorted(x for r in runs for x in r)


def _index(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, captured string, n int")
    path = new_path(spark, "test-archives")
    op.write_archives(op.captures(pages), path, archive_bytes=4000, **options)
    return op.resolved(op.merged_index(op.read_runs(spark, path), rows_per_task=9))


def test_odd_pages(spark):
    tricky = "line\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n"
    html = {1: "same", 2: "same", 3: "same", 4: None, 5: "", 6: tricky, 7: "日本\r\n\r\n", 8: tricky + " ", 9: "x" * 200_000, 10: "same"}
    rows = [(i, f"http://WWW.b{i % 3}.example.com:80/p?q={i}#f", h, "c", 1) for i, h in html.items()]
    rows += [(11, None, "no url", "c", 1), (12, "http://a.com/\r\nX: y", "bad url", "c", 1), (None, "http://z.com", "same", "c", 1),
             (10, "http://again.com", "same", "c", 1)]
    got = _index(spark, rows).collect()
    assert len(got) == len(rows)
    top = {h: max(i for i, _, x, *_ in rows if i and (x or "") == h) for h in {x or "" for _, _, x, *_ in rows}}
    by_key = {(r.page_id, r.urlkey): r for r in got}
    for i, url, h, *_ in rows:
        r = by_key[i, op.url_key(url.replace("\r", "%0D").replace("\n", "%0A") if url else None)]
        body = (h or "").encode()
        last = i is None or top[h or ""] == i
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if last else ("revisit", top[h or ""]))


def test_least_payload_of_a_revisit(spark):
    got = _index(spark, [(1, "u", "abc", "c", 1), (2, "u", "abc", "c", 1), (3, "v", "", "c", 1), (4, "v", "", "c", 1)], min_bytes=1)
    assert {r.page_id: r.refers_to for r in got.collect()} == {1: 2, 2: None, 3: None, 4: None}


def test_global_order(spark):
    rows = [(i, f"http://h{i * 7 % 13}.com/{i % 5}", str(i), "c", 1) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, captured string, n int")
    path = new_path(spark, "test-archives")
    op.write_archives(op.captures(pages), path, archive_bytes=4000)
    got = op.merged_index(op.read_runs(spark, path), rows_per_task=9).collect()
    keys = [(r.urlkey, r.captured, r.page_id) for r in got]
    assert keys == sorted(keys) and len(keys) == 120 and len({r.run for r in got}) > 1


def test_damaged_archive_is_found():
    body = b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"
    with pytest.raises(ValueError, match="cut short"):
        list(op.records(gzip.compress(body)))


def test_empty(spark):
    assert _index(spark, []).collect() == []
