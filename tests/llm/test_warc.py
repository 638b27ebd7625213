"""Archives and capture index against the pages themselves."""

import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cardsentry.llm import catalog, warc


def expected(pages):
    newest = defaultdict(lambda: -(2**63))
    for page, _, html in pages:
        if page is not None:
            newest[html or ""] = max(newest[html or ""], page)
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = newest.get(html or "")
        same = top is None or top == page
        out.append((page, len(payload), digest, "response" if same else "revisit", None if same else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    got = catalog.QUERIES["op9_warc"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == expected([tuple(r) for r in pages])


def test_odd_rows_in_small_blocks(spark, tmp_path):
    pages = [(i, f"http://h{i % 3}.example.org/p/{i % 7}?q=A b\t{i}", f"<p>é {i % 11}</p>\r\n\r\n") for i in range(300)]
    pages += [(5000, None, None), (5001, "", ""), (5002, "not a url\n", "x" * 300_000), (-4, "http://[bad", "neg")]
    pages += [(None, "http://a.example", "only here"), (None, "http://a.example", "<p>é 3</p>\r\n\r\n"), (7, "http://b", "twice id")]
    pages += [(2**60, "http://big", "big")] * 3
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit(1)).repartition(4)
    captures = warc.write_archives(df, str(tmp_path / "a"))
    directory = warc.write_index(captures, str(tmp_path / "i"), block_lines=10)
    assert directory.count() >= len(pages) // 10
    got = warc.look_up(captures.select("key", "page_id"), directory, str(tmp_path / "i"), str(tmp_path / "a")).collect()
    assert sorted(map(tuple, got), key=str) == expected(pages)
    few = captures.where("page_id IN (3, 17)").select("key", "page_id")
    absent = spark.createDataFrame([("zz)/", 3), ("a)/", None)], "key string, page_id long")
    some = warc.look_up(few.union(absent), directory, str(tmp_path / "i"), str(tmp_path / "a")).collect()
    assert sorted(r.page_id for r in some) == [3, 17]
    # any reader of archives can read them from end to end
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "a").iterdir())
    assert whole.count(b"WARC/1.1\r\n") == len(pages)
    assert warc.round_trip(spark, df.limit(0)).collect() == []


@pytest.mark.parametrize("ranges", [1, 8, 211])
@pytest.mark.parametrize("block_lines", [3, 1_000])
def test_more_and_fewer_ranges_than_blocks(spark, tmp_path, ranges, block_lines):
    pages = [(i, f"http://h{i % 5}.example.org/{i % 9}", f"<p>{i % 13}</p>") for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    captures = warc.write_archives(df, str(tmp_path / "a"))
    directory = warc.write_index(captures, str(tmp_path / "i"), block_lines)
    keys = captures.select("key", "page_id")
    got = warc.look_up(keys, directory, str(tmp_path / "i"), str(tmp_path / "a"), ranges).collect()
    assert sorted(map(tuple, got), key=str) == expected(pages)


def test_url_keys_sort_hosts_together():
    assert warc.url_key("https://www.Example.org:8080/A/b?C=d") == "org,example,www:8080)/a/b?c=d"
    assert warc.url_key("http://example.org") == "org,example)/"
    assert warc.url_key(None) == "-"
    assert " " not in warc.url_key("http://example.org/a b\n")
