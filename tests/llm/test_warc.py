import base64
import hashlib
import random

from ledgerlake.llm import warc

PAGES = "page_id bigint, url string, html string, refers_to string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], PAGES)


def rows():
    rng = random.Random(2)
    out = [(i, f"https://www.h{i % 7}.example.com/p/{i % 40}?q={i}", f"<p>{'é' * (i % 9)}{i % 60}</p>") for i in range(300)]
    out += [(400, None, None), (401, "", ""), (402, "http://[bad", None), (403, "a b\r\nc: d\t", "x" * 300_000), (403, "a b\r\nc: d\t", "x" * 300_000)]
    out += [(None, "http://no.id/", "<p>0</p>"), (None, None, "lonely"), (404, "http://x.org:8080/a#frag", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rng.shuffle(out)
    return out


def wanted(given):
    least = {}
    for page_id, _, html in given:
        if page_id is not None:
            least[html or ""] = min(page_id, least.get(html or "", page_id))
    out = []
    for page_id, _, html in given:
        data = (html or "").encode()
        first = least.get(html or "")
        again = page_id is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    given = rows()
    index = warc.archive(pages(spark, given).repartition(5), spark)
    assert sorted([tuple(r) for r in warc.resolved(index).collect()], key=str) == wanted(given)


def test_lookup(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    given = [(i, f"http://site.org/{i % 30}", f"page {i}") for i in range(200)]
    index = warc.archive(pages(spark, given).repartition(4), spark)
    asked = spark.createDataFrame([("http://SITE.org/3",), ("https://www.site.org/29#x",), ("http://site.org/none",)], "url string")
    found = {}
    for r in warc.lookup(index, asked).collect():
        found.setdefault(r.asked_url, []).append(r.page_id)
    assert {k: sorted(v) for k, v in found.items()} == {
        "http://SITE.org/3": [i for i in range(200) if i % 30 == 3],
        "https://www.site.org/29#x": [i for i in range(200) if i % 30 == 29],
    }
    one = spark.createDataFrame([("http://site.org/3", 33), ("http://site.org/3", 34)], "url string, page_id bigint")
    assert [r.page_id for r in warc.lookup(index, one, id_col="page_id").collect()] == [33]


def test_smaller_payloads_are_no_revisits(spark):
    given = [(1, "u", "same"), (2, "u", "same"), (3, "u", "longer text"), (4, "u", "longer text")]
    found = warc.resolved(warc.archive(pages(spark, given), spark, min_bytes=5)).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in found} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3),
    }


def test_member_is_a_warc_record():
    member = warc.record(5, "http://a/", b"body", warc.digest(b"body"), None, None)
    fields, payload = warc.parse(member)
    assert payload == b"body" and fields["WARC-Type"] == "response" and fields["WARC-Target-URI"] == "http://a/"
    fields, payload = warc.parse(warc.record(6, "http://b/", b"body", warc.digest(b"body"), 5, "http://a/"))
    assert payload == b"" and fields["WARC-Refers-To-Target-URI"] == "http://a/"


def test_keys():
    assert warc.url_key("https://www.Example.com:443/A/b?c=1#d") == "com,example)/A/b?c=1"
    assert warc.url_key("http://u:p@x.y.org:8080") == "org,y,x:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("a b") == "a%20b"


def test_no_rows(spark):
    assert warc.resolved(warc.archive(pages(spark, []), spark)).count() == 0


def test_revisits_of_urls_with_blanks(spark):
    """The response's url has blanks or line ends around it or inside; its revisits still find the payload's size."""
    urls = [" http://a.org/x", "http://a.org/x\n", "http://a.org/a\tb", "http://a.org/a\r\nb c", "\x00http://a.org/z", "　http://a.org/\x7f", "http://a b.org/", "\thttp://[bad ", "x y\n"]
    given = [(10 * k + j, url if j == 0 else f"http://b.org/{j}", f"payload {k}") for k, url in enumerate(urls) for j in range(3)]
    index = warc.archive(pages(spark, given).repartition(3), spark)
    assert sorted([tuple(r) for r in warc.resolved(index).collect()], key=str) == wanted(given)
    asked = spark.createDataFrame([(url, 10 * k) for k, url in enumerate(urls)], "url string, page_id bigint")
    assert sorted(r.page_id for r in warc.lookup(index, asked, id_col="page_id").collect()) == [10 * k for k in range(len(urls))]


def test_reading_is_spread(spark):
    """Rows that stand for members are small; the tasks that read them follow the members, not the rows."""
    given = [(i, f"http://h{i % 50}.org/{i}", f"page {i}" * 20) for i in range(400)]
    index = warc.archive(pages(spark, given).repartition(4), spark)
    found = warc.read_records(index)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    totals = index.parts.selectExpr("sum(records)", "sum(bytes)").first()
    assert totals[0] == 400 and totals[1] == warc.captures(index).selectExpr("sum(length)").first()[0]


def test_parts_grow_beyond_their_number(spark, monkeypatch):
    """An index that would have more parts than may be sent has longer ones instead, and still finds every record."""
    for name, value in {"BLOCK_LINES": 2, "PART_LINES": 2, "MAX_PARTS": 9}.items():
        monkeypatch.setattr(warc, name, value)
    given = [(i, f"http://site.org/{i % 100}", f"page {i}") for i in range(300)]
    index = warc.archive(pages(spark, given).repartition(4), spark)
    assert 1 < index.parts.count() <= 9
    asked = spark.createDataFrame([(f"http://site.org/{i}",) for i in (0, 50, 99)], "url string")
    assert sorted(r.page_id for r in warc.lookup(index, asked).collect()) == sorted(i for i in range(300) if i % 100 in (0, 50, 99))
