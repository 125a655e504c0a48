"""Operators that SQL cannot express, against brute force, a round trip or held-out rows."""

import gzip
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import html, langid, mixing, neardup, pii, toxicity, warc

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_documents(spark, documents):
    got = langid.identify(spark, documents).where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n


def test_toxicity_learns_word_beginnings_and_pairs(spark):
    rng = np.random.default_rng(1)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        words = list(rng.choice(plain, 60))
        toxic = i % 5 == 0
        if toxic:
            words[3:3] = [f"zorg{chr(97 + i % 20)}q", "vlem"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(spark, docs, known).where("held_out").collect()
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in got) and len(got) > 200


def test_toxicity_learns_pairs_of_balanced_words(spark):
    """Toxic is one of two words exactly with its partner: no word alone says anything."""
    rng = np.random.default_rng(4)
    plain = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}w" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        a, b = (i // 5) % 2, (i // 10) % 2
        words = [*rng.choice(plain, 4), ("qua", "qub")[a], ("zoa", "zob")[b]]
        rows.append((i, " ".join(rng.permutation(words))))
        labels.append((i, int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(spark, docs, known).where("held_out").collect()
    truth = dict(labels)
    assert len(got) > 600 and sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.95 * len(got)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns(documents):
    rng = np.random.default_rng(5)
    texts = [r["text"] for r in documents.where(F.col("text").rlike("[0-9@]")).collect()]
    texts += ["".join(rng.choice(list("124@a-+ .("), 40)) for _ in range(5000)]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_added_spans_leave_base_spans_and_plain_numbers_alone(spark, documents):
    field = pii.fit_field(documents)
    base, spans = pii.all_spans("call (555) 123-4567 or +1 (555) 123-4567 on 2024-01-15", field)
    assert [s for s in spans if s in base] == base and len(base) == 1
    assert (5, 3, 19) in spans
    for text in ("on 2024-01-15 we paid 1,234.56", "version 3.", "CC BY-NC 4.0.", "page 12-15"):
        assert pii.all_spans(text, field) == ([], [])


def test_a_long_list_of_numbers_is_found_like_one_alone(documents):
    field = pii.fit_field(documents)
    number = "(555) 123-4567"
    assert pii.all_spans(f"call {number}, or", field)[1] == [(5, 3, 19)]
    numbers = [f"(555) 123-{4000 + i}" for i in range(1000)]
    text = "call " + ", ".join(numbers) + ", or"
    assert pii.all_spans(text, field)[1] == [(5 + 16 * i, 3, 19 + 16 * i) for i in range(1000)]


def test_overlapping_base_spans_do_not_hide_the_rest_of_a_region(documents):
    text = "+378282246310005, (555) 123-4567"
    base, spans = pii.all_spans(text, pii.fit_field(documents))
    assert base == [(0, 3, 16), (1, 2, 16)] and spans == [*base, (18, 3, 32)]


def test_near_copies_in_large_groups_equal_brute_force(spark):
    """Copies of one text edited independently, a passage in many texts, and exact copies."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]
    base, passage = list(rng.choice(words, 120)), list(rng.choice(words, 55))
    rows = []
    for i in range(300):
        text = base.copy()
        for at in rng.integers(0, 120, rng.integers(0, 8)):
            text[at] = str(rng.choice(words[:4]))
        rows.append(" ".join(text))
    rows += [" ".join([*rng.choice(words, 40), *passage]) for _ in range(150)]
    rows += rows[:40] + ["a b c", "a b c", "a b"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = [frozenset(zip(*(t.split()[i:] for i in range(5)))) or frozenset([t]) for t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in neardup.link_documents(spark, docs).collect()}
    assert got == {i: (top(i), len(sets[i])) for i in range(len(rows))}


def test_mix_takes_what_it_aims_at(spark, documents):
    mixed = mixing.mix(spark, documents)
    by = mixed.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"),
        F.first("source_size").alias("size"), F.max("copies").alias("most"))
    rows = by.collect()
    assert all(r["most"] <= 2 and r["target"] <= 2 * r["size"] + 1e-6 for r in rows)
    assert sum(r["target"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["target"] for r in rows), rel=0.1)
    assert mixing.emit(mixed).count() == mixed.agg(F.sum("copies")).first()[0]


def archive(*records):
    out = b""
    for headers, block in records:
        lines = [b"WARC/1.0", *(f"{k}: {v}".encode() for k, v in headers.items()), f"Content-Length: {len(block)}".encode()]
        out += gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n")
    return out


def test_segments_of_foreign_archives(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nab\xff\r\nB;x=1\r\n0123456789a\r\n0\r\n\r\n"
    first = {"WARC-Type": "response", "WARC-Record-ID": "<a>", "WARC-Segment-Number": 1}
    last = {"WARC-Type": "continuation", "WARC-Record-ID": "<b>", "WARC-Segment-Number": 2,
            "WARC-Segment-Origin-ID": "<a>", "WARC-Segment-Total-Length": len(block)}
    (tmp_path / "one.warc.gz").write_bytes(archive((last, block[30:])))
    (tmp_path / "two.warc.gz").write_bytes(archive(
        ({"WARC-Type": "resource", "WARC-Record-ID": "<c>"}, b"WARC/1.0\r\n\r\nx"), (first, block[:30])))
    got = {r["record_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got["<a>"] == b"ab\xff0123456789a"
    last["WARC-Segment-Total-Length"] += 1
    (tmp_path / "one.warc.gz").write_bytes(archive((last, block[30:])))
    with pytest.raises(Exception, match="are not whole"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_main_text_of_drills_and_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract(spark, pages).collect()}
    right = 0
    rows = pages.collect()
    for r in rows:
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        marked = re.sub(r"</?(?:p|h1)>", "\x01", inner.replace("<br>", " "))
        blocks = [" ".join(html.entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in marked.split("\x01")]
        right += got[r["page_id"]] == "\n\n".join(b for b in blocks if b)
    assert right >= 0.99 * len(rows)


def test_no_kept_element_below_a_dropped_one():
    masks, rng = html._Masks(), np.random.default_rng(0)
    for _ in range(50):
        page = html.Page(html.drill(rng, ["some words to fill the page with text"]), masks)
        keep = html.decode(page, rng.normal(0, 3, len(page.tags)))
        assert all(keep[p] or not keep[e] for e, p in enumerate(page.parents) if e)


def test_attributes_are_read_whole_and_stray_quotes_alone():
    def blocks(attributes):
        page = html.Page(f'<div><img {attributes}><p class="a">one</p></div><article><p id=\'b\'>two</p>'
                         "<p>it's \"three\"</p></article>", html._Masks())
        return [text for _, text in page.blocks]

    want = blocks("")
    assert want == ["one", "two", "it's \"three\""]
    for quote in "\"'":
        for filling in ("A", "a>b <i> = "):
            assert blocks(f"src = {quote}{filling * (100_000 // len(filling))}{quote}") == want
    for stray in ("alt=don't", "it's", 'href=/?q="x', '"'):
        assert blocks(stray) == want
    never = html.Page("<p title=\"x>one</p><p>two</p>" + "<b a='>" + "<i a=" * 50_000, html._Masks())
    assert [text for _, text in never.blocks] == ["one", "two"]
