"""NULLs in every column, empty and long texts, repeated rows, clashing columns, empty tables."""

import numpy as np
import pytest

from landfall.llm import chat, decontam, html, langid, mixing, neardup, pii, topk, toxicity, warc

LONG = "word " * 30_000 + "end"
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
    (4, "... 123 !!", None, "b"), (5, LONG, "en", "a"), (6, LONG, "en", "b"), (None, "no id here", "en", "a"),
    (7, "Der schnelle braune Fuchs springt", "de", None), (8, "The quick brown fox jumps over the lazy dog", "en", "b"),
    (8, "The quick brown fox jumps over the lazy dog", "en", "b"),
]
DOC_TYPE = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASH = ("node", "n", "v", "at", "term", "key", "size", "open", "words", "rate", "target", "known", "of", "w")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, DOC_TYPE)
    return df.select("*", *[df.text.alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps"), (2, None), (3, ""), (None, "lazy dog")],
                                 "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 0), (7, 1), (None, 1), (3, None)], "doc_id long, toxic int")


OPERATORS = {
    "toxicity": lambda s, d, i: toxicity.score(s, d, labels(s)),
    "pii": lambda s, d, i: pii.detect(s, d),
    "decontam": lambda s, d, i: decontam.decontaminate(s, d, i),
    "neardup": lambda s, d, i: neardup.link_documents(s, d),
    "langid": lambda s, d, i: langid.identify(s, d),
    "mixing": lambda s, d, i: mixing.mix(s, d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_document(spark, docs, items, name):
    rows = OPERATORS[name](spark, docs, items).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d[0]) for d in DOCS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, items, name):
    empty = spark.createDataFrame([], DOC_TYPE)
    assert OPERATORS[name](spark, empty, items.limit(0)).count() == 0


def test_near_duplicates_of_edges(spark, docs):
    got = {r["doc_id"]: r for r in neardup.link_documents(spark, docs).collect()}
    assert got[2]["n_shingles"] == got[3]["n_shingles"] == 0
    assert got[6]["component_id"] == 5 and not got[6]["kept"]
    assert got[8]["component_id"] == 1 and got[4]["component_id"] == 4
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_decontamination_of_edges(spark, docs, items):
    got = {r["doc_id"]: r for r in decontam.decontaminate(spark, docs, items).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"], got[1]["contaminated"]) == (9, 4, 1, True)
    assert (got[2]["n_words"], got[2]["n_hit"], got[2]["contaminated"]) == (0, 0, False)
    assert got[5]["n_words"] == 30_001 and got[5]["n_hit"] == 0


def test_language_of_edges(spark, docs):
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, docs).collect()}
    assert got[2] == got[3] == got[4] == "und" and got[1] != "und"


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, 0), (2, "u", "", 0), (3, None, "<article><p>A&amp;B  c</p></article>", 0),
         (None, "u", "x" * 200_000, 0), (4, "u", "<article><p>A&amp;B  c</p></article>", 0), (4, "u", "<p>", 0),
         (4, "u", "<p>", 0)], "page_id long, url string, html string, payload int")
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"])
                 for r in warc.round_trip(spark, pages).collect())
    assert got == sorted([
        ("1", 0, "revisit", 2), ("2", 0, "response", None), ("3", 36, "revisit", 4), ("4", 36, "response", None),
        ("4", 3, "response", None), ("4", 3, "response", None), ("None", 200_000, "response", None)])
    assert html.extract(spark, pages, drills=40).count() == 7
    assert html.extract(spark, pages.limit(0), drills=10).count() == 0
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_vectors(spark):
    nan = float("nan")
    rows = [(20, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [nan, 1.0], 1), (3, None, 1), (4, [], 1),
            (5, [1.0, None], 1), (40, [0.0, 0.0], 1), (6, [3.0], 1), (None, [9.0, 9.0], 1), (7, [-1.0, -2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in topk.top_k(spark, df, "vec_id % 20 = 0").orderBy("query_id", "rank").collect()]
    best = 64 * 64 * 5
    assert got == [(20, 1, 1, best), (20, 2, 1, best), (20, 3, 40, 0), (20, 4, 7, -best),
                   (40, 1, 1, 0), (40, 2, 1, 0), (40, 3, 7, 0), (40, 4, 20, 0)]
    assert topk.top_k(spark, df.limit(0), "vec_id % 20 = 0").count() == 0


def test_pruned_search_equals_all_products():
    rng = np.random.default_rng(3)
    data = (rng.normal(0, 30, (900, 12)) * rng.lognormal(0, 1, (900, 1))).astype(np.int64)
    norms = np.sqrt((data.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-norms)
    points = {"ids": order, "data": data[order], "norms": norms[order]}
    queries = {"ids": np.arange(900, 960), "data": (rng.normal(0, 20, (60, 12))).astype(np.int64)}
    queries["norms"] = np.sqrt((queries["data"].astype(float) ** 2).sum(axis=1))
    every = queries["data"] @ points["data"].T
    for share in (0.2, 0.9):
        least = np.quantile(every, 1 - share * 0.02, axis=1)
        least[::7] = (0.97 * queries["norms"] * norms.max())[::7]
        i, j, scores = topk.search_block(queries, points, least, 20)
        for q in range(60):
            want = sorted(every[q][every[q] >= least[q]], reverse=True)[:20]
            assert sorted(scores[i == q], reverse=True) == want


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b\\<|im_end|>", 0), (1, 1, "user", None, 0), (None, None, None, None, 0),
            (1, 1, "a\nb", "[INST]<s>", 0), (1, 2, "assistant", "b\\<|im_end|>", 0), (2, 0, "user", "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    made = chat.format_conversations(df)
    for r in made.collect():
        turns = chat.read_chatml(r["formatted"])
        want = sorted(((t, ro or "", x or "") for c, t, ro, x, _ in rows if c == r["conv_id"]),
                      key=lambda t: (t[0] is not None, t))
        assert turns == [(ro, x) for _, ro, x in want] and not r["rewrites"]
        for s, (_, text) in zip(r["spans"], turns):
            assert chat.unescape(r["formatted"][s["text_start"]:s["text_end"]]) == text
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_templates_that_rewrite_history_are_found():
    def latest_thought(turns):
        return "".join(f"<{r}>{t if i + 1 == len(turns) else t[:3]}" for i, (r, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "long thought"), ("user", "and?"), ("assistant", "x")]
    assert chat.locate(latest_thought, turns)[2] == [2, 3]
    output, spans, rewrites = chat.locate(chat.inst, turns)
    assert not rewrites and [output[a:b] for _, _, a, b in spans] == [t for _, t in turns]
