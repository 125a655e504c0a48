"""Inputs that once ended or stalled a job, and plain versions of what chooses among many."""

import itertools
import math
import time
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm import chat, decontam, html, langid, mixing, pii, toxicity
from tests.llm.test_methods import plain_spans

SF = "/root/testdata/sf0.001"


def seconds(work):
    """The faster of two runs, so that a busy machine does not count."""
    times = []
    for _ in range(2):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return min(times)


# --- personal data ---------------------------------------------------------

def some_field():
    rng = np.random.default_rng(21)
    names = ["digits=3", "digits=10", "shape=<3>", "groups=2", "first=<", "first=(", "dialled", "marks=-", "luhn",
             "octets", "letters", "cuts a word", "marks=.", "groups=3"]
    weights = {(k, f): float(rng.normal(0, 1)) for k in pii.KINDS for f in names}
    return pii.SegmentField(weights | {(pii.OTHER, "part"): 0.2})


def test_numbers_of_all_scripts_are_text():
    field = some_field()
    odd = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) in ("Nd", "No", "Nl")]
    assert len(odd) > 1000
    for c in odd:
        text = f"host 1.2.3.4{c}{c} and 1.2.3{c}.4 +1 (55{c}) 123-4567 4111 1111 1111 1111{c} a{c}@b.c{c}"
        base, spans = pii.all_spans(text, field)
        assert base == plain_spans(text) and set(base) <= set(spans)


def test_personal_data_of_long_tokens_in_linear_time():
    field = some_field()
    for text in ("詞" * 1_000_000 + " 1", "x" * 1_000_000 + "1", "x1" * 500_000, "é" * 1_000_000 + "@"):
        assert seconds(lambda: pii.all_spans(text, field)) < 5


def test_decoding_equals_trying_every_segmentation():
    field, rng = some_field(), np.random.default_rng(22)
    for _ in range(150):
        text = "".join(rng.choice(["12", "555", "-", "(", ")", " ", "a", ".", "@", "4567"], int(rng.integers(1, 9))))
        for low, high in pii.regions(text):
            cut = pii._parts(text, low, high)
            able = {}
            for i, j in pii._lattice(text, cut):
                scores = field._scores(pii.segment_features(text, cut[i][0], cut[j - 1][1], low, high))
                able[i, j] = max(scores)

            def best(i):
                if i == len(cut):
                    return 0.0
                found = [0.2 + best(i + 1)]
                return max(found + [s + best(b) for (a, b), s in able.items() if a == i])

            got = field.decode(text, low, high)
            starts, ends = {s: k for k, (s, _) in enumerate(cut)}, {e: k + 1 for k, (_, e) in enumerate(cut)}
            total, covered = 0.0, 0
            for s, kind, e in got:
                total += field._scores(pii.segment_features(text, s, e, low, high))[kind]
                covered += ends[e] - starts[s]
            assert total + 0.2 * (len(cut) - covered) == pytest.approx(best(0))


# --- pages -----------------------------------------------------------------

def blocks(source):
    return [text for _, text in html.Page(source, html._Masks()).blocks]


def test_attributes_of_pages_are_no_marks():
    for mark in ("data-keep=", "data-keep=1", "data-keep", "data-keep='0'"):
        assert blocks(f"<div {mark}><p {mark}>one</p></div>") == ["one"]


def test_a_slash_does_not_close_a_script():
    assert blocks("<article><p>a</p><script src=/x/>var a=1;</script><style/>p{}</style><p>b</p></article>") == ["a", "b"]


def test_unclosed_elements_do_not_swallow_the_page():
    for tag in ("select", "svg", "noscript", "template"):
        assert blocks(f"<p>a</p><{tag}><p>b</p>")[-1] == "b"
        assert blocks(f"<p>a</p><{tag}>x</{tag}><p>b</p>") == ["a", "b"]
    assert blocks("<p>a</p><svg/><p>b</p><script>c<p>d") == ["a", "b"]


def test_implied_ends():
    page = html.Page("<ul><li>a<li>b<ul><li>c</ul>d</ul><p>e<p>f<div>g</p>h</div><table><tr><td>i<td>j<tr><td>k</table>",
                     html._Masks())
    depth = [(text, page.depths[e], page.tags[e]) for e, text in page.blocks]
    assert depth == [("a", 2, "li"), ("b", 2, "li"), ("c", 4, "li"), ("d", 2, "li"), ("e", 1, "p"), ("f", 1, "p"),
                     ("g", 1, "div"), ("h", 1, "div"), ("i", 3, "td"), ("j", 3, "td"), ("k", 3, "td")]


def test_pages_of_open_elements_in_linear_time():
    for source in ("<h1>" * 50_000, "<li>" * 50_000, "<ul><li>" * 25_000, "<select>" * 50_000, "<div>" * 50_000,
                   "<li><ul>" + "<h1>" * 25_000 + "<li>x" * 25_000, "<p>" * 50_000 + "</div>" * 50_000,
                   "x" * 1_000_000):
        def work():
            page = html.Page(source, html._Masks())
            html.decode(page, html.features(page)[:, 0])

        assert seconds(work) < 5


def test_kept_elements_equal_trying_every_labelling():
    rng, masks = np.random.default_rng(23), html._Masks()
    for _ in range(60):
        source = "".join(rng.choice(["<div>", "</div>", "<p>x</p>", "<ul>", "</ul>", "<li>y"], 9))
        page = html.Page(source, masks)
        n = len(page.tags)
        if n > 11:
            continue
        z = rng.normal(0, 2, n)

        def value(keep):
            return sum(-np.logaddexp(0, -z[e]) if keep[e] else -np.logaddexp(0, z[e]) for e in range(n))

        able = [(True, *k) for k in itertools.product((True, False), repeat=n - 1)]
        able = [k for k in able if all(k[page.parents[e]] or not k[e] for e in range(1, n))]
        assert value(html.decode(page, z)) == pytest.approx(max(map(value, able)))


# --- conversations ---------------------------------------------------------

def test_steps_equal_prefixes():
    turns = [("user" if i % 2 == 0 else "assistant", f"text <s> \\ {i}\n") for i in range(60)]
    for template in chat.TEMPLATES.values():
        for n in (0, 1, 2, 7, 60):
            assert chat.locate_by_steps(template, turns[:n]) == chat.locate(template.render, turns[:n])


def test_steps_that_disagree_are_not_believed(spark):
    def thoughts(turns):  # rewrites all but the last turn
        return "".join(f"<{r}>{t if i + 1 == len(turns) else t[:2]}" for i, (r, t) in enumerate(turns))

    wrong = chat.Template(thoughts, lambda state, turn: (f"<{turn[0]}>{turn[1]}", state))
    turns = [("user", "hello"), ("assistant", "thought"), ("user", "and")]
    assert chat.locate_by_steps(wrong, turns) is None
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn int, role string, text string")
    row = chat.format_conversations(df, wrong).first()
    assert row["formatted"] == thoughts(turns) and row["rewrites"] == [1, 2]


def test_every_prefix_is_rendered(spark):
    def render(turns):  # rewrites history at three turns only, where no step is ever compared
        return "".join(f"<{r.upper() if len(turns) == 3 else r}>{t}" for r, t in turns)

    template = chat.Template(render, lambda state, turn: (f"<{turn[0]}>{turn[1]}", state))
    df = spark.range(5).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "'x' AS text")
    row = chat.format_conversations(df, template).first()
    assert row["rewrites"] == [2, 3]


def test_a_resumed_template_depends_on_its_turns_alone():
    rng = np.random.default_rng(27)
    calls = [[("user", "a"), ("assistant", "b")][:n] + [("user", t)] * n for n in (0, 1, 2) for t in ("</s>", "\\", "")]
    for name, plain in (("chatml", chat.chatml), ("inst", chat.inst)):
        for i in rng.integers(0, len(calls), 60):
            turns = calls[i]
            assert chat.TEMPLATES[name].render(turns) == plain(turns)


def test_a_long_conversation_in_linear_time(spark):
    template = chat.TEMPLATES["chatml"]
    turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(20_000)]
    assert seconds(lambda: chat.locate_by_steps(template, turns)) < 5
    df = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                        "concat('turn ', id) AS text")
    row = chat.read_back(chat.format_conversations(df)).first()
    assert row["n_turns"] == 20_000 and row["loss_chars"] == sum(len(t) for r, t in turns if r == "assistant")


# --- toxicity --------------------------------------------------------------

def test_scores_add_up_all_pairs():
    rng = np.random.default_rng(24)
    machine = toxicity.FactorizationMachine(50)
    machine.bias, machine.weights = 0.3, rng.normal(0, 1, 50)
    machine.factors = rng.normal(0, 1, (50, toxicity.FACTORS))
    arrays = [np.sort(rng.choice(50, n, replace=False)) for n in (0, 1, 2, 9, 30)]
    want = [0.3 + sum(machine.weights[a] for a in x)
            + sum(float(machine.factors[a] @ machine.factors[b]) for a, b in itertools.combinations(x, 2)) for x in arrays]
    assert machine.raw(arrays)[0] == pytest.approx(want)


@pytest.mark.parametrize("filling", [20, 60])
def test_pairs_are_learned_among_many_words(spark, filling):
    rng = np.random.default_rng(4)
    plain = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}wx" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        a, b = (i // 5) % 2, (i // 10) % 2
        words = [*rng.choice(plain, filling), ("quant", "quaro")[a], ("zorba", "zeppo")[b]]
        rows.append((i, " ".join(rng.permutation(words))))
        labels.append((i, int(a == b)))
    truth = dict(labels)
    got = toxicity.score(spark, spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    assert len(got) > 600 and sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.95 * len(got)


# --- languages -------------------------------------------------------------

def many_languages(n):
    rng = np.random.default_rng(25)
    rows = []
    for i in range(n):
        letters = [chr(0x430 + (i * 7 + k) % 32) + chr(97 + (i * 5 + 3 * k) % 26) for k in range(4)]
        rows += [(len(rows) + k, " ".join("".join(rng.choice(letters, 4)) for _ in range(12)), f"l{i:03}") for k in range(8)]
    return rows + [(10 ** 6, None, "l000"), (10 ** 6 + 1, "123 !", "l001"), (None, "ab cd", None)]


def test_any_number_of_languages_equals_plain_naive_bayes(spark, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 20)
    monkeypatch.setattr(langid, "BLOCKS_AT_ONCE", 2)
    rows = many_languages(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumn("score", F.lit(1)).withColumn("best", F.lit(1)).withColumn("c0", F.lit("x"))
    held = {r["doc_id"]: r["h"] for r in docs.select(
        "doc_id", (F.coalesce(langid.remainder("doc_id", 4), F.lit(0)) == 2).alias("h")).collect()}

    def grams(text):
        code = np.frombuffer((text.lower() + "\0\0").encode("utf-32-le"), np.uint32)
        return Counter(np.concatenate(langid._grams(langid._letters(code))[1:]).tolist())

    counts, sizes = {}, Counter()
    for doc, text, lang in rows:
        if text is not None and lang is not None and not held[doc]:
            counts.setdefault(lang, Counter()).update(grams(text))
            sizes[lang] += 1
    n_buckets, total = 1 << langid.BUCKET_BITS, sum(sizes.values())
    got = {r["doc_id"]: r for r in langid.identify(spark, docs).collect()}
    assert len(got) == len(rows)
    for doc, text, _ in rows:
        if not text or not any(map(str.isalpha, text)):
            assert (got[doc]["lang_pred"], got[doc]["score"]) == ("und", 0.0)
            continue
        seen = grams(text)
        sums = {}
        for lang, c in counts.items():
            every = sum(c.values()) + 0.5 * n_buckets
            sums[lang] = math.log(sizes[lang] / total) + sum(n * math.log((c[g] + 0.5) / every) for g, n in seen.items())
        best = max(sums.values())
        scale = math.sqrt(sum(seen.values()))
        assert sums[got[doc]["lang_pred"]] == pytest.approx(best, abs=0.02)
        assert got[doc]["score"] == pytest.approx(1 / sum(math.exp((s - best) / scale) for s in sums.values()), rel=1e-2)


def test_language_stage_without_labels_keeps_lettered_texts(spark):
    rows = [(1, "some words", None, 5), (2, "12 !", None, 5), (3, None, None, 5), (4, "", None, 5), (5, "é", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lettered int")
    docs = docs.withColumn("lang_pred", F.lit("a")).withColumn("score", F.lit(2))
    got = corpus_pipeline.language_id(spark, docs, SF)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 5]
    und = spark.createDataFrame([(i, "wort und wort", "und", 0) for i in range(9)], rows and "doc_id long, text string, lang string, n int")
    assert corpus_pipeline.language_id(spark, und, SF).count() == 9


# --- rows that doc_id does not tell apart ----------------------------------

@pytest.mark.parametrize("ids", ["all", "none", "one", "equal rows"])
def test_every_row_draws_by_itself(spark, ids):
    def doc_id(i):
        return {"all": i, "none": None, "one": 7, "equal rows": None}[ids]

    rows = [(doc_id(i), "ten words of text that say very little here " + ("" if ids == "equal rows" else str(i)),
             ("a", "b", "c")[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for keep in (("doc_id", "source"), None):
        by = mixing.mix(spark, docs.repartition(5), keep=keep).groupBy("source").agg(
            F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"),
            F.count("*").alias("n")).collect()
        assert [r["n"] for r in by] == [1000] * 3
        assert all(abs(r["taken"] - r["target"]) <= 0.05 * r["target"] for r in by)


def test_one_row_of_a_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = text.replace("w39", "x")
    rows = [(5, text, "a"), (5, text, "b"), (None, text, "c"), (None, near, "d"), (9, near, "e"), (4, "other words", "f"),
            (None, "a b", "g"), (None, "c d", "h"), (4, None, "i"), (4, None, "j"), (6, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = corpus_pipeline.near_dedup(spark, docs.withColumn("gone", F.lit(1)), SF)
    left = sorted(r["row"] for r in got.collect())
    assert left in (["a", *"fghijk"], ["b", *"fghijk"])
    empty = docs.limit(0)
    assert corpus_pipeline.near_dedup(spark, empty, SF).count() == 0


def test_contaminated_texts_go_whatever_their_id(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"so {item} so", "a"), (None, "clean words", "b"), (3, f"so {item} so", "c"), (3, "clean", "d"),
            (3, None, "e"), (None, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string").withColumn("print", F.lit(1))
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r["gone"] for r in got.collect()) == ["b", "d", "e", "f"]


def test_stages_of_an_empty_table_and_further_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("term", F.lit("x")).withColumn("n", F.lit(1))
    for rows in (docs.limit(0), docs.limit(40)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            n = out.count()
            assert n == 0 if not rows.take(1) else n > 0, name
            assert out.columns[:len(docs.columns)] == docs.columns


# --- proximity -------------------------------------------------------------

def test_proximity_equals_trying_every_place(spark):
    rng = np.random.default_rng(26)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 7))))) for i in range(12)] + [(None, "w1"), (99, None), (98, "")]
    docs = [(i % 7 or None, " ".join(rng.choice(words, int(rng.integers(0, 25))))) for i in range(40)] + [(3, None)]
    for width, slop in ((4, 0), (4, 1), (13, 2)):
        want = Counter()
        for doc, text in docs:
            w = (text or "").split()
            for item, phrase in items:
                p = (phrase or "").split()
                if item is None or not p:
                    continue
                size = min(width, len(p))
                for window in {tuple(p[i:i + size]) for i in range(len(p) - size + 1)}:
                    for start in range(len(w) - size + 1):
                        if all(word in w[max(0, start + i - slop):start + i + slop + 1] for i, word in enumerate(window)):
                            want[doc, item, start] += 1
        got = decontam.proximity_matches(
            spark, spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"), slop, width)
        assert Counter(map(tuple, got.collect())) == want


def test_a_long_text_with_many_places_is_split_once(spark):
    text = " ".join(f"other{i} rare{'' if i % 10 else ' next'}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, "rare next")], "item_id long, text string")
    runs = []
    assert seconds(lambda: runs.append(decontam.proximity_matches(spark, docs, items, 0).collect())) < 40
    assert len(runs[0]) == 2 * 2_000 and len(set(runs[0])) == 2_000
