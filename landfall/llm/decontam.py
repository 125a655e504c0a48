"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

The index holds postings (term, doc_id, position) for the terms that can open a match: of every
benchmark window the two terms that are rarest in the documents. A window is found by taking the
list of its rarest term, shifting it to where the window would start, intersecting it with the
shifted list of the second, and comparing the words of what is left. Proximity matches let every
word stand a few places off; they come from the list of the rarest term alone.

Lists name texts, not rows: a text is known by its md5, so copies of a text, and rows without
doc_id, are looked at once.
"""

from pyspark.sql import functions as F

from landfall.llm.common import sized, stored

WINDOW = 13
SHARE = 20
_GONE = "gone text print"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words: all of ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """Words of a text with A-Z lower-cased; NULL gives none. Other letters keep their case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    # Splitting at what is no word gives the same words as matching them, in an eighth of the time.
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN), ""), F.array().cast("array<string>"))


def item_windows(items, width=WINDOW):
    """(item_id, key, words): the windows of every item; a shorter item with words is one window."""
    words = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - width, F.lit(0))
    return words.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(F.col("w"), i + 1, F.lit(width)))).alias("words")
    ).select("item_id", F.md5(F.concat_ws(" ", "words")).alias("key"), "words")


def term_counts(docs, terms):
    """How often each of ``terms`` (term) occurs in all documents."""
    tokens = docs.select(F.explode(words_of(F.col("text"))).alias("token"))
    return tokens.join(terms, F.col("token") == F.col("term")).groupBy("term").agg(F.count("*").alias("n"))


def text_print(text):
    """What a text is known by; NULL reads as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def postings(docs, terms):
    """(term, print, at): every position of ``terms`` (term) in every different text, from 0."""
    tokens = docs.select(text_print(F.col("text")).alias("print"),
                         F.posexplode(words_of(F.col("text"))).alias("at", "token"))
    return tokens.join(terms, F.col("token") == F.col("term")).select("term", "print", "at").distinct()


def _term_bytes():
    return F.octet_length("term") + 48


def build_index(spark, docs, windows):
    """(plans, index): the two rarest terms of every window, and the postings of these terms.

    ``plans`` has key, size, t1, o1, t2, o2, where o is the term's offset in the window and t2 is
    NULL for windows of one word. Windows with a term that no document has are left out.
    """
    distinct = stored(spark, windows.groupBy("key").agg(F.first("words").alias("words")), "windows")
    exploded = distinct.select("key", F.posexplode("words").alias("offset", "term"))
    terms = stored(spark, exploded.select("term").distinct(), "terms")
    counts = stored(spark, term_counts(docs, sized(terms, _term_bytes())), "counts")
    ranked = exploded.join(counts, "term", "left").groupBy("key").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"), F.count("*").alias("size"),
        F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("r")).where("least > 0")
    second = F.when(F.size("r") > 1, F.element_at("r", 2))
    plans = stored(spark, ranked.withColumn("second", second).select(
        "key", F.col("size").cast("int").alias("size"),
        F.element_at("r", 1)["term"].alias("t1"), F.element_at("r", 1)["offset"].alias("o1"),
        F.col("second.term").alias("t2"), F.col("second.offset").alias("o2")), "plans")
    wanted = stored(spark, plans.select(F.explode(F.array("t1", "t2")).alias("term")).where(
        "term is not null").distinct(), "wanted")
    return plans, stored(spark, postings(docs, sized(wanted, _term_bytes())), "postings")


def _small_plans(plans):
    return sized(plans, F.octet_length("t1") + F.coalesce(F.octet_length("t2"), F.lit(0)) + 160)


def candidates(plans, index):
    """(print, key, size, start): places where the two rarest terms of a window agree."""
    opened = index.join(_small_plans(plans), F.col("term") == F.col("t1")).select(
        "print", "key", "size", (F.col("at") - F.col("o1")).alias("start"), "t2", "o2")
    alone = opened.where("t2 is null and start >= 0").select("print", "key", "size", "start")
    other = index.select(F.col("print").alias("p2"), F.col("term").alias("term2"), F.col("at").alias("at2"))
    met = opened.where("t2 is not null and start >= 0").join(
        other, (F.col("print") == F.col("p2")) & (F.col("t2") == F.col("term2"))
        & (F.col("start") + F.col("o2") == F.col("at2")))
    return alone.union(met.select("print", "key", "size", "start"))


def proximity_matches(spark, docs, items, slop, width=WINDOW):
    """(doc_id, item_id, start): places where all words of a window stand within ``slop`` of their own.

    A document matches an item's window of k words at ``start`` (0 to its words less k) if each word i of
    the window occurs in the document less than ``slop`` + 1 places from start + i. Exact phrases are
    among the matches. Of equal windows of an item one row is given for a place. NULL texts have
    no words; NULL item_ids form no item; repeated rows give their matches again.
    """
    docs, items = docs.select("doc_id", "text"), items.where("item_id is not null")
    windows = stored(spark, item_windows(items, width), "item-windows")
    plans, index = build_index(spark, docs, windows)
    words = stored(spark, windows.groupBy("key").agg(F.first("words").alias("words")), "window-words")
    at = F.col("at") - F.col("o1")
    places = index.join(_small_plans(plans), F.col("term") == F.col("t1")).select(
        "print", "key", F.explode(F.sequence(at - slop, at + slop)).alias("start")).where("start >= 0")
    places = places.groupBy("print", "key").agg(F.collect_set("start").alias("starts")).join(
        sized(words, F.aggregate("words", F.lit(64), lambda n, w: n + F.octet_length(w) + 24)), "key")
    places = stored(spark, places.groupBy("print").agg(
        F.collect_list(F.struct("key", "words", "starts")).alias("open")).withColumnRenamed("print", "of"), "places")
    room = F.aggregate("open", F.lit(96).cast("long"), lambda n, o: n + 64 + 8 * F.size(o["starts"]) + F.aggregate(
        o["words"], F.lit(0).cast("long"), lambda m, w: m + F.octet_length(w) + 24))
    rows = docs.withColumn("print", text_print(F.col("text"))).join(sized(places, room), F.col("print") == F.col("of"))

    def near(w, start, word, i):
        low = F.greatest(start + i - slop, F.lit(0))
        return F.array_contains(F.slice(w, low + 1, start + i + slop - low + 1), word)

    def stands(w, words, start):
        numbers = F.sequence(F.lit(0), F.size(words) - 1)
        return (start + F.size(words) <= F.size(w)) & F.forall(numbers, lambda i: near(w, start, F.get(words, i), i))

    # The words are a lambda's argument, so that a text is split once and not anew for every place.
    found = F.transform(F.array(words_of(F.col("text"))), lambda w: F.transform("open", lambda o: F.struct(
        o["key"].alias("key"), F.filter(o["starts"], lambda start: stands(w, o["words"], start)).alias("starts"))))
    found = stored(spark, rows.select("doc_id", F.explode(F.filter(
        F.get(found, 0), lambda o: F.size(o["starts"]) > 0)).alias("o")).select("doc_id", "o.*"), "found")
    owned = stored(spark, windows.select("item_id", F.col("key").alias("owned")).distinct(), "owned")
    return found.join(sized(owned, 64), F.col("key") == F.col("owned")).select(
        "doc_id", "item_id", F.explode("starts").alias("start"))


def exact_matches(spark, docs, items, width=WINDOW):
    """Every row of ``docs`` with its words counted and its exact matches, and the windows.

    Returns (rows, windows). rows: doc_id, print (of the text), n_words, hits
    (array of start, size, key); windows: item_id, key.
    """
    windows = stored(spark, item_windows(items, width), "item-windows")
    plans, index = build_index(spark, docs, windows)
    found = stored(spark, candidates(plans, index).distinct(), "candidates")
    by_text = found.groupBy("print").agg(
        F.collect_list(F.struct("start", "size", "key")).alias("open")).withColumnRenamed("print", "of")
    by_text = stored(spark, by_text, "by-text")
    rows = docs.withColumn("print", text_print(F.col("text"))).join(
        sized(by_text, 72 * F.size("open") + 96), F.col("print") == F.col("of"), "left")
    rows = rows.select("doc_id", "print", words_of(F.col("text")).alias("w"), "open")
    same = F.filter(F.coalesce("open", F.array()), lambda c: F.md5(F.concat_ws(
        " ", F.slice(F.col("w"), c["start"] + 1, c["size"]))) == c["key"])
    return stored(spark, rows.select(
        "doc_id", "print", F.size("w").cast("long").alias("n_words"), same.alias("hits")), "hits"), windows


def clean_documents(spark, docs, items):
    """The rows of ``docs`` whose text is not contaminated (see ``decontaminate``), whatever their doc_id."""
    gone = _judged(spark, docs.select(F.lit(None).cast("long").alias("doc_id"), "text"),
                   items.select("item_id", "text"), WINDOW, SHARE)
    gone = stored(spark, gone.where("contaminated").select(F.col("print").alias(_GONE)).distinct(), "contaminated")
    return docs.join(sized(gone, 64), text_print(F.col("text")) == F.col(_GONE), "left_anti")


def decontaminate(spark, docs, items, width=WINDOW, share=SHARE):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    A word inside an occurrence of a window is hit; a document is contaminated if any word is
    and 1 in ``share`` at least. NULL texts have no words. Repeated rows are judged one by one
    with the same result; NULL item_ids form no item and NULL doc_ids are documents like others.
    Without items, or documents, nothing is hit. Other columns play no part.
    """
    return _judged(spark, docs.select("doc_id", "text"), items.select("item_id", "text"), width, share).drop("print")


def _judged(spark, docs, items, width, share):
    rows, windows = exact_matches(spark, docs, items.where("item_id is not null"), width)
    covered = F.array_distinct(F.flatten(F.transform(
        F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"], h["size"]))),
        lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))
    counted = rows.select(
        "doc_id", "print", "n_words", F.size(covered).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda h: h["key"])).alias("keys"))
    owned = stored(spark, windows.select("item_id", F.col("key").alias("owned")).distinct(), "owned")
    named = (
        counted.where("n_hit > 0").select(F.col("print").alias("p"), "keys").distinct()
        .select("p", F.explode("keys").alias("k"))
        .join(sized(owned, 64), F.col("k") == F.col("owned"))
        .groupBy("p").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    named = stored(spark, named, "named")
    out = counted.join(sized(named, 24 * F.size("ids") + 96), F.col("print") == F.col("p"), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "print", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
