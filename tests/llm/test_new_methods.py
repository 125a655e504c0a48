"""Divergence, packing and alignment against plain versions, with edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from landfall.llm import alignment, divergence, packing, tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOC_TYPE = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASH = ("term", "n", "docs", "row", "a", "b", "part", "length", "ids", "rank", "block", "value", "item", "total")
ODD = [
    None, "", " ", "  two  spaces ", "Größe ², ½ and ³ ⅷ", "日本語のテキスト。 한국어", "emoji 🙂🙂 x", "a\tb\n\n c\r\n",
    "<|endoftext|> and <s> </s> <0x41>", "x" * 30_000, "don't we'll I'VE", "\x00\x1c\x1d nul", "é ﬁ ｆｕｌｌ", "▁mark ▁",
    "The quick brown fox", "The quick brown fox", "word " * 3000,
]


def clashing(spark, rows):
    df = spark.createDataFrame(rows, DOC_TYPE)
    return df.select("*", *[df.text.alias(c) for c in CLASH])


# --- divergence ------------------------------------------------------------

def plain_audit(rows, least=10, most=10):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
            for _, text, lang, source in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(lang, source, [t.translate(lower) for t in terms]) for lang, source, terms in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = set()
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted({s for a, s, _ in rows if a == lang}, key=str.encode)

        def shares(source):
            total = sum(counts[lang, source][t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[lang, source][t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        by, whole = {s: shares(s) for s in sources}, shares(None)
        for s in sources:
            pairs = [(-sum(gap(by[s][t], by[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-gap(by[s][t], whole[t]), t.encode()) for t in kept
                     if counts[lang, s][t] and by[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                out |= {(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)}
    return out


def divergence_rows():
    rng = np.random.default_rng(8)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["Éa", "éa", "日本"]
    rows = []
    for i in range(700):
        source = f"s{min(int(rng.geometric(0.15)), 12)}"
        text = " ".join(rng.choice(words[int(rng.integers(0, 60)):], int(rng.integers(0, 25)))).title()
        rows.append((i, text, ("en", "de", None)[i % 3], None if source == "s3" else source))
    rows += [(None, None, None, "lonely"), (1, "", "fr", "only"), (2, "1 2 3", "xx", "a"), (3, None, "xx", "b"),
             (4, "rare words here", "xx", None)] + [(5, "Same same", "de", "s1")] * 12
    return rows


def test_divergence_equals_plain_counts(spark):
    rows = divergence_rows()
    got = divergence.audit(spark, clashing(spark, rows)).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == plain_audit(rows)


def test_divergence_in_many_cells(spark, monkeypatch):
    """Blocks of few sources and shards of few terms give the same sums."""
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 7)
    monkeypatch.setattr(divergence, "HELD_ROWS", 50)
    rows = divergence_rows()
    assert set(map(tuple, divergence.audit(spark, clashing(spark, rows)).collect())) == plain_audit(rows)


def test_shares_are_exact_beyond_64_bits(spark):
    n = np.array([0, 7, 8 * 10 ** 11, 10 ** 13 - 2])
    total = 10 ** 13 + 10 ** 6
    want = [1 + 10 ** 9 * (int(k) + 2) // total for k in n]
    assert divergence._shares(n, np.int64(total)).tolist() == want
    df = spark.createDataFrame([(int(k), total - 10 ** 6, 5 * 10 ** 5) for k in n], "n long, total long, terms long")
    assert [r[0] for r in df.select(divergence.share("n", "total", "terms")).collect()] == want


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(spark, spark.createDataFrame([], DOC_TYPE)).count() == 0


# --- tokens ----------------------------------------------------------------

@pytest.mark.parametrize("specials", [False, True])
def test_words_put_together_equal_whole_texts(specials):
    whole, own = Tokenizer.from_file(BPE), tokens.ByteBpe(BPE, specials)
    whole.encode_special_tokens = not specials
    rng = np.random.default_rng(6)
    texts = [t for t in ODD if t]
    texts += ["".join(map(chr, rng.choice([*range(1, 0x600), *range(0x2000, 0x2100)], 60))) for _ in range(400)]
    texts += ["".join(rng.choice(list(" 'stvdlmre²½_\n\t1a.é"), 50)) for _ in range(1000)]
    for text in texts:
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


# --- packing ---------------------------------------------------------------

def held(lengths, combinations, capacity):
    counts = np.zeros(len(lengths), int)
    for column, n in combinations:
        assert sum(lengths[i] * k for i, k in column) <= capacity and n > 0
        for i, k in column:
            counts[i] += k * n
    return counts


def test_plans_hold_every_piece_and_are_short():
    rng = np.random.default_rng(9)
    cases = [rng.integers(1, 2049, 40), np.array([2048] * 50), np.array([5]), rng.integers(690, 720, 500),
             np.concatenate([packing.cut(int(n)) for n in rng.lognormal(6, 1.2, 4000) + 1])]
    for pieces in cases:
        lengths, counts = np.unique(pieces, return_counts=True)
        combinations, bound = packing.plan(lengths, counts)
        assert held(lengths, combinations, 2048).tolist() == counts.tolist()
        n = sum(uses for _, uses in combinations)
        fit = sum(uses for _, uses in packing._best_fit(lengths, counts, 2048))
        assert bound - 1e-6 <= n <= fit * 1.002 + 1
    assert n <= -(-pieces.sum() // 2048) * 1.001 + 1  # many short pieces leave next to no room
    assert packing.plan([], [])[0] == []


def test_bounds_are_below_the_best_packing():
    """All packings of small cases, by trying every combination."""
    def fewest(left, lengths, capacity, columns, memo):
        if not any(left):
            return 0
        if left not in memo:
            memo[left] = 1 + min(fewest(tuple(max(0, a - b) for a, b in zip(left, c)), lengths, capacity, columns, memo)
                                 for c in columns if any(min(a, b) for a, b in zip(left, c)))
        return memo[left]

    rng = np.random.default_rng(10)
    for _ in range(25):
        lengths = np.sort(rng.choice(np.arange(2, 20), 4, replace=False))
        counts = rng.integers(1, 5, 4)
        columns = {tuple(c.count(i) for i in range(4)) for k in range(1, 11)
                   for c in combinations_with_replacement(range(4), k) if sum(lengths[i] for i in c) <= 20}
        best = fewest(tuple(counts.tolist()), lengths, 20, columns, {})
        combinations, bound = packing.plan(lengths, counts, 20)
        assert held(lengths, combinations, 20).tolist() == counts.tolist()
        assert bound <= best + 1e-6 and best <= sum(n for _, n in combinations) <= best + 1


def test_the_price_of_a_room_is_the_best_filling():
    rng = np.random.default_rng(12)
    lengths, values = np.array([3, 5, 7, 11]), rng.random(4)
    best = packing._Pricing(lengths, values, 30).best
    for room in range(31):
        found = [sum(values[i] for i in c) for k in range(11) for c in combinations_with_replacement(range(4), k)
                 if sum(lengths[i] for i in c) <= room]
        assert best[room] == pytest.approx(max(found))


def test_packed_documents(spark):
    rows = [(i % 9 or None, t, "en", "s") for i, t in enumerate(ODD)]
    packed = packing.pack(spark, clashing(spark, rows).repartition(3), BPE)
    got = packed.collect()
    whole = Tokenizer.from_file(BPE)
    want = Counter()
    for doc, text, _, _ in rows:
        ids, at = [*whole.encode(text or "", add_special_tokens=False).ids, 0], 0
        first = len(ids) % 2048 or 2048
        for i, end in enumerate(range(first, len(ids) + 1, 2048)):
            want[doc, i, at, tuple(ids[at:end])] += 1
            at = end
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in got) == want
    assert all(r["length"] == len(r["ids"]) for r in got)
    made = defaultdict(list)
    for r in got:
        made[r["sequence_id"]].append((r["offset"], r["ids"]))
    for parts in made.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += len(ids)
        assert at <= 2048
    joined = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert joined == {s: [i for _, ids in sorted(parts) for i in ids] for s, parts in made.items()}
    crc = Counter(r["ids_crc32"] for r in packing.pack(
        spark, clashing(spark, rows).repartition(3), BPE, checksums=True).collect())
    assert crc == Counter(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    assert packing.pack(spark, spark.createDataFrame([], DOC_TYPE), BPE).count() == 0


# --- alignment -------------------------------------------------------------

def plain_alignment(texts):
    """Per text: (n_a, n_b, group text, links) by walking all bytes; None without tokens."""
    one, two = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    one.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(tokens.byte_letters())}
    names = {i: bytes(letters[c] for c in t) for t, i in one.get_vocab().items() if all(c in letters for c in t)}

    def piece(i):
        text = two.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if two.is_byte(i) else text.replace("▁", " ").encode()

    out = []
    for text in texts:
        a = one.encode(f" {text or ''}", add_special_tokens=False).ids
        b = two.encode(text or "")
        bytes_a, bytes_b = [names[i] for i in a], [piece(i) for i in b]
        if not text or b"".join(bytes_a) != f" {text}".encode() or b"".join(bytes_b) != f" {text}".encode():
            out.append(None)
            continue
        owner_a = [k for k, t in enumerate(bytes_a) for _ in t]
        owner_b = [k for k, t in enumerate(bytes_b) for _ in t]
        pairs = sorted(set(zip(owner_a, owner_b)))
        groups, left, right, old = [], [], [], (-1, -1)
        for at, pair in enumerate(zip(owner_a, owner_b)):
            if pair[0] != old[0]:
                left.append(str(a[pair[0]]))
            if pair[1] != old[1]:
                right.append(str(b[pair[1]]))
            old = pair
            last = at + 1 == len(owner_a)
            if last or (owner_a[at + 1] != pair[0] and owner_b[at + 1] != pair[1]):
                groups.append(",".join(left) + "|" + ",".join(right))
                left, right = [], []
        out.append((len(a), len(b), groups, [(a[i], b[j]) for i, j in pairs]))
    return out


def plain_agreement(texts):
    found = plain_alignment(texts)
    counts = Counter(p for f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return Counter(
        (f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]),
         hashlib.sha256(";".join(f[2]).encode()).hexdigest()) if f else (0, 0, 0, 0, 0, 0, "") for f in found)


def test_alignment_equals_a_walk_over_all_bytes(spark):
    rng = np.random.default_rng(13)
    texts = ODD + ["".join(map(chr, rng.choice([*range(32, 0x250), 0x1F642, 0x4E2D], 40))) for _ in range(120)]
    texts += [" ".join(rng.choice(["unbelievable", "tokenisers", "Straße", "1234567", "--", "naïve"], 30)) for _ in range(60)]
    df = clashing(spark, [(i % 5 or None, t, "en", "s") for i, t in enumerate(texts)]).repartition(3)
    got = alignment.agreement(spark, df, BPE, PIECES).drop("doc_id").collect()
    assert Counter(map(tuple, got)) == plain_agreement(texts)


def test_alignment_when_the_pairs_exceed_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(alignment, "sized", lambda df, row_bytes: df)
    texts = ["The quick brown fox, and again the fox"] * 40 + [f"word {i} of many, and" for i in range(60)]
    df = clashing(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = alignment.agreement(spark, df, BPE, PIECES).drop("doc_id").collect()
    assert Counter(map(tuple, got)) == plain_agreement(texts)


def test_alignment_of_an_empty_table(spark):
    assert alignment.agreement(spark, spark.createDataFrame([], DOC_TYPE), BPE, PIECES).count() == 0
