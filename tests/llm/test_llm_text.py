"""Encoding, token counts, language, language model, personal data against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from skymart.llm import bpe, kneser_ney, language_id, personal_data, token_counts
from skymart.llm.arrow import give_back, map_rows

ODD = string.printable + "éÉßΣσςİıàñ中文字😀́  \x1c\x85½²ⅷﬁǄ'"


def odd_texts(count: int) -> list[str]:
    draw = random.Random(1)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randrange(40))) for _ in range(count)]
    return [*texts, "it's WE'LL", "a<|endoftext|>b <|startoftext|>", "abcdefghij" * 300, "x" * 5000]


def test_bpe_equals_the_library():
    with open(path("word_bpe_49k.json"), encoding="utf-8") as file:
        own = bpe.WordBpe(file.read())
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for text in odd_texts(1500):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_bpe_queue_equals_scan(monkeypatch):
    with open(path("word_bpe_49k.json"), encoding="utf-8") as file:
        own = bpe.WordBpe(file.read())
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdent") for _ in range(draw.randrange(1, 60))) for _ in range(300)]
    scanned = [own.merge_word(w.encode()) for w in words]
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    assert [own.merge_word(w.encode()) for w in words] == scanned


def test_encode_and_decode_documents(corpus, no_docs):
    docs, rows = corpus
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    encoded = bpe.encode(docs, path("word_bpe_49k.json"), ["source"])
    found = encoded.collect()
    expected = Counter()
    for doc_id, text, source in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[doc_id, source, len(ids), tuple(ids)] += 1
    assert Counter((r.doc_id, r.source, r.n_tokens, tuple(r.ids)) for r in found) == expected
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for row in found:
        assert row.ids_sha256 == digest(" ".join(map(str, row.ids)))
        assert row.decoded_sha256 == digest(library.decode(row.ids, skip_special_tokens=False))
    decoded = Counter(r.text for r in bpe.decode(encoded, path("word_bpe_49k.json")).collect())
    assert decoded == Counter(library.decode(r.ids, skip_special_tokens=False) for r in found)
    assert bpe.encode_digests(no_docs, path("word_bpe_49k.json")).count() == 0


def test_counts_equal_the_library(corpus, no_docs):
    docs, rows = corpus
    pieces = token_counts.vocabulary(path("piece_bpe_32k.model"))
    escapes = [(f"<0x{b:02X}>", -1e9) for b in range(256)]
    library = Tokenizer(models.Unigram([("<unk>", -1e9), *escapes, *pieces], 0, True))
    counter = token_counts.Counter(pieces)

    def expected(text: str) -> int:
        return len(library.encode("▁" + text.replace(" ", "▁")).ids) if text else 0

    draw = random.Random(2)
    letters = string.ascii_letters + "   \n\té中文字😀ß"
    for _ in range(1000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        assert counter.text(text) == expected(text), text
    found = Counter((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs, path("piece_bpe_32k.model")).collect())
    assert found == Counter((i, expected(t or "")) for i, t, _ in rows)
    assert token_counts.token_counts(no_docs, path("piece_bpe_32k.model")).count() == 0


SENTENCES = {
    "aa": ["the house and the garden with a tree", "this is the way that they went"],
    "bb": ["das haus und der garten mit einem baum", "dies ist der weg den sie gingen"],
}


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(8)
    rows = []
    for i in range(200):
        lang = draw.choice(sorted(SENTENCES))
        words = " ".join(SENTENCES[lang]).split()
        rows.append((i, " ".join(draw.choice(words) for _ in range(30)), lang))
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "123 !?", None), (303, rows[0][1], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.withColumn("score", F.lit("x")), rows


def test_language_of_held_out_texts(labelled, no_docs):
    docs, rows = labelled
    held_out = language_id.remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs, ~held_out)
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert len(found) == len(rows)
    for doc_id, text, lang in rows:
        row = found[doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        else:
            assert row.lang_pred == (lang or rows[0][2]) and 0 < row.score <= 1 and not row.rejected
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.rejected}
    assert language_id.fit(no_docs, F.lit(True)) is None
    nothing = language_id.predict(docs, None)
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language_id.predict(no_docs, model).count() == 0


FINNISH = (
    "Suomen kieli kuuluu uralilaisten kielten ryhmään ja sitä puhuu noin viisi miljoonaa ihmistä. "
    "Talvella järvet jäätyvät ja lapset luistelevat, kesällä perheet matkustavat mökille uimaan. "
)
GREEK = "Η ελληνική γλώσσα είναι μία από τις παλαιότερες της Ευρώπης και μιλιέται από εκατομμύρια. "


def test_language_rejects_what_is_none(spark):
    """Gibberish and languages that were not learned go; clean texts of any length stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = language_id.remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs, ~held_out)
    draw = random.Random(6)
    letters = lambda n: "".join(draw.choice(string.ascii_lowercase) for _ in range(n))
    odd = [
        base64.b64encode(draw.randbytes(3000)).decode(), draw.randbytes(2000).hex(), letters(4000),
        " ".join(letters(draw.randrange(2, 10)) for _ in range(700)), FINNISH, GREEK, "x" * 5000,
        FINNISH * 20, base64.b64encode(draw.randbytes(90_000)).decode(), letters(150),
        base64.b64encode(draw.randbytes(90)).decode(),
    ]
    clean = [r.text for r in docs.filter(held_out & F.col("text").rlike(r"\p{L}")).collect()]
    long = [" ".join(t for t in clean[i::10]) for i in range(10)]
    cut = [t[:60] for t in clean if len(t) > 600]
    groups = {"odd": odd, "clean": clean, "long": long, "cut": cut}
    rows = [(i, t, g) for g, texts in groups.items() for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    accepted = language_id.accepted(frame, model).collect()
    kept = Counter(r.source for r in accepted)
    assert [r.text[:40] for r in accepted if r.source == "odd"] == []
    assert kept["long"] == len(long)
    assert kept["clean"] >= 0.98 * len(clean) and kept["cut"] >= 0.98 * len(cut)


def test_kneser_ney_equals_dictionaries(corpus, no_docs, monkeypatch):
    monkeypatch.setattr(kneser_ney, "COUNT_TOKENS", 300)
    monkeypatch.setattr(kneser_ney, "SCORE_TOKENS", 200)
    docs, rows = corpus
    model = kneser_ney.train(docs, F.col("doc_id") % 10 != 0)
    tokens = [[*(t or "").encode().lower().split(), b"end of text"] for _, t, _ in rows]
    words, pairs = Counter(), Counter()
    for (doc_id, *_), own in zip(rows, tokens, strict=True):
        if doc_id is not None and doc_id % 10:
            words.update(own)
            pairs.update(zip([b""] + own[:-1], own, strict=True))
    total, size, kinds = sum(words.values()), len(words), len(pairs)
    before = Counter(w for _, w in pairs)
    sizes = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    d, e = kneser_ney.discounts(*sizes(pairs)), kneser_ney.discounts(*sizes(before))
    rest = sum(e[min(v, 3) - 1] for v in before.values()) / kinds / (size + 1)
    context, saved = Counter(), Counter()
    for (u, _), c in pairs.items():
        context[u] += c
        saved[u] += d[min(c, 3) - 1]
    less = lambda c, by: c - by[min(c, 3) - 1] if c else 0
    expected = Counter()
    for (doc_id, *_), own in zip(rows, tokens, strict=True):
        score = 0.0
        for u, w in zip([b""] + own[:-1], own, strict=True):
            p = less(before[w], e) / kinds + rest
            if context[u]:
                p = less(pairs[u, w], d) / context[u] + saved[u] / context[u] * p
            score += math.log10(p)
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (size + 1))) for w in own)
        known = sum(w in words for w in own)
        expected[doc_id, len(own), known, total, round(base, 6), round(score, 6)] += 1
    found = Counter(
        (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in kneser_ney.score(docs, model).collect()
    )
    assert found == expected
    empty = kneser_ney.train(no_docs, F.lit(True))
    assert {r.score for r in kneser_ney.score(docs, empty).collect()} == {0.0}
    assert kneser_ney.score(no_docs, model).count() == 0


def test_kneser_ney_sums_of_no_keys():
    keys, sums = kneser_ney._summed(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert len(keys) == len(sums) == 0


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(p) <= 255 for p in m.split(".")),
    ),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(numbers(m)) <= 19 and luhn(numbers(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(numbers(m)) <= 15),
}


def numbers(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def test_personal_data_holds_the_rules(spark, no_docs):
    draw = random.Random(3)
    parts = ["a", "B", "é", ".", ".", "@", "-", "_", "+", " ", "(", ")", "1", "33", "255", "256",
             "4111111111111111", "+1 (462) 555-7216", "x@y.com", "10.0.0.1", "\n", "😀",
             "", "", "9.8.7"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(25)))) for i in range(1500)]
    rows += [(-1, None), (-2, ""), (-3, "1 " * 20_000), (-4, "a." * 20_000), (-5, "a" * 100_000)]
    rows += [rows[0], (-6, "pay 4111111111111111 4111111111111111 now"), (None, "x@y.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("c", F.lit(1))
    docs = docs.repartition(4)
    found = personal_data.digests(personal_data.find(docs, personal_data.fit(docs))).collect()
    texts = dict(rows)
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    for row in found:
        text = texts[row.doc_id] or ""
        base = [
            (kind, m.start(), m.end())
            for kind, (pattern, check) in RULES.items()
            for m in re.finditer(pattern, text)
            if check(m.group())
        ]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), text[:200]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == kind for k, *_ in base) for kind in RULES
        ]
        assert set(listed) <= set(filter(None, row.spans.split(",")))
    pair = next(r.spans for r in found if r.doc_id == -6)
    assert pair == "card:4:20,card:21:37"
    assert personal_data.fit(no_docs) is None
    assert personal_data.find(no_docs, None).count() == 0


def test_rare_kind_beside_a_hot_one(spark):
    """A few cards among many addresses are found as on a small table; so they are without decoys."""
    pair = "pay 4111111111111111 4111111111111111 now"
    text = " ".join(f"u{i}@x{i}.com" for i in range(30))
    hot = [(i, text) for i in range(1000)] + [(-1, pair), (-2, "a@b 10.0.0.999")]
    for rows in (hot, [(-1, pair)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = personal_data.find(docs, personal_data.fit(docs))
        spans = {r.doc_id: r.spans for r in personal_data.digests(found).collect()}
        assert spans[-1] == "card:4:20,card:21:37"


def test_thresholds_of_few_candidates():
    assert personal_data._threshold([]) == 0.0
    right = [(1.0, 1.0, 1.0)] * 50
    assert personal_data._threshold([*right, (-1.0, 0.0, 9.0)]) == 1.0
    assert personal_data._threshold([*right, (1.0, 0.0, 9.0)]) == float("inf")


def test_every_candidate_is_learned_from(spark, monkeypatch):
    """More addresses than a sample would hold: each is trained on or, every fourth, judged by."""
    rows = [(i, " ".join(f"u{j}@x{i}.com" for j in range(100)) + " a@b 10.0.0.999") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    judged, trained = [], []
    threshold, learner = personal_data._threshold, personal_data.GBTClassifier.fit
    monkeypatch.setattr(personal_data, "_threshold", lambda seen: judged.append(seen) or threshold(seen))
    monkeypatch.setattr(
        personal_data.GBTClassifier, "fit", lambda self, data: trained.append(data) or learner(self, data)
    )
    personal_data.fit(docs)
    places = [(i, 0, m.start(), m.end()) for i, text in rows for m in re.finditer(r"(?<!\S)\S+@\S+", text)]
    places += [(i, 1, m.start(), m.end()) for i, text in rows for m in re.finditer(r"10\.0\.0\.999", text)]
    spans = spark.createDataFrame(places, "doc_id long, kind int, start int, stop int")
    held = spans.filter(F.xxhash64(*spans.columns) % 4 == 0).groupBy("kind").count().collect()
    sums = {kind: sum(weight for *_, weight in seen) for kind, seen in enumerate(judged) if seen}
    assert sums == {r.kind: r["count"] for r in held}
    assert trained[0].agg(F.sum("times")).first()[0] == len(places) - sum(sums.values())


def test_numbers_inside_longer_runs(spark):
    """Every start and end of a group of digits is tried where a whole run fails its check."""
    cases = {
        "3782 822463 10005 3782 822463 10005": "card:0:17,card:18:35",
        "😀 3782-822463-10005 12345": "card:2:19",
        "tel +4930123456 20240115": "phone:4:15",
        "+33 1 23 45 67 89 20240115": "phone:0:17",
        "1234 5678 1234 5678 1234 5671": "",
    }
    rows = list(enumerate(cases))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for scorer in (personal_data.fit(docs), personal_data.fit(corpus)):
        found = personal_data.digests(personal_data.find(docs, scorer)).collect()
        assert {rows[r.doc_id][1]: r.spans for r in found} == cases


def test_time_grows_with_the_text(spark):
    """Texts of one long run of candidates: twice the text takes about twice the time at most."""
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scorer = personal_data.fit(corpus)

    def seconds(unit, times):
        docs = spark.createDataFrame([(1, unit * times)], "doc_id long, text string")
        begin = time.perf_counter()
        row = personal_data.digests(personal_data.find(docs, scorer)).first()
        return time.perf_counter() - begin, row

    least = min(seconds("x ", 10)[0] for _ in range(2))  # the plan alone
    for unit, found in (("1 ", 0), ("a.", 0), ("a@b.co ", 1), ("+1 ", 0), ("4111111111111111 ", 1)):
        short, row = seconds(unit, 10_000)
        assert len(list(filter(None, row.spans.split(",")))) == 10_000 * found
        long, row = seconds(unit, 20_000)
        assert long < 20 and long - least < max(4.0, 3 * (short - least)), unit
        assert len(list(filter(None, row.spans.split(",")))) == 20_000 * found


def test_overlapping_candidates_equal_a_plain_choice(spark):
    """Best first, each unless it overlaps one chosen before, over groups of overlapping candidates."""
    draw = random.Random(12)
    rows = []
    for row in range(40):
        own = {(draw.randrange(400), draw.choice([5, 13, 37, 150]), draw.randrange(4)) for _ in range(60)}
        rows.append((row, [(float(draw.randrange(3)), s, -(s + size), k, s + size) for s, size, k in sorted(own)]))
    frame = spark.createDataFrame(
        rows, "row long, c array<struct<rank:double,start:int,longest:int,kind:int,stop:int>>"
    )
    best = personal_data._best(F.col("c"), F.lit(0), F.lit(600)).alias("best")
    for row, found in frame.select("row", best).collect():
        kept: list = []
        for c in sorted(rows[row][1]):
            if all(c[4] <= k[1] or k[2] <= c[1] for k in kept):
                kept.append((c[3], c[1], c[4]))
        assert sorted(map(tuple, found)) == sorted(kept)


def test_encoding_leaves_no_words_in_its_workers(spark):
    """Workers are used again, and wait beside later stages with what they remember."""
    texts = [(i, " ".join(f"word{i}x{k}" for k in range(50))) for i in range(64)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    words = path("word_bpe_49k.json")
    assert bpe.encode(docs, words).filter("n_tokens > 0").count() == len(texts)
    vocabulary = spark.sparkContext.broadcast(bpe._vocabulary(words))

    def remembered(batches):
        for _ in batches:
            pass
        own = bpe._loaded(vocabulary.value, bpe.REMEMBERED_BESIDE_IDS)
        yield len(own.by_word) + len(own.by_chunk),

    assert map_rows(docs, remembered, "words long").agg({"words": "sum"}).first()[0] == 0


def test_free_memory_goes_back_to_the_system():
    def used() -> int:
        with open("/proc/self/smaps_rollup") as file:
            return sum(int(x.split()[1]) for x in file if x.startswith("Pss_Anon")) // 1024

    blocks = [np.ones(8000) for _ in range(4000)]  # 64 kB each, which the C library keeps
    blocks = blocks[1::100]
    before = used()
    give_back()
    assert used() < before - 150 and blocks[0].sum() == 8000
