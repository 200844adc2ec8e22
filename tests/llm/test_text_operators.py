"""BPE, token counts, line dedup, decontamination, language ID: brute force, libraries and edge cases."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import bpe, decontamination, lang_id, line_dedup, queries, token_counts
from plumbline.llm.tables import id_text

EDGES = [
    None,
    "",
    " ",
    "\n\t  ",
    "a",
    "  two  blanks   and▁sign ",
    "It's WE'LL they'd 've 12345 %%% a<|endoftext|>b <|startoftext|>",
    "ÀÉ İstanbul ΣΑΣ ß é   ｆｕｌｌ 　 \x00 \x1c x",
    "日本語 текст 🙂🙂 ‍ " * 3,
    "long" * 5000 + " " + "z" * 3000,
    "same row",
    "same row",
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i if i % 5 else None, t, "x", 1.5) for i, t in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, __host double")


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("false")


def texts(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def word_file():
    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def test_bpe_is_the_library(spark, data, edges, word_file):
    library = Tokenizer.from_str(word_file)
    docs = id_text(texts(spark, data)).union(id_text(edges).select("doc_id", F.col("text")))
    rows = bpe.encode(docs, word_file).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_keeps_columns_and_decodes(edges, empty, word_file):
    out = bpe.encode(edges, word_file)
    assert out.columns == [*edges.columns, "ids", "decoded"]
    again = bpe.decode(out.drop("decoded"), word_file)
    assert sorted(r.decoded for r in out.collect()) == sorted(r.decoded for r in again.collect())
    assert bpe.encode(empty, word_file).count() == 0
    assert bpe.encode(edges.where("text is null"), word_file).first().decoded == ""


def test_pair_index_merges_in_rank_order(word_file):
    coder = bpe.WordBpe(word_file)
    library = Tokenizer.from_str(word_file)
    words = ["aaaaaaa", "banana", "ababab", "thththth", "é", "xyzzyxyzzy", "in" * 40]
    assert coder.encode_words(words) == [library.encode(w, add_special_tokens=False).ids for w in words]
    assert coder.encode_words([]) == []


def test_new_words_are_encoded_in_bounded_blocks(word_file, monkeypatch):
    """The index over all new words of a piece at once took a worker's memory."""
    coder, sizes = bpe.WordBpe(word_file), []
    real = coder.encode_words
    monkeypatch.setattr(coder, "encode_words", lambda words: sizes.append(sum(len(w.encode()) for w in words)) or real(words))
    words = {f"näw{i:x}" for i in range(60_000)} | {"ß" * 200_000}
    coder.learn(words)
    assert sorted(sizes)[-1] == 400_000 and sorted(sizes)[-2] <= 1 << 16  # a longer word is a block of its own
    whole = real(sorted(words))
    assert [np.frombuffer(coder.known[w], "<u4").tolist() for w in sorted(words)] == whole


def test_bpe_cache_is_bounded(word_file, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    coder = bpe.WordBpe(word_file)
    for block in (["one", "two", "three"], ["four", "five", "six"], ["one", "six"]):
        coder.learn(set(block))
        assert set(block) <= set(coder.known)
    assert len(coder.known) <= 5 + 3 and len(coder.older) <= 5 + 3


def test_frequent_words_outlive_a_full_cache(word_file, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 8)
    coder, encoded = bpe.WordBpe(word_file), Counter()
    real = coder.encode_words
    monkeypatch.setattr(coder, "encode_words", lambda words: encoded.update(words) or real(words))
    for i in range(20):
        coder.learn({"often", *(f"word{chr(97 + i)}{chr(97 + k)}" for k in range(4))})
    assert encoded["often"] == 1 and max(encoded.values()) == 1


def test_all_code_points_are_split_as_the_library_does(word_file):
    """Characters newer than the library's Unicode version included."""
    library, coder = Tokenizer.from_str(word_file), bpe.WordBpe(word_file)
    assert bpe.ranges([1, 2, 3, 9]) == "\\U00000001-\\U00000003\\U00000009-\\U00000009"
    for start in range(0, 0x110000, 128):
        if 0xD800 <= start < 0xE000:
            continue
        text = "".join(f"a{chr(c)}b1{chr(c)}{chr(c)} " for c in range(start, start + 128))
        words = coder.words(text)
        coder.learn(set(words))
        ids = np.frombuffer(b"".join([coder.known[w] for w in words]), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_decoding_reads_the_ids(word_file):
    library, coder = Tokenizer.from_str(word_file), bpe.WordBpe(word_file)
    ids = [320, 49407, 7, 0, 1000]
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert coder.decode([320, 10**6]) == coder.decode([320]) and coder.decode([]) == ""


def test_counts_are_the_library(spark, data, edges):
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = texts(spark, data).select("doc_id", "text").union(edges.select("doc_id", "text"))
    for limit in (1, 5000):  # next to nothing frequent, or nearly all
        rows = token_counts.with_token_counts(docs, model, limit=limit).collect()
        assert len(rows) == docs.count()
        assert all(r.n_tokens == len(library.encode(r.text or "")) for r in rows)


def test_counts_of_no_rows_and_of_misses(spark, empty, monkeypatch):
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    assert token_counts.with_token_counts(empty, model).count() == 0
    monkeypatch.setattr(token_counts, "CACHE", 2)
    table = token_counts.Lengths(model, ["the", ""])
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ("the cat sat on the mat", " ", "  x", "the  ", "a\nb c\td"):
        assert table.count(t) == len(library.encode(t))
    assert len(table) <= 4


def lines_by_hand(rows, ratio, min_pages):
    pages, total = defaultdict(Counter), Counter()
    for host, text in rows:
        total[host] += 1
        pages[host].update({x.strip(" ") for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in rows:
        if text is None:
            out.append((host, None, 0, 0))
            continue
        kept = [x for x in text.split("\n") if not (x.strip(" ") and pages[host][x.strip(" ")] >= min_pages and pages[host][x.strip(" ")] > ratio * total[host])]
        out.append((host, "\n".join(kept), len(text.split("\n")), len(text.split("\n")) - len(kept)))
    return out


def test_line_dedup_by_hand(spark):
    rows = [("a", f"head\n own {i}\n\n  foot  ") for i in range(10)] + [("a", "foot\nfoot"), ("a", None), ("a", ""), ("b", "head\nfoot"), (None, "head"), (None, "head"), (None, "head\nx")]
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "source string, text string, __keys int, __bad string")
    out = line_dedup.drop_boilerplate(df, ratio=0.5, n_lines="n", n_dropped="d")
    assert out.columns == [*df.columns, "n", "d"]
    got = [(r.source, r.text, r.n, r.d) for r in out.orderBy("__keys").collect()]
    assert got == lines_by_hand(rows, 0.5, 3)
    assert got[0][1] == " own 0\n"  # a blank line stays


def test_line_dedup_of_nothing_and_by_join(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x\ny", i) for i in range(4)], "source string, text string, k int")
    assert line_dedup.drop_boilerplate(df.where("false")).count() == 0
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert {r.text for r in line_dedup.drop_boilerplate(df).collect()} == {""}
    plan = line_dedup.drop_boilerplate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def hits_by_hand(text, items, window=13):
    own = decontamination.words(text)
    hit, found = set(), set()
    for item_id, item in items:
        theirs = decontamination.words(item)
        n = min(window, len(theirs))
        for i in range(len(theirs) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == theirs[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item_id))
    return len(own), sorted(hit), sorted(found)


BENCHMARK = [(1, " ".join(f"w{i}" for i in range(20))), (10, "Short one"), (9, "short, ONE"), (2, None), (3, ""), (4, "..."), (None, "no id here")]
CASES = [
    None,
    "",
    "nothing",
    " ".join(f"W{i}" for i in range(3, 18)) + " and more",
    "short one; short-one no id here",
    " ".join(f"w{i}" for i in range(20)) + " x" * 500,
    "ähnlich wörter SHORT\x00one",
]


@pytest.mark.parametrize("set_bytes", [decontamination.SET_BYTES, 40])
def test_contamination_by_hand(spark, set_bytes):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(CASES + CASES)], "doc_id long, text string, n_words int")
    items = spark.createDataFrame(BENCHMARK + BENCHMARK[:1], "item_id long, text string")
    out, (n, hit, found) = decontamination.contamination(docs, items, set_bytes=set_bytes)
    rows = out.orderBy("doc_id").collect()
    ided = [(i, t) for i, t in BENCHMARK if i is not None]
    for r, text in zip(rows, CASES + CASES):
        want = hits_by_hand(text, BENCHMARK)
        assert (r[n], list(r[hit])) == want[:2]
        assert list(r[found]) == hits_by_hand(text, ided)[2]
        assert r["n_words"] == 7
    kept = {r.doc_id for r in decontamination.drop_contaminated(docs, items).collect()}
    assert kept == {i for i, t in enumerate(CASES + CASES) if not (h := hits_by_hand(t, BENCHMARK))[1] or 20 * len(h[1]) < h[0]}


def test_hit_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "Say: short one, please!"), (2, None), (3, "wholly clean")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "short one")], "item_id long, text string")
    assert [r.text for r in decontamination.drop_hit_spans(docs, items).orderBy("doc_id").collect()] == ["Say:  , please!", None, "wholly clean"]
    assert decontamination.contamination(docs.where("false"), items)[0].count() == 0
    assert decontamination.drop_contaminated(docs, items.where("false")).count() == 3


def phrases_by_hand(text, sample, block):
    """A symbol that does not go on a phrase begins the next one; one the sample lacks only ends it."""
    n = 0
    for start in range(0, len(text), block):
        n, phrase = n + 1, ()
        for c in text[start : start + block]:
            if (*phrase, c) in sample:
                phrase = (*phrase, c)
            else:
                n, phrase = n + 1, ((c,) if (c,) in sample else ())
    return n


def test_cross_parsing_by_hand(monkeypatch):
    monkeypatch.setattr(lang_id, "BLOCK", 7)
    samples = {"b": ["abracadabra", "cab"], "a": ["hocus pocus"]}
    parser = lang_id.CrossParser(samples)
    text = parser.symbols.of("Abra cadabra hocus zz! cab")
    for language, counted in zip(parser.languages, parser.phrases([text])):
        learned = [x for t in sorted(samples[language], key=len) for x in [*parser.symbols.of(t).tolist(), 0]]
        substrings = {tuple(learned[i:j]) for i in range(len(learned)) for j in range(i + 1, min(len(learned), i + 8) + 1)}
        assert counted[0] == phrases_by_hand(text.tolist(), substrings, 7)
    assert parser.predict(["cadabra", "pocus", None, "", "123 !?", "日本"])[0] == ["b", "a", "und", "und", "und", "a"]


def test_letters_of_all_scripts_count(spark):
    rng = random.Random(4)
    samples = {"latin": ["".join(map(chr, [*range(97, 123), *range(0x3B1, 0x3C0), *range(0x430, 0x450)])) * 20]}
    texts = {}
    for language, first in (("p", 0x4E00), ("q", 0x5E00), ("r", 0xAC00)):
        words = ["".join(chr(first + rng.randrange(400)) for _ in range(3)) for _ in range(200)]
        samples[language] = [" ".join(words)]
        texts[language] = " ".join(rng.sample(words, 50))
    parser = lang_id.CrossParser(samples)
    assert parser.predict(list(texts.values()))[0] == list(texts)
    text = parser.symbols.of(texts["q"])
    learned = [*parser.symbols.of(samples["q"][0]).tolist(), 0]
    substrings = {tuple(learned[i:j]) for i in range(len(learned)) for j in range(i + 1, min(len(learned), i + 210) + 1)}
    assert parser.phrases([text])[parser.languages.index("q")][0] == phrases_by_hand(text.tolist(), substrings, lang_id.BLOCK)
    rows = [("z", "a" * 50 + "b" * 50, 1)]
    assert [len(t) for t in lang_id.labelled_sample(spark.createDataFrame(rows, "lang string, text string, k int"), chars=30)["z"]] == [30]


def test_language_held_out(spark, data):
    rows = queries.op2_language(spark, data).collect()
    truth = {r.doc_id: r.lang for r in texts(spark, data).collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 40
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_without_labels(spark, edges, empty):
    parser = lang_id.fit(edges.withColumn("lang", F.lit(None).cast("string")))
    out = lang_id.with_language(edges, parser)
    assert {(r.lang_pred, r.score) for r in out.collect()} == {("und", 0.0)}
    assert lang_id.with_language(empty, parser).count() == 0


def test_digests_of_the_queries(spark, data, word_file):
    library = Tokenizer.from_str(word_file)
    docs = {r.doc_id: r.text for r in texts(spark, data).collect()}
    for r in queries.op1_bpe(spark, data).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language_sample_is_cut_before_it_is_collected(spark):
    rows = [("en" if i % 3 else "de", f"{i} " + "word und text " * (i * 37 % 400)) for i in range(600)] + [(None, "x"), ("fr", None), ("fr", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    whole = {lang: {t for k, t in rows if k == lang} for lang in ("en", "de")}
    for chars, total in ((500, 1 << 19), (10**9, 700), (3000, 1 << 19)):
        sample = lang_id.labelled_sample(df, 32, chars, total)
        assert set(sample) == {"en", "de"}
        room = min(chars, total // 2)
        for lang, pieces in sample.items():
            assert 8 < len(pieces) <= 32 and sum(map(len, pieces)) <= room + 32
            assert all(any(p in t for t in whole[lang]) for p in pieces)
        assert sample == lang_id.labelled_sample(df.repartition(5), 32, chars, total)


def test_bpe_finds_unassigned_characters_quickly(word_file):
    """A text that is not ASCII is looked through by one look-up a character, on every plane as Python's tables say."""
    import time
    import unicodedata

    coder = bpe.WordBpe(word_file)
    for i in [*range(0x300, 0x600), *range(0xFFF0, 0x10200), *range(0x1F600, 0x1F800), *range(0x2FFF0, 0x30010), 0x10FFFF]:
        assert coder._has_unassigned("é" + chr(i)) == (unicodedata.category(chr(i)) == "Cn")
    start = time.process_time()
    assert not coder.unassigned.search("été à la maison 中文 " * 250_000)
    assert time.process_time() - start < 0.4
