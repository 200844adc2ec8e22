"""Cross-tokenizer alignment, vector codes, quality classifier: brute force, libraries and edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import alignment, quality, queries, vector_codes
from plumbline.llm.bpe import byte_signs

RNG = random.Random(11)


# alignment


@pytest.fixture(scope="module")
def sides():
    a = alignment.ByteTokens(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"))
    return a, alignment.PieceTokens(Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def aligned_by_hand(texts, libraries):
    """[(n_a, n_b, groups, links)] of each text, links as a list of id pairs."""
    coder, pieces = libraries
    signs, names = {s: b for b, s in enumerate(byte_signs())}, {i: t for t, i in coder.get_vocab().items()}
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, [], []))
            continue
        a, b = coder.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        a_bytes = [bytes(signs[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [pieces.id_to_piece(i)]]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            out.append((0, 0, [], []))
            continue
        spans = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip(ids, [0, *ends[:-1]], ends)))
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [[[i for i, s, e in side if low <= s and e <= high] for side in spans] for low, high in zip([0, *cuts], cuts)]
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if max(s, u) < min(e, v)]
        out.append((len(a), len(b), groups, links))
    return out


def sums_by_hand(found):
    counts = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    return [(sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)) for *_, links in found]


def group_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


TEXTS = [
    None, "", " ", "   ", "a", "Hello, world!", "naïve café — ﬁne", "tabs\tand\r\nlines\n\n", "日本語のテキスト、漢字", "👩‍👩‍👧 emoji🙂", "▁sign▁", "x ▁", "\0null\x01",
    "<|endoftext|> <s></s> <unk> <0x41>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "  two  blanks ", "١٢٣ Ελληνικά кириллица", "Hello, world!", "a b c d e f", "﻿mark​",
]


def odd_text(rng):
    return "".join(rng.choice(["a", "the ", "ing", " ", "\n", "é", "漢", "字 ", "🙂", "12", "!!", "\t", "ß", "́", "Q"]) for _ in range(rng.randrange(60)))


def test_alignment_by_hand(spark, sides, libraries):
    texts = TEXTS + [odd_text(RNG) for _ in range(60)] + ["word " * 400]
    found, sums = aligned_by_hand(texts, libraries), None
    sums = sums_by_hand(found)
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, pairs string, N_BEST double").repartition(4)
    out, (n_a, n_b, n_groups, n_links, groups, pairs, times) = alignment.align(df, *sides)
    assert "pairs" in out.columns and pairs != "pairs"
    for set_pairs in (4_000_000, 40):
        full, (n_best, count_sum) = alignment.with_count_sums(out, alignment.pair_counts(out, sides[1].size, pairs), sides[1].size, pairs, times, set_pairs)
        for r in full.collect():
            a, b, g, links = found[r.doc_id]
            assert (r[n_a], r[n_b], r[n_groups], r[n_links], r[groups]) == (a, b, len(g), len(links), group_text(g)), texts[r.doc_id]
            assert dict(zip(r[pairs], r[times])) == Counter(i * sides[1].size + j for i, j in links)
            assert (r[n_best], r[count_sum], r["pairs"], r["N_BEST"]) == (*sums[r.doc_id], "x", 1.5)


def test_alignment_query_on_whole_texts(spark, data, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    some = sorted(docs, key=lambda i: len(docs[i] or ""))[:150]
    got = {r.doc_id: r for r in queries.op13_alignment(spark, data).collect()}
    assert set(got) == set(docs)
    for i, (a, b, groups, links) in zip(some, aligned_by_hand([docs[i] for i in some], libraries)):
        digest = hashlib.sha256(group_text(groups).encode()).hexdigest() if groups else ""
        assert (got[i].n_a, got[i].n_b, got[i].n_groups, got[i].n_links, got[i].groups_sha256) == (a, b, len(groups), len(links), digest)
    assert sum(r.count_sum for r in got.values()) >= sum(r.n_links for r in got.values())


def test_alignment_sums_of_a_whole_table(spark, tmp_path, libraries):
    rows = [(i, odd_text(RNG)) for i in range(40)] + [(3, "again"), (3, "again"), (None, "no id"), (7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = aligned_by_hand([t for _, t in rows], libraries)
    want = sorted((str(i), s, h) for (i, _), s, h in zip(rows, sums_by_hand(found), [group_text(f[2]) for f in found]))
    got = queries.op13_alignment(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), (r.n_best, r.count_sum)) for r in got) == [w[:2] for w in want]
    assert sorted(r.groups_sha256 for r in got) == sorted(hashlib.sha256(h.encode()).hexdigest() if h else "" for *_, h in want)


def test_alignment_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_alignment(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_common_groups_by_hand(seed):
    rng = random.Random(seed)
    a, b, whole, at = [], [], [], 0
    for _ in range(rng.randrange(1, 9)):
        n = rng.choice([1, 2, 5, 60, 4000])
        for side, odds in ((a, rng.random()), (b, rng.random())):
            side += [at + k for k in range(1, n) if rng.random() < odds and (seed < 3 or k % 2 == (side is a))]
            side.append(at + n)
        at += n
        whole.append(at)
    got = alignment.common_groups(np.array(a), np.array(b), np.array(whole))
    cuts = sorted(set(a) & set(b))
    want = [(sum(x <= low for x in a), sum(x <= high for x in a), sum(x <= low for x in b), sum(x <= high for x in b)) for low, high in zip([0, *cuts], cuts)]
    assert list(zip(*[x.tolist() for x in got])) == want


def test_sides_encode_as_their_libraries(sides, libraries):
    rng = random.Random(3)
    texts = [t for t in TEXTS if t] + [odd_text(rng) for _ in range(300)] + [" " * 5000 + "x", "\n" * 3000, "a" * 20000]
    classes = ["".join(f"a{chr(c)}1 {chr(c)}" for c in range(k, k + 256)) for k in range(0, 0x11000, 256) if not 0xD800 <= k < 0xE000]
    a, b = sides
    for t in texts + classes:
        assert a.encode([t])[0].tolist() == libraries[0].encode(" " + t, add_special_tokens=False).ids
    for block in (texts + classes, *[[t] for t in texts]):
        for t, ids in zip(block, b.encode(block)):
            raw = b"".join([b.bytes[i] for i in libraries[1].encode(t)])
            assert (ids is None) == (raw != (" " + t).encode())
            assert ids is None or ids.tolist() == libraries[1].encode(t)


def test_long_text_without_cuts():
    a, b = np.append(np.arange(1, 200_000, 2), 200_000), np.append(np.arange(2, 200_000, 2), 200_000)
    assert [x.tolist() for x in alignment.common_groups(a, b, np.array([200_000]))] == [[0], [100_001], [0], [100_000]]


# vector codes


def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    """[(id, code, error)] and the codebooks, with plain loops over all entries."""
    kept = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][2])
    cut = [size * k // parts for k in range(parts + 1)]
    firsts = {}
    for i, _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        firsts.setdefault(i, v)
    starts = list(firsts.values())[:entries]
    books = [[v[a:b] for v in starts] for a, b in zip(cut, cut[1:])]

    def assigned():
        out = []
        for _, _, v in kept:
            found = []
            for book, a, b in zip(books, cut, cut[1:]):
                distance = [sum((x - y) ** 2 for x, y in zip(v[a:b], e)) for e in book]
                found.append((distance.index(min(distance)), min(distance)))
            out.append(found)
        return out

    for _ in range(rounds):
        near = assigned()
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            for e in range(len(starts)):
                mine = [v[a:b] for (_, _, v), found in zip(kept, near) if found[p][0] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assigned()
    errors = Counter()
    for (_, y, _), found in zip(kept, near):
        errors[y] += sum(d for _, d in found)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), errors[y]) for (i, y, _), found in zip(kept, near)], digest


@pytest.mark.parametrize("seed, width, n", [(0, 16, 200), (1, 32, 150), (2, 20, 90), (3, 16, 30), (4, 5, 100)])
def test_vector_codes_by_hand(spark, seed, width, n):
    rng = random.Random(seed)
    rows = [(rng.randrange(10 * n), rng.choice([0, 1, 1, 1, None]), [rng.choice([rng.gauss(0, 1), 0.5, -0.25]) for _ in range(width)]) for _ in range(n)]
    rows = list({r[0]: r for r in rows}.values()) + [(-5, 1, None), (-4, 1, [None] + [0.0] * (width - 1)), (-3, 1, [math.nan] * width), (-2, 1, [math.inf] * width)]
    rows += rows[:10] + [(None, 2, [0.1] * width)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, code string").repartition(5)
    got, books = vector_codes.encode(df)
    want, digest = codes_by_hand(rows)
    assert sorted(map(str, got.select("vec_id", "code", "error", "label_error").collect())) == sorted(
        f"Row(vec_id={i}, code='{c}', error={e}, label_error={s})" for i, c, e, s in want
    )
    assert books.sha256() == digest


def test_gnat_by_hand():
    rng = np.random.default_rng(5)
    for n, d, spread in [(64, 4, 3), (64, 4, 300), (200, 2, 10), (1, 3, 5), (9, 1, 2), (64, 4, 0), (300, 8, 100), (64, 3, 2**26)]:
        points = rng.integers(-spread, spread + 1, (n, d))
        asked = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (500, d)), points])
        entry, squared = vector_codes.Gnat(points).nearest(asked)
        every = ((asked[:, None, :] - points[None]) ** 2).sum(axis=2)
        assert (squared == every.min(axis=1)).all() and (entry == every.argmin(axis=1)).all()


def test_gnat_leaves_subtrees_out(monkeypatch):
    rng, looked = np.random.default_rng(6), []
    points = rng.integers(-1000, 1000, (64, 2))
    tree = vector_codes.Gnat(points)
    real = vector_codes._squared
    monkeypatch.setattr(vector_codes, "_squared", lambda a, b: looked.append(len(a) * len(b)) or real(a, b))
    tree.nearest(rng.integers(-1000, 1000, (1000, 2)))
    assert sum(looked) < 64 * 1000 * 0.6


def test_vector_codes_odd_tables(spark):
    schema = "vec_id long, label string, embedding array<float>"
    empty, books = vector_codes.encode(spark.createDataFrame([], schema))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "code", "error", "label_error"] and books.entries == []
    only_bad, _ = vector_codes.encode(spark.createDataFrame([(1, "a", None), (2, "a", [math.nan])], schema))
    assert only_bad.collect() == []
    huge, _ = vector_codes.encode(spark.createDataFrame([(1, "a", [1e38] * 16), (2, None, [-1e38] * 16), (3, "a", [1.0] * 15), (4, "b", [])], schema))
    assert sorted((r.vec_id, r.label, r.code, r.error, r.label_error) for r in huge.collect() if r.label) == [(1, "a", "00" * 16, 0, 0)]
    assert huge.count() == 2  # vectors of other lengths are dropped
    none, _ = vector_codes.encode(spark.createDataFrame([(1, "a", []), (2, "a", [])], schema))
    assert [(r.code, r.error, r.label_error) for r in none.collect()] == [("00" * 16, 0, 0)] * 2
    same, _ = vector_codes.encode(spark.createDataFrame([(9, "a", [0.5] * 16)] * 50, schema))
    assert {(r.code, r.error) for r in same.collect()} == {("00" * 16, 0)} and same.count() == 50


def test_vector_codes_stand_for_vectors(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, 0, [rng.gauss(0, 1) for _ in range(16)]) for i in range(40)], "vec_id long, label int, embedding array<double>")
    codes, books = vector_codes.encode(df)
    back = {r.vec_id: r.vector for r in vector_codes.decode(codes, books).collect()}
    assert all(max(abs(x - y) for x, y in zip(r.embedding, back[r.vec_id])) <= 1 / 256 for r in df.collect())  # fewer vectors than entries


# quality


def test_features_of_odd_texts():
    for text in [None, "", " ", "\n", "a", "😀", "x" * 100_000, "A!! B!!\n\nA!! B!!", "\x85  "]:
        found = quality.features(text)
        assert len(found) == len(quality.FEATURES) and all(math.isfinite(x) for x in found)
    assert quality.features(None) == quality.features("")


def test_trees_by_hand():
    rng = np.random.default_rng(1)
    slope, curve = rng.normal(size=9), rng.random(9)
    value = lambda a, b: a * a / (b + quality.SMOOTHING)
    cuts = [value(slope[:k].sum(), curve[:k].sum()) + value(slope[k:].sum(), curve[k:].sum()) for k in range(1, 9)]
    k = int(np.argmax(cuts)) + 1
    step = quality.shallow_tree(slope, curve)
    assert len(set(step.tolist())) == 3 and step[k - 1] != step[k]
    s, c = rng.normal(size=(4, 5)), rng.random((4, 5))
    gain, step = quality.cross_tree(s, c)
    best = max(
        sum(value(s[r, q].sum(), c[r, q].sum()) for r in (slice(0, i), slice(i, 4)) for q in (slice(0, j), slice(j, 5))) for i in range(1, 4) for j in range(1, 5)
    )
    assert gain == pytest.approx(best - value(s.sum(), c.sum())) and len(set(step.ravel().tolist())) == 4


def test_score_is_the_sum_of_its_tables():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction: neither feature helps alone
    model = quality.fit_additive(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) >= 0.5) == y).mean() > 0.85
    for row in x[:20]:
        total = model.base + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(row, model.edges, model.tables))
        total += sum(t[sum(row[f] >= e for e in model.coarse[f]), sum(row[g] >= e for e in model.coarse[g])] for (f, g), t in zip(model.pairs, model.pair_tables))
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + math.exp(-total)))


def test_quality_on_held_out_documents(spark, tmp_path):
    source = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op11_quality(spark, source).collect()}
    labels = spark.read.parquet(f"{source}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(got) == spark.read.parquet(f"{source}/documents.parquet").count()
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == (got[i].score >= 0.7) and 0 <= got[i].score <= 1 for i in got)
    right = [got[r.doc_id].predicted == r.quality for r in held]
    assert len(right) > 60 and sum(right) / len(right) > 0.93


def test_held_out_labels_are_not_used(spark, data, tmp_path):
    """Labels of the held-out documents turned round, and everything but the text changed: equal scores."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{tmp_path}/labels.parquet")
    docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "score": F.lit("clash")}).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    before, after = ({r.doc_id: r.score for r in queries.op11_quality(spark, d).collect()} for d in (data, str(tmp_path)))
    assert before == after


def test_quality_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "c"), (3, "")], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, None), (None, 1), (9, 0), (2, 7)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        rows = quality.with_scores(docs, model).collect()
        assert len(rows) == 5 and len({r.score for r in rows}) == 1 and 0 < rows[0].score < 1
    model = quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0), (3, 0), (3, 1), (2, 0)], "doc_id long, quality int"))
    clash = docs.withColumns({"score": F.lit("x"), "features": F.lit(1), "__x": F.lit(2)})
    rows = quality.with_scores(clash, model).collect()
    assert all(r["score"] == "x" and 0 < r["score_"] < 1 for r in rows) and len({r["score_"] for r in rows if r.doc_id == 1}) == 1
    assert quality.with_scores(docs.where("false"), model).collect() == []
    assert quality.fit(clash, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).tables
