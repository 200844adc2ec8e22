"""Fingerprints, suffix dedup, HTML extraction, LM scoring, Jaccard join: brute force and edge cases."""

import hashlib
import math
import random
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import components, fingerprints, html_extract, jaccard_join, lm_scoring, queries, suffix_dedup

RNG = random.Random(5)


def prose(n, words=("alpha", "beta", "gamma", "delta", "of", "the", "épsilon"), rng=RNG):
    return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))


# fingerprints


def winnow_by_hand(hashes, window):
    if not hashes:
        return []
    chosen = []
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i : i + window]
        at = max(j for j, h in enumerate(part) if h == min(part)) + i
        if not chosen or chosen[-1] != at:
            chosen.append(at)
    return chosen


def test_winnowing_by_hand():
    w = fingerprints.Winnower(5, 4)
    for text in ["", "a", "abcd", "abcde", "abcdefgh", "aaaaaaaaaaaaaaaa", prose(30), "日本語" * 9]:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        gram = min(5, len(codes))
        hashes = (w.between(w.sums(codes), slice(0, len(codes) - gram + 1), slice(gram, len(codes) + 1)) >> np.uint64(32)).tolist() if len(codes) else []
        values, positions = w.choose(text)
        assert positions.tolist() == winnow_by_hand(hashes, 4)
        assert values.tolist() == [hashes[p] for p in positions]
        grams = [text[i : i + gram] for i in range(len(hashes))]
        assert all((hashes[i] == hashes[j]) == (grams[i] == grams[j]) for i in range(len(grams)) for j in range(i))


def test_match_guarantee():
    w = fingerprints.Winnower()
    shared = prose(20)[: fingerprints.GRAM + fingerprints.WINDOW - 1]
    for _ in range(50):
        a, b = (w.choose(prose(RNG.randrange(30)) + "|" + shared + "|" + prose(RNG.randrange(30)))[0] for _ in "ab")
        assert set(a.tolist()) & set(b.tolist())


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_edits_follow_the_ids(spark, parts):
    texts = [None, "", "x", "ab", "same", "same", prose(200), "héé" * 30, "tail"]
    rows = [(i * 7 % 31, t, "n") for i, t in enumerate(texts)] + [(None, "no id", "n"), (3, "three", "n"), (3, "three", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = fingerprints.edit_fingerprints(df).collect()
        assert fingerprints.edit_fingerprints(df.where("false")).count() == 0
        alone = fingerprints.edit_fingerprints(df.where("text = 'tail'")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert alone.edited_sha256 == hashlib.sha256(b"tata").hexdigest()
    order = sorted(((-1 if i is None else i), t or "") for i, t, _ in rows)
    w = fingerprints.Winnower()
    want = []
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        (f, at), (fe, e_at), (fn, _) = (w.choose(x) for x in (t, e, n))
        near = [len(set(f) & set(x)) / len(set(f) | set(x)) if len(f) or len(x) else 1.0 for x in (fe, fn)]
        want.append((None if i < 0 else i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.as_string(f), fingerprints.as_string(fe), *near, at.tolist(), e_at.tolist()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_fingerprint_columns(spark):
    df = spark.createDataFrame([(1, "x", 2), (2, None, 3)], "id long, text string, hashes int")
    out = fingerprints.fingerprints(df).orderBy("id").collect()
    assert [len(r.hashes) for r in out] == [1, 0] and out[0].positions == [0]


def test_positions_hold_the_grams(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    order, w = sorted(texts), fingerprints.Winnower()
    for r in queries.op3_fingerprints(spark, data).collect():
        following = texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        for text, found, positions in ((texts[r.doc_id], r.fingerprint, r.positions), (fingerprints.edited(texts[r.doc_id], following), r.edited_fingerprint, r.edited_positions)):
            assert positions == sorted(set(positions)) and len(found) == 8 * len(positions)
            for k in (0, len(positions) // 2, len(positions) - 1) if positions else ():
                gram = text[positions[k] : positions[k] + fingerprints.GRAM]
                assert fingerprints.as_string(w.choose(gram)[0]) == found[8 * k : 8 * k + 8]


def test_equal_hashes_of_other_grams_do_not_count():
    w = fingerprints.Winnower(4, 3)
    a, b = fingerprints.Chosen(w, "some words here"), fingerprints.Chosen(w, "some words there")
    near = fingerprints.likeness(a, b)
    assert 0 < near < 1 and fingerprints.likeness(a, a) == 1
    b.text = "?" * len(b.text)  # the same hashes, as if they had collided
    assert fingerprints.likeness(a, b) == 0


def test_edited_texts_are_near(spark, data):
    rows = queries.op3_fingerprints(spark, data).where("n_chars > 300").collect()
    assert min(r.near_edited for r in rows) > 0.05
    assert sum(r.near_edited for r in rows) > 3 * sum(r.near_next for r in rows)


# suffix dedup


def repeats_by_hand(texts, depth):
    seen = Counter(t[i : i + depth] for t in texts for i in range(len(t) - depth + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone |= set(range(i, i + depth))
        out.append(gone)
    return out


def dedup_corpus():
    rng = random.Random(11)
    base, passage = prose(120, rng=rng), prose(40, rng=rng)
    texts = [None, "", "short", base, base, base[:500] + "CHANGED" + base[500:], "z" * 700, prose(60, rng=rng)]
    texts += [prose(30, rng=rng) + passage + prose(20, rng=rng) for _ in range(9)]
    texts += [passage * 2, "é" * 99 + base[:199], base[200:420], "日本" * 60 + "x", "日本" * 60 + "y"]
    return texts


@pytest.mark.parametrize(("bucket_rows", "block"), [(2048, 1 << 20), (1, 1 << 20), (2048, 500)])
def test_repeated_bytes_by_hand(spark, bucket_rows, block):
    texts = dedup_corpus()
    df = spark.createDataFrame([(i if i else None, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    df = df.withColumn("n", F.coalesce("doc_id", F.lit(0)))
    out = suffix_dedup.without_repeats(df, bucket_rows=bucket_rows, block_bytes=block).orderBy("n").collect()
    raw = [(t or "").encode() for t in texts]
    assert len(out) == len(raw)
    for r, t, gone in zip(out, raw, repeats_by_hand(raw, suffix_dedup.DEPTH)):
        assert bytes(r.kept) == bytes(b for i, b in enumerate(t) if i not in gone)
        assert {i for s in r.spans for i in range(s.start, s.end)} == gone
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("bucket_rows", [3, 2048])
def test_crowded_buckets_by_hand(spark, bucket_rows):
    """Passages in many different surroundings, cut off on either side or both, beside each other and in long runs."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(420))
    noise = lambda n: "".join(rng.choice("qrstuvwxyz ") for _ in range(n))
    texts = [noise(rng.randrange(90)) + passage[rng.randrange(0, 180) : rng.randrange(260, 420)] + noise(rng.randrange(90)) for _ in range(40)]
    texts += [noise(60) + passage[100:300] + noise(60) for _ in range(8)] + [noise(60) + passage[100:299] + noise(60) for _ in range(8)]
    texts += [passage * 3, *[noise(20) + "ab" * 200 + noise(i) for i in range(6)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = suffix_dedup.without_repeats(df, bucket_rows=bucket_rows).orderBy("doc_id").collect()
    raw = [t.encode() for t in texts]
    for r, t, gone in zip(out, raw, repeats_by_hand(raw, suffix_dedup.DEPTH), strict=True):
        assert {i for s in r.spans for i in range(s.start, s.end)} == gone
        assert bytes(r.kept) == bytes(b for i, b in enumerate(t) if i not in gone)


def test_repeated_rows_share_their_marks(spark):
    """Hundreds of equal rows, and a column with the name of an inner one."""
    text = prose(300)
    rows = [(1, text, "x")] * 400 + [(2, prose(300), "y"), (None, text[:500], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __marks string").repartition(4)
    out = suffix_dedup.without_repeats(df).collect()
    assert len(out) == 402 and all(r["__marks"] in "xyz" for r in out)
    assert all(bytes(r.kept) == b"" and len(r.spans) == 1 for r in out if r.doc_id == 1)
    assert [bytes(r.kept).decode() for r in out if r.doc_id == 2] == [rows[400][1]]


def test_suffix_dedup_of_nothing(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert suffix_dedup.without_repeats(df.where("false")).count() == 0
    assert bytes(suffix_dedup.without_repeats(df).first().kept) == b"x"


def test_difference_cover():
    assert {(a - b) % 32 for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(32))
    assert len(suffix_dedup.COVER) <= 9


@pytest.mark.parametrize("depth", [160, 200, 333])
def test_suffix_classes_by_hand(depth):
    rng = np.random.default_rng(depth)
    for _ in range(30):
        base = rng.integers(97, 99, depth + 120).astype(np.uint8)
        parts = []
        for _ in range(rng.integers(1, 10)):
            a = rng.integers(0, 100)
            s = base[a : a + depth + rng.integers(0, 20)].copy()
            if rng.random() < 0.6:
                s[rng.integers(0, len(s))] = 120
            parts.append(s.tobytes())
        copies = rng.integers(1, 3, len(parts))
        seen = Counter()
        for s, c in zip(parts, copies):
            for i in range(len(s) - depth + 1):
                seen[s[i : i + depth]] += c
        got = suffix_dedup.repeated_windows(parts, copies, depth)
        assert [g.tolist() for g in got] == [[seen[s[i : i + depth]] > 1 for i in range(len(s) - depth + 1)] for s in parts]


# HTML


def page(body, article=True):
    text = f"<article><h1>Title &amp; more</h1><p>{body}<p>Second <b>bold</b>er<br>line</article>" if article else f"<div><p>{body}</p></div>"
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><header>Site</header>"
        f"<nav><ul><li><a href=/x>Menu</a></ul></nav><!-- ad --><div class='ad-box'>Buy</div>{text}<aside>Side</aside>"
        "<div id='comments'><p>I think</div><form>Mail <input></form><div>We use nothing but good things here.</div><footer>&copy; x</footer></body></html>"
    )


def test_article_text(spark):
    rows = [(1, "http://u@A.example:80/x?y", page("one\n  two &lt;3"), "t"), (2, None, None, "t"), (3, "no url", "", "t"), (4, "http://b.example", "<p>plain <b>text</p><p>end", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_extract.extract(df).orderBy("page_id").collect()
    assert [r.text for r in out] == ["Title & more one two <3 Second bolder line", "", "", "plain text end"]
    assert html_extract.extract(df.where("false")).count() == 0


@pytest.mark.parametrize("limit", [html_extract.BROADCAST_HASHES, 0])
def test_template_goes_where_it_recurs(spark, monkeypatch, limit):
    monkeypatch.setattr(html_extract, "BROADCAST_HASHES", limit)
    site = [(i, "https://site.example/%d" % i, page(f"own text {i}", article=False)) for i in range(6)]
    other = [(9, "https://other.example/", page("own text 9", article=False))]
    out = html_extract.extract(spark.createDataFrame(site + other, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [r.text for r in out[:6]] == [f"own text {i}" for i in range(6)]
    assert out[6].text == "own text 9 We use nothing but good things here."


def test_passages_that_articles_share_stay(spark):
    rows = [(i, "https://site.example/%d" % i, page("shared words")) for i in range(8)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in out.collect()} == {"Title & more shared words Second bolder line"}


def test_boxes_inside_articles_go_where_they_recur(spark):
    box = "<div class='box-7'><h2>Join us</h2><p>Our letter, every week.</div>"
    rows = [(i, "https://site.example/%d" % i, page(f"own words {i} {box}")) for i in range(8)]
    rows += [(10 + i, "https://copies.example/%d" % i, page(f"copied {box}") + f"<div>{i}</div>") for i in range(8)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [r.text for r in out[:8]] == [f"Title & more own words {i} Second bolder line" for i in range(8)]  # a paragraph is no box
    assert {r.text for r in out[8:]} == {"Title & more copied Join us Our letter, every week. Second bolder line"}


def test_copies_of_a_page_keep_their_text(spark):
    """With and without an article or main element, copied row for row or under another URL."""
    bodies = {"none": page("copied words", article=False), "article": page("copied words"), "main": page("copied words", article=False).replace("<div><p>copied words</p></div>", "<main><p>copied words</main>")}
    for kind, html in bodies.items():
        rows = [(i, f"https://site.example/{kind}/{i % 3}", html) for i in range(7)]
        rows += [(10 + i, f"https://site.example/{kind}/x{i}", page(f"own {i}", article=kind == "article")) for i in range(9)]
        out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert all("copied words" in out[i] and "good things" not in out[i] for i in range(7))
        assert all(f"own {i}" in out[10 + i] and "good things" not in out[10 + i] for i in range(9))


def test_paragraphs_that_articles_share_stay(spark):
    line = "<p>Published under a free licence.</p><blockquote>To be or not to be.</blockquote>"
    rows = [(i, f"https://site.example/{i}", f"<article><p>own {i}</p>{line}</article>") for i in range(9)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {f"own {i} Published under a free licence. To be or not to be." for i in range(9)}


@pytest.mark.parametrize("ratio, least", [(0.1, 5), (0.5, 2)])
def test_templates_by_counting(spark, ratio, least):
    """Which subtrees go is found again by comparing all pages of a host with each other."""
    rng = random.Random(6)
    boxes = [f"<div class='b{k}'>box {k} <span>words {k}</span></div>" for k in range(6)]
    rows = []
    for i in range(60):
        host, own = rng.choice(["a.example", "b.example", "b.example"]), f"<p>text {i % 50}</p>"
        some = "".join(b for k, b in enumerate(boxes) if rng.random() < (k + 1) / 9)
        rows.append((i, f"http://{host}/{i}", f"<html><body>{some}{own}</body></html>" if i % 2 else f"<html><body>{some}<article>{own}{boxes[i % 6]}</article></body></html>"))
    rows += [(100 + i, *rows[3][1:]) for i in range(8)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), ratio=ratio, min_pages=least).collect()}
    for i, url, html in rows:
        host = url.split("/")[2]
        pages = {h for _, u, h in rows if u.split("/")[2] == host}
        split = lambda h: re.split("</?article>", h) if "<article>" in h else [h, "", ""]
        articles = {split(h)[1] for h in pages if "<article>" in h}
        outside = [b for b in boxes if (n := sum(b in split(h)[0] + split(h)[2] for h in pages)) >= least and n >= ratio * len(pages)]
        within = [b for b in boxes if (n := sum(b in a for a in articles)) >= least and n >= ratio * len(articles)]
        shown = split(html)[1] if "<article>" in html else html
        for b in within if "<article>" in html else outside:
            shown = shown.replace(b, " ")
        assert out[i] == " ".join(re.sub("<[^>]*>", " ", shown).split()), html


def test_names_that_hold_or_head_content_stay():
    text = lambda html: html_extract.main_text(html_extract.parse(html), set())
    for around in ("<div class='layout has-sidebar'>%s</div>", "<div id='content-with-comments'>%s</div>", "<form>%s</form>", "<div class=sidebar>%s</div>"):
        assert text(around % "<article><p>kept</article>") == text(around % "<main><p>kept</main>") == "kept"
    assert text("<article>kept<div id=comments><article>x</article></div></article><aside><article>x</article></aside>") == "kept"
    for part in ("<section id='comments'>x</section>", "<div class='user-comments'>x</div>", "<div id='reader-comments'><p>x</div>", "<ol class='commentList'><li>x</ol>"):
        assert text(f"<article>kept{part}</article>") == text(f"<div>kept{part}</div>") == "kept"
    assert text("<article><fieldset><legend>kept</legend><p>words</fieldset><label>too</label></article>") == "kept words too"
    assert text("<article>kept<fieldset><p>x<input></fieldset><label for=a>x</label><label>x<select></select></label></article>") == "kept"
    parts = ("<h2 id='social-history'>kept</h2>", "<section id='related-work'>kept</section>", "<div class='notice-period'>kept</div>", "<h2 id=comments>kept</h2>")
    for part in parts:
        assert text(f"<article>{part}</article>") == "kept"
    for part in ("<div class='ad-box'>x</div>", "<div class='wide sidebar'>x</div>", "<div class='shareButtons'>x</div>", "<form>x</form>"):
        assert text(f"<article>kept{part}</article>") == text(f"<div>kept{part}</div>") == "kept"


def test_broken_markup():
    for html in ["<", "<p", "</p>", "<article>", "a<b", "<ul><li>a<li>b<ul><li>c</ul>d</ul>", "<table><tr><td>1<td>2<tr><td>3</table>", "<div>" * 5000 + "x"]:
        html_extract.main_text(html_extract.parse(html), {1})
    assert html_extract.main_text(html_extract.parse("<table><tr><td>1<td>2<tr><td>3</table>"), set()) == "1 2 3"
    assert html_extract.main_text(html_extract.parse("<p>a&nbsp;b &#233;&eacute;"), set()) == "a b éé"


def test_pages_of_the_data(spark, data):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = queries.op5_html(spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        plain = unescape(re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


# LM scoring


def symbols_by_hand(alphabet, words, depth):
    out = []
    for byte in b"\n" * depth + b" ".join(words) + b"\n":
        out.append(int(alphabet.first[byte]))
        if out[-1] == 0:
            out.append(int(alphabet.second[byte]))
    return out


def contexts_by_hand(alphabet, texts, depth, min_count, min_gain):
    """{context: {next: count}} of the contexts that pass, oldest symbol first."""
    counts, totals, gain = Counter(), Counter(), Counter()
    for t in texts:
        s = symbols_by_hand(alphabet, lm_scoring.tokens(t), depth)
        counts.update((tuple(s[i - d : i]), s[i]) for i in range(depth, len(s)) for d in range(depth + 1))
    for (c, _), n in counts.items():
        totals[c] += n
    for (c, a), n in counts.items():
        if c:
            gain[c] += n * math.log(n / totals[c] / (counts[c[1:], a] / totals[c[1:]]))
    kept = {c: {} for c in totals if len(c) < 2 or (totals[c] >= min_count and gain[c] >= min_gain)}
    for (c, a), n in counts.items():
        if c in kept:
            kept[c][a] = n
    return kept


def log_by_hand(kept, discount, symbols, depth):
    known = {}

    def chance(context, a):
        if (context, a) not in known:
            seen, off = kept.get(context, {}), discount[len(context)]
            if context:
                base = chance(next(context[k:] for k in range(1, len(context) + 1) if context[k:] in kept or k == len(context)), a)
            else:
                base = 1 / lm_scoring.SIZE
            total = sum(seen.values())
            known[context, a] = max(0, seen.get(a, 0) - off) / total + off * len(seen) / total * base if total else base
        return known[context, a]

    out = 0.0
    for i in range(depth, len(symbols)):
        context = next(tuple(symbols[i - k : i]) for k in range(depth, -1, -1) if k == 0 or tuple(symbols[i - k : i]) in kept)
        out += math.log10(chance(context, symbols[i]))
    return out


def place_of(context, depth):
    return sum(x << 7 * (depth - 1 - k) for k, x in enumerate(reversed(context)))


def context_of(d, place, depth):
    return tuple(place >> 7 * (depth - 1 - k) & 127 for k in range(d))[::-1]


def tree_of(kept, depth, discount):
    d = np.array([len(c) for c in kept], np.int64)
    place = np.array([place_of(c, depth) for c in kept], np.int64)
    s, n = (np.array([x for c in kept.values() for x in y(c)], np.int64) for y in (dict.keys, dict.values))
    return lm_scoring.SuffixTree(d, place, np.concatenate([[0], np.cumsum([len(c) for c in kept.values()])]), s, n, depth, discount)


def test_tree_is_a_distribution():
    kept = {(): {3: 6, 4: 2, 1: 1}, (3,): {4: 5, 1: 1}, (4,): {3: 4}, (4, 3): {1: 3}, (3, 4, 3): {4: 1}}
    discount = [0.5, 0.7, 0.3, 0.9]
    tree = tree_of(kept, 3, discount)
    for context in [(1, 1, 1), (3, 4, 3), (4, 4, 3), (1, 3, 4), (9, 9, 9)]:
        keys = np.array([place_of(context, 3) << 7 | a for a in range(128)])
        logs = tree.look_up(keys)
        assert math.isclose((10**logs).sum(), 1)
        for a in (0, 1, 3, 4, 90):
            assert math.isclose(logs[a], log_by_hand(kept, discount, [*context, a], 3), rel_tol=1e-9)


def test_packing():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 56, 5000))
    assert (lm_scoring.unpacked_keys(lm_scoring.packed_keys(keys), len(keys)) == keys).all()
    n = rng.integers(0, 1 << 31, 777)
    assert (lm_scoring.unpacked(lm_scoring.packed(n, 4), 777, 4) == n).all()
    assert len(lm_scoring.unpacked(lm_scoring.packed(n[:0]), 0)) == 0


def test_every_byte_has_its_own_symbols():
    alphabet = lm_scoring.Alphabet(np.zeros(256))
    spelled = {}
    for byte in range(256):
        if byte not in (9, 11, 12, 13) and not 65 <= byte <= 90:
            spelled[byte] = tuple(alphabet.spell(np.array([byte], np.uint8))[0].tolist())
    assert len(set(spelled.values())) == len(spelled) == 226
    assert all(len(x) == 1 and x != (0,) or x[0] == 0 and len(x) == 2 and 0 <= x[1] < 128 for x in spelled.values())
    texts = [[], ["日本".encode(), b"a"], [bytes([b]) for b in spelled if b not in (10, 32)]]
    keys, lengths = alphabet.strings(texts, 3)
    assert lengths.tolist() == [len(symbols_by_hand(alphabet, t, 3)) - 3 for t in texts]
    want = [place_of(tuple(s[i - 3 : i]), 3) << 7 | s[i] for t in texts for s in [symbols_by_hand(alphabet, t, 3)] for i in range(3, len(s))]
    assert keys.tolist() == want


def lm_rows():
    rng = random.Random(3)
    texts = [prose(RNG.randrange(5, 60), rng=rng) for _ in range(60)]
    scripts = " ".join(chr(c) for c in range(0xC0, 0x2FFF, 37)) + " 日本語 текст שלום 한국어 😀"
    return [*texts, None, "", "  \n", "NEW words only-here", "unseen" * 3000, texts[0], texts[0], scripts]


@pytest.mark.parametrize("frequent", [lm_scoring.MAX_WORDS, 3])
def test_lm_base_by_hand(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "MAX_WORDS", frequent)
    rows = lm_rows()
    df = spark.createDataFrame([(i, t, 1.0, "x", 7) for i, t in enumerate(rows)], "k long, text string, score double, label string, c0 int")
    train = [lm_scoring.tokens(t) + [b"\n"] for t in rows[:40]]
    counts = Counter(w for t in train for w in t)
    n, v = sum(counts.values()), len(counts)
    for training in (df.where("k < 40"), F.when(F.col("k") < 50, F.col("k") < 40)):
        out = lm_scoring.score(df, training).orderBy("k").collect()
        assert len(out) == len(rows)
        for r, text in zip(out, rows):
            own = lm_scoring.tokens(text) + [b"\n"]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.label, r.c0) == (len(own), sum(w in counts for w in own), n, "x", 7)
            assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)


def test_lm_without_training(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "k long, text string")
    for training in (df.where("false"), F.lit(None).cast("boolean")):
        out = lm_scoring.score(df, training).orderBy("k").collect()
        assert [(r.n_known, r.train_tokens, r.base_score) for r in out] == [(0, 0, 0.0), (0, 0, 0.0)]
        assert [round(r.score / math.log10(128), 3) for r in out] == [-4, -1]
    assert lm_scoring.score(df.where("false"), df).count() == 0
    assert lm_scoring.score(df.where("false"), F.lit(True)).count() == 0


@pytest.mark.parametrize("symbols, chunk, head", [(1 << 30, 1 << 30, 3), (900, 600, 1), (2500, 100, 3), (900, 1 << 30, 4)])
def test_scores_by_hand(spark, monkeypatch, symbols, chunk, head):
    """The contexts, the discounts and every text's probability, in one range or many, one chunk or many."""
    monkeypatch.setattr(lm_scoring, "RANGE_SYMBOLS", symbols)
    monkeypatch.setattr(lm_scoring, "CHUNK_SYMBOLS", chunk)
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    rows, depth, found = lm_rows(), 5, {}
    real = lm_scoring.passing_contexts
    monkeypatch.setattr(lm_scoring, "passing_contexts", lambda *a: found.setdefault("contexts", real(*a, min_count=5, min_gain=2.0)))
    alphabets = []
    of = lm_scoring.Alphabet.of
    monkeypatch.setattr(lm_scoring.Alphabet, "of", staticmethod(lambda counts: alphabets.append(of(counts)) or alphabets[-1]))
    df = spark.createDataFrame(list(enumerate(rows)), "k long, text string").repartition(3)
    learned = lambda k: k < 40 or k > 66
    out = lm_scoring.score(df, (F.col("k") < 40) | (F.col("k") > 66), depth=depth).collect()
    kept = contexts_by_hand(alphabets[0], [t for k, t in enumerate(rows) if learned(k)], depth, 5, 2.0)
    got = {}
    for r in lm_scoring.listed(found["contexts"]).collect():
        context = context_of(r.d, r.place, depth)
        assert got.setdefault(context, dict(zip(r.s, r.n))) == dict(zip(r.s, r.n))  # in every range the same
    assert got == kept and len({r.g for r in found["contexts"].collect()}) > (1 if symbols < 1000 else 0)
    assert max(map(len, kept)) == depth
    discount = []
    for d in range(depth + 1):
        times = Counter(n for c, seen in kept.items() if len(c) == d for n in seen.values())
        discount.append(min(0.9, max(0.1, times[1] / (times[1] + 2 * times[2]))) if times[1] else 0.5)
    for r in out:
        want = log_by_hand(kept, discount, symbols_by_hand(alphabets[0], lm_scoring.tokens(rows[r.k]), depth), depth)
        symbols = symbols_by_hand(alphabets[0], lm_scoring.tokens(rows[r.k]), depth)
        assert abs(r.score - want) <= len(symbols) / lm_scoring.STEPS / 2, r.k


def test_short_contexts_pass_as_long_ones():
    """All lengths judged in memory; the joins give the same (see the heads above)."""
    rng = np.random.default_rng(2)
    keys = rng.integers(1, 4, (20_000, 5)) @ (1 << 7 * np.arange(4, -1, -1))
    found = {d: place.tolist() for d, place, *_ in lm_scoring.judged(keys, np.ones(len(keys), np.int64), 4, 1, 50, 0.0)}
    assert [len(found[d]) for d in (1, 2, 3, 4)] == [3, 9, 27, 81]
    found = {d: place.tolist() for d, place, *_ in lm_scoring.judged(keys, np.ones(len(keys), np.int64), 4, 1, 50, 1e6)}
    assert [len(found[d]) for d in (1, 2, 3, 4)] == [3, 0, 0, 0]


def test_gibberish_scores_below_what_was_learned(spark, data):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    learned = next(r.text for r in docs.orderBy("doc_id").collect() if len((r.text or "").split()) > 120)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(100))
    asked = spark.createDataFrame([(1, " ".join(learned.split()[:100])), (2, noise)], "doc_id long, text string")
    real, made_up = lm_scoring.score(asked, docs).orderBy("doc_id").collect()
    assert made_up.score < 5 * real.score < 0


def test_lm_beats_the_base_on_known_words(spark):
    """On what it has learned from, and on held-out texts whose words it knows, given a few MB of text; a word
    that training lacks the base takes for one cheap event, and the tree spells it."""
    assert lm_scoring.DEPTH >= 7
    rows = queries.op7_lm(spark, "/root/testdata/sf0.01").collect()
    for known in ([r for r in rows if not r.held_out], [r for r in rows if r.held_out and r.n_known == r.n_tokens and r.n_tokens > 20]):
        assert known and sum(r.score for r in known) > sum(r.base_score for r in known)
    assert 0 < sum(r.held_out for r in rows) < len(rows)


# Jaccard join


def jaccard_by_hand(rows, words, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None] if sets[i] else [k]
        out.append((k, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def near_copies(n_groups, rng):
    texts = [None, "", "one", "one", "ONE", "one two", "a b c", "a b c d", "  \n "]
    for _ in range(n_groups):
        base = prose(rng.randrange(5, 150), rng=rng).split()
        for _ in range(rng.randrange(1, 12)):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 9))):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(own[: len(own) - rng.randrange(0, 4)]))
    return texts


@pytest.mark.parametrize(("words", "percent", "small"), [(3, 90, False), (5, 80, False), (2, 70, True), (1, 60, True)])
def test_components_by_hand(spark, monkeypatch, words, percent, small):
    if small:
        monkeypatch.setattr(jaccard_join, "LIST_ROWS", 4)
        monkeypatch.setattr(jaccard_join, "SHORT_LIST", 2)
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 200)
        monkeypatch.setattr(jaccard_join, "FREQUENT", 30)
    rng = random.Random(words)
    rows = list(enumerate(near_copies(25, rng)))
    rng.shuffle(rows)
    rows += [(None, rows[0][1]), (None, "alone without an id at all"), rows[1], (rows[2][0], "one more text under a used id")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, node string, component_id string")
    got = [tuple(r) for r in jaccard_join.similar_components(df, words=words, percent=percent).collect()]
    assert sorted(got, key=repr) == jaccard_by_hand(rows, words, percent)


def test_one_of_each(spark):
    rng = random.Random(9)
    rows = list(enumerate(near_copies(10, rng)))
    rows += [rows[0], rows[5], (None, "no id"), (None, "no id"), (rows[-1][0], "another text of this id entirely")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, __node int")
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    components_ = {c for _, n, c in jaccard_by_hand([r for r in rows if r[0] is not None], 5, 80) if n}
    got = kept.where("doc_id is not null and trim(translate(text, '\\n', ' ')) <> ''").collect()
    assert sorted(r.doc_id for r in got) == sorted(components_)
    assert kept.where("doc_id is null").count() == 2
    assert jaccard_join.one_of_each(df.where("false")).count() == 0


def test_connected(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7)] + [(500, k) for k in range(501, 560)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {v for k, v in got.items() if k <= 40} == {0} and {v for k, v in got.items() if 100 <= k <= 200} == {100}
    assert {v for k, v in got.items() if k >= 500} == {500}


def test_jaccard_words_made_for_a_rolling_hash(spark):
    """Words whose polynomial hashes modulo 2^64 agree for every odd base, and short ones that differ in zero bytes."""
    swap = str.maketrans("ab", "ba")
    morse = "a"
    for _ in range(11):
        morse += morse.translate(swap)
    other = morse.translate(swap)
    words = [morse, other, "b", "a\x00", "a", "x" * 64, "x" * 65, "x" * 8, "x" * 9, "x" * 16, "x" * 8 + "\x00"]
    rows = [(i, w) for i, w in enumerate(words)] + [(100, f"{morse} x y {other} x y"), (101, f"{other} x y {other} x y"), (102, " ".join(words))]
    got = [tuple(r) for r in jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=90).collect()]
    assert sorted(got, key=repr) == jaccard_by_hand(rows, 3, 90)
