"""The corpus operators against brute force, with odd rows: nulls, blanks, ties, repeats, empty tables, clashing names."""

import base64
import collections
import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, components, decontaminate, htmltext, langid, packing, quality, repeats, simhash, topk, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit("x") for c in ("score", "row", "sig", "fp", "component_id", "start", "length", "words", "key", "node", "item_id")}) if extra else df


def prose(seed, n=80):
    r = random.Random(str(seed))
    return " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(r.randrange(400)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "   \n\t"), (4, "word"), (5, "word"), (5, "word"), (None, "some text without an id"), (6, "é́ß İ 漢字   x"), (7, "a " * 30_000)]


# --- top-k ----------------------------------------------------------------------------------------------------------


def test_topk_equals_brute_force_with_ties(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(x) for x in r.integers(-3, 4, 6) / 8]) for i in range(300)]
    rows += [(50, rows[50][1]), (900, None), (901, [float("nan")] * 6), (902, [float("inf")] * 6), (903, []), (None, [1.0] * 6), (950, [0.5, 0.25]), (951, [0.5, -0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "score": F.lit("x"), "v": F.lit(0), "block": F.lit(0)})
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in topk.top_k(df).collect()}
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows if i is not None and v and np.isfinite(v).all()}
    want = {}
    for q in whole:
        if q % 50 == 0:
            best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want


def test_topk_small_blocks_and_empty(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 1)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(201)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows}
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in topk.top_k(df).collect()}
    for q in (0, 50, 100, 150, 200):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e6, 1e9])
def test_topk_large_components(spark, size):
    rows = [(i, [size + i, -2.0, float(i % 7)]) for i in range(120)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    limit = int(topk.LARGEST)
    for q in (0, 50, 100):
        score = {i: min(limit, sum(a * b for a, b in zip(whole[q], v))) for i, v in whole.items() if i != q}
        best = sorted((-s, i) for i, s in score.items())[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, -s) for s, i in best]


def test_topk_stops_early_on_skewed_lists():
    r = np.random.default_rng(3)
    m = np.floor(256 * r.normal(size=(5000, 16)) * np.array([8, 4, 2, *[0.02] * 13]))  # a few strong dimensions: lists stop early
    block, n = topk.Lists(np.arange(5000), m), 0
    for q in range(0, 5000, 500):
        floor = np.sort(m @ m[q])[-12:-11]
        found, _, scored = topk.threshold_search(block, np.array([q]), m[q : q + 1], 5, floor)
        assert [i for _, i, _ in found] == [i for _, i in sorted((-s, i) for i, s in enumerate((m @ m[q]).tolist()) if i != q)[:5]]
        n += scored
    assert n < 0.5 * 10 * 5000


# --- packing --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_tokenizer(tokenizer, sf):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    coder, fresh = packing._coder(tokenizer), Tokenizer.from_file(tokenizer)
    assert coder.quick
    texts = ["", " ", "A b  c\x1cd\x85 İSTANBUL Σίσυφος ΟΔΟΣ x́y ́z <|endoftext|> don't it's''s 12three 3.14 \x00q​z ﬁ", "é́ é 가가", *[prose(k) for k in range(5)], "Größe naïve École ÀÉ × ÷ 1/2 ½ ²", "a <|endoftext|> b", "<|EndOfText|>", "a<|startoftext|>"]
    texts += [t for t in pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist() if t]
    for t in texts:
        assert np.frombuffer(coder.ids(t), "<u4").tolist() == fresh.encode(t, add_special_tokens=False).ids


def check_packing(rows, capacity=packing.CAPACITY):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    return by_doc, by_seq


def test_packing_round_trip(spark, tokenizer):
    rows = [*ODD[:6], *ODD[7:], *[(100 + k, prose(k, 30 + 97 * k)) for k in range(25)]]
    df = docs_of(spark, rows, extra=True)
    packed = packing.pack(packing.token_pieces(df, tokenizer)).collect()
    by_doc, by_seq = check_packing(packed)
    coder = packing._coder(tokenizer)
    for i, t in rows:
        ids = np.append(np.frombuffer(coder.ids(t or ""), "<u4"), np.uint32(1))
        own = [r for r in by_doc[i] if r["doc_tokens"] == len(ids)]
        assert sum(r["length"] for r in own) % len(ids) == 0
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids"] == part.tolist() and r["ids_crc32"] == zlib.crc32(part.astype("<u4").tobytes())
    full = sum(r["length"] for r in packed)
    assert len(by_seq) <= full // packing.CAPACITY + 2
    made = packing.sequences(packing.pack(packing.token_pieces(df, tokenizer))).collect()
    assert all(len(r["ids"]) == packing.CAPACITY or r["n_tokens"].bit_count() == 1 for r in made)
    assert packing.pack(packing.token_pieces(df.limit(0), tokenizer, with_ids=False)).count() == 0
    assert packing.pack(packing.token_pieces(docs_of(spark, [(None, "x"), (1, "y")]), tokenizer, with_ids=False)).where("doc_id is null").count() == 1


def test_best_fill_is_closest_to_capacity():
    r = random.Random(3)
    for _ in range(200):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        room = r.randrange(1, 60)
        reach = {0}
        for n, c in counts.items():
            reach = {s + k * n for s in reach for k in range(c + 1)}
        fill = packing.best_fill(counts, room)
        assert all(fill[n] <= counts[n] for n in fill)
        assert sum(n * c for n, c in fill.items()) == max(s for s in reach if s <= room)
        plan = packing.plan_fills(counts, 64)
        used = collections.Counter()
        for f, times in plan:
            assert sum(n * c for n, c in f.items()) <= 64
            for n, c in f.items():
                used[n] += c * times
        assert used == counts


# --- SimHash --------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    import xxhash

    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def closed(fps, radius=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_masks_cover_every_pair():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def test_simhash_equals_brute_force(spark):
    rows = [r for r in ODD if r[0] is not None]
    base = prose(1, 300).split()
    for k in range(40):
        w = list(base)
        w[k * 7] = f"changed{k}"
        rows.append((1000 + k, " ".join(w)))
    got = simhash.near_duplicates(docs_of(spark, rows, extra=True)).collect()
    fps = {(i, plain_fingerprint(t)) for i, t in rows}
    assert {(r["doc_id"], r["fp"] & (2**64 - 1)) for r in got} == fps
    ids, prints = zip(*sorted(fps))
    root = closed(list(prints))
    least = {}
    for i, k in zip(ids, root):
        least.setdefault(k, i)
    want = {(i, p): least[k] for i, p, k in zip(ids, prints, root)}
    assert all(want[r["doc_id"], r["fp"] & (2**64 - 1)] == r["component_id"] for r in got) and len(got) == len(rows)
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("together", [1, 3, 256])
def test_close_links_in_large_buckets(spark, together):
    r = np.random.default_rng(0)
    base, prints = r.integers(-(2**62), 2**62, 4), set()
    for k in range(250):
        x = int(base[k % 4])
        for _ in range(r.integers(0, 5)):
            x ^= 1 << int(r.integers(0, 62))
        prints.add(x)
    fps = sorted(prints)
    links = simhash.close_links(spark.createDataFrame([(x,) for x in fps], "fp long"), together=together)
    comp = {x["node"]: x["component"] for x in components.connected_components(links).collect()}
    root = closed([x & (2**64 - 1) for x in fps])
    ours = [comp.get(x, x) for x in fps]
    assert len(set(zip(root, ours))) == len(set(root)) == len(set(ours))


def test_components_of_paths_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(9, 9), (None, 3), (4, None), (2, 1), (1, 2), (160, 100)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(500, 700)} == {500} and got[1] == got[2] == 1 and 9 not in got and 3 not in got


# --- language -------------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = langid.fit(docs.where(~held))
    told = langid.identify(docs.where(held), model)
    assert told.where("lang = lang_pred").count() >= 0.95 * told.count()
    odd = docs_of(spark, [*ODD, (8, "123 !?")], extra=True)
    found = {(r["doc_id"], r["text"]): r for r in langid.identify(odd, model).collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in [(1, None), (2, ""), (3, "   \n\t"), (8, "123 !?")])
    assert found[7, ODD[-1][1]]["lang_pred"] != "und" and len(found) == len({*ODD, (8, "123 !?")})
    assert langid.identify(odd.limit(0), model).count() == 0
    none = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}


def test_sampling_at_any_size(spark):
    assert all(0 < (common.hash_cut(n, 300) + 2**63) / 2**64 * n < 301 for n in (301, 10**6, 10**12, 10**15))
    df = spark.range(20_000)
    assert 200 < common.sampled(df, F.col("id"), 20_000, 300).count() < 400
    same = df.withColumn("k", F.lit(1))
    assert 0 < common.sampled(same, F.col("k"), 20_000, 300).count() <= 700


def test_long_texts_are_read_whole():
    model = langid.LanguageFilters(["x"], np.full((1 << 20, 1), 1, np.uint64), 20, 2, (3,))
    h, owner = langid.grams(["abc def", "ghi"], (3,))
    assert len(h) == len(langid.grams(["abc def"], (3,))[0]) + len(langid.grams(["ghi"], (3,))[0]) and owner.max() == 1
    long = "word " * 300_000 + "end"
    assert sum(len(p[0]) for _, p in langid._pieces([long])) >= len(long)
    assert langid.score_texts(model, [long])[0] == ["x"]


# --- repeats --------------------------------------------------------------------------------------------------------


def test_shared_passages_are_found_and_cut(spark):
    passage = prose("p", 70)
    rows = [(100 + k, f"{prose(('a', k), 60)} {passage} {prose(('b', k), 60)}") for k in range(30)]
    rows += [(200 + k, prose(("c", k), 150)) for k in range(30)] + [(300, rows[0][1]), (300, rows[0][1])]
    df = docs_of(spark, rows + ODD, extra=True)
    hit = {r["doc_id"] for r in repeats.repeats(df).collect()}
    assert hit == {*range(100, 130), 300}
    left = repeats.without_repeats(df).collect()
    text = {r["doc_id"]: r["text"] for r in left if r["doc_id"] and r["doc_id"] >= 100}
    assert text[100] == rows[0][1] and all(passage not in text[k] and len(text[k].split()) <= 120 for k in range(101, 130))
    assert all(text[k] == t for k, t in rows if k in range(200, 230)) and 300 not in text
    assert collections.Counter((r["doc_id"], r["text"]) for r in left if (r["doc_id"] or 0) < 100) == collections.Counter(ODD)
    assert repeats.repeats(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("together", [2, 128])
def test_similar_paragraphs_equal_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    base = [f"w{k}" for k in range(40)]
    texts = []
    for k in range(24):
        w = list(base)
        if k % 3:
            w[k % 3 - 1 if k % 2 else -(k % 3)] = f"x{k}"
        texts.append(" ".join(w))
    rows = repeats._rows(docs_of(spark, list(enumerate(texts))), "doc_id", "text")
    links = repeats.similar_links(rows, repeats.paragraph_table(rows))
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    sets = {}
    for t in texts:
        sets |= {s: set(g.tolist()) for s, g in repeats.shingle_sets([t], None).items()}
    sig = list(sets)
    parent = {s: s for s in sig}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sig:
        for b in sig:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {s: got.get(s, s) for s in sig} == {s: find(s) for s in sig}


def test_cut_of_many_texts_equals_cut_of_each():
    texts = [None, "", "one", prose(1, 300), "same " * 500, prose(2, 40)]
    both = repeats.cut(texts)
    each = [repeats.cut([t]) for t in texts]
    assert both.signature.tolist() == [s for c in each if len(c.starts) for s in c.signature.tolist()]
    assert both.size.max() <= repeats.LONGEST
    assert repeats.without(texts[3], []) == texts[3] and repeats.without(texts[3], [(0, 1000)]) == ""


# --- decontamination ------------------------------------------------------------------------------------------------


def test_wand_equals_full_scoring():
    r = random.Random(5)
    items = [(k, prose(("i", k), r.randrange(1, 60))) for k in range(60)] + [(70, ""), (None, "x"), (71, None)]
    index = decontaminate.build_index(items)
    for k in range(60):
        words = {*decontaminate.words_of(prose(("i", r.randrange(60)), 60)), *decontaminate.words_of(prose(k, 60))}
        terms = [index.terms[w] for w in words if w in index.terms]
        score = collections.Counter()
        for t in terms:
            for i, s in zip(*index.postings(t)):
                score[i] += s
        for least in (0.05, 0.2, 0.6):
            index.least[:] = least
            found = dict(decontaminate.wand(index, terms, np.arange(index.n_blocks)))
            assert set(found) == {i for i, s in score.items() if s >= least}


def test_a_text_of_a_million_known_words():
    items = [(k, prose(("i", k), 60)) for k in range(300)]
    index = decontaminate.build_index(items)
    known = sorted(index.terms)
    r = random.Random(1)
    words = [known[r.randrange(len(known))] for _ in range(1_000_000)]
    words[500_000:500_000] = decontaminate.words_of(items[7][1])
    assert [h[0] for h in decontaminate.hits(index, words, index.grams)] == [7]


def test_planted_items_are_found(spark):
    items = [(k, prose(("i", k), 15 + k)) for k in range(40)] + [(90, None), (91, "")]
    rows = [(k, f"{prose(('x', k), 200)} {items[k][1].upper() if k % 2 else items[k][1]} {prose(('y', k), 200)}") for k in range(40)]
    clean = [(100 + k, prose(("z", k), 300)) for k in range(40)]
    half = [(200, f"{prose('h', 50)} {' '.join(items[39][1].split()[:20])} {prose('g', 50)}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(spark, rows + clean + half + ODD + [rows[3]], extra=True)
    got = decontaminate.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k in range(40)} and len(got) == 41
    assert decontaminate.clean(df, bench).count() == len(clean + half + ODD)
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0


def test_many_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 15)
    items = [(k, prose(("i", k), 40)) for k in range(40)]
    df = docs_of(spark, [(k, f"{prose(k, 30)} {items[k][1]}") for k in range(40)])
    got = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k in range(40)}


# --- HTML -----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><div class="cookie-notice">We use cookies on this site</div>
<main><article><h2>A&nbsp;title &amp; more</h2><p>First   paragraph with <b>bold</b> words<script>var x = "</p>";</script> and 1 &lt; 2.</p>
<p>Second paragraph, quite a bit longer than the first one is.<br>Same block.</p></article>
<section class="comments"><h3>Comments</h3><p>I liked this very much, thanks for it.</p></section></main>
<aside class="sidebar"><p>Read these other stories as well</p></aside><form><label>Mail</label><input><button>Send</button></form>
<div class="ad">Buy one now</div><footer>&copy; us</footer></body></html>"""


@pytest.fixture(scope="module")
def labeller(spark, sf):
    return htmltext.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def test_main_text_of_a_page(labeller):
    assert htmltext.main_texts(labeller, [PAGE]) == ["A title & more\nFirst paragraph with bold words and 1 < 2.\nSecond paragraph, quite a bit longer than the first one is. Same block."]


def test_main_text_of_odd_pages(spark, labeller):
    odd = [None, "", "   ", "<", "<p", "plain words only", "<script>never closed <p>x</p>", "<article><p>" + "long text " * 20_000 + "</p></article>", "<p>a<p>b</article></div><li>c", "<!-- <p>x</p>"]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(odd)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in htmltext.extract(df, labeller).collect()}
    assert got[0] == got[1] == got[2] == "" and len(got) == len(odd) and len(got[7]) == 20_000 * 10 - 1
    assert htmltext.extract(df.limit(0), labeller).count() == 0
    htmltext.fit(df.limit(0), rounds=1)


def test_labeller_on_new_pages(labeller):
    pages = htmltext.training_sequences([f"<article><p>{prose(k)}</p><p>{prose(-k)}</p></article>" for k in range(1, 60)], rounds=1, seed=77)
    p = np.concatenate(labeller.chance(pages))
    y = np.concatenate([s.label for s in pages])
    assert ((p > 0.5) == y).mean() > 0.97


def test_page_of_many_blocks(labeller):
    page = "<main>" + "".join(f"<p>{prose(k, 12)}.</p>" for k in range(50_000)) + "</main><footer><p>us</p></footer>"
    text = htmltext.main_texts(labeller, ["<p>x</p>", page, None])[1]
    assert text.count("\n") > 45_000 and text.startswith(prose(0, 12))
    small = [htmltext.main_texts(labeller, [PAGE, page[:3000]], cells=c) for c in (1, 50, 10**6)]
    assert small[0] == small[1] == small[2]


def test_labeller_on_other_markup(labeller):
    """Hand-made mark-ups that the training pages do not have: the share of blocks told right."""
    r, right, total = random.Random(8), 0, 0
    for k in range(40):
        main = [prose(("m", k, i), r.randrange(20, 60)) + "." for i in range(r.randrange(3, 8))]
        menu, side = [prose(("n", k, i), 2) for i in range(6)], prose(("s", k), 25)
        body = "".join(f"<p>{t}</p>" for t in main)
        page = [
            f"<html><body><ul class='mainmenu topnav'>{''.join(f'<li><a href=/{i}>{m}</a></li>' for i, m in enumerate(menu))}</ul><div class='story-text article'><span>{'</span></p><p><span>'.join(main)}</span></div><div id='cookies-popup'><span>{side}</span></div></body></html>",
            f"<table><tr><td class='navcol'>{''.join(f'<div><a href=#>{m}</a></div>' for m in menu)}</td><td class='main content'>{body}</td></tr></table><div class='footer-links'><a href=#>{side}</a></div>",
            f"<div class='wrapper'><div role='banner'><a href=/>{menu[0]}</a></div><main class='page-content'>{body}</main><div class='comment-section'><div class='comment'><p>{side}</p></div></div></div>",
            f"<section class='hero'><nav>{' '.join(f'<a>{m}</a>' for m in menu)}</nav></section><article itemprop='articleBody'>{body}</article><aside class='promo-box'><p>{side}</p></aside>",
        ][k % 4]
        blocks = htmltext.blocks(page)
        kept = set(htmltext.main_texts(labeller, [page])[0].split("\n"))
        right += sum((b.text in kept) == (b.text in set(main)) for b in blocks)
        total += len(blocks)
    assert right >= 0.9 * total, right / total


@pytest.mark.parametrize("page, n", [("<a " * 300_000, 1), ("<a<b" * 200_000, 1), ('<a "' * 200_001, 1), ("<svg/>" * 100_000, 0), ("<div class='a b'>x" * 50_000, 50_000), ("<div>" * 30_000 + "</p>" * 30_000 + "x", 1)])
def test_broken_and_deep_pages_cost_what_they_are_long(page, n):
    began = time.process_time()
    found = htmltext.sequence(htmltext.blocks(page))
    assert len(found) == n and time.process_time() - began < 10
    assert sum(map(len, found.added)) <= 4  # the path's distinct words, once


def test_blocks_of_odd_markup():
    texts = lambda p: [(b.text, b.linked) for b in htmltext.blocks(p)]
    assert texts("a < b <p>c<a href='x>y'>d</a></p>e") == [("a < b", 0), ("cd", 1), ("e", 0)]
    assert texts('<p title="never closed>a</p><p>b') == [('<p title="never closed>a', 0), ("b", 0)]
    assert texts("<!-- a -->b<!-- c") == [("b", 0)] and texts("<!a>b<!c") == [("b", 0)]
    assert texts("<div>a<p>b<p>c</div></p>d") == [("a", 0), ("b", 0), ("c", 0), ("d", 0)]
    inner = htmltext.blocks("<div class='a'><p class='a b'>x")[0].path
    assert (inner.fresh, inner.last, inner.words, inner.around.fresh) == (["<p>", "b"], "b", 5, ["<div>", "a"])


def test_gradients_of_the_network():
    pages = htmltext.training_sequences(["<p>one two three</p><p>four five</p>"], rounds=2)
    model = htmltext.Labeller.new(hidden=3, path_size=3, word_size=2)

    def loss():
        total, n = 0.0, 0
        for s, p in zip(pages, model.chance(pages)):
            total -= (s.label * np.log(p) + (1 - s.label) * np.log(1 - p)).sum()
            n += len(s)
        return total / n

    grad, r = model.gradients(pages), np.random.default_rng(0)
    for name, w in model.weights.items():
        flat = np.flatnonzero(np.abs(grad[name].ravel()) > 1e-9)
        for k in r.choice(flat, min(6, len(flat)), replace=False):
            at = np.unravel_index(k, w.shape)
            keep = w[at]
            w[at] = keep + 1e-5
            up = loss()
            w[at] = keep - 1e-5
            down = loss()
            w[at] = keep
            assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-5


# --- WARC -----------------------------------------------------------------------------------------------------------


def test_loser_tree_merges():
    r = random.Random(2)
    for n in range(12):
        runs = [sorted(r.randrange(30) for _ in range(r.randrange(8))) for _ in range(n)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_archives_round_trip(spark):
    pages = [(5, "http://B.example.com/x", "<p>ä €</p>"), (3, "http://a.example.com/", "same\r\n\r\nWARC/1.1\r\n"), (9, "https://www.a.example.com/", "same\r\n\r\nWARC/1.1\r\n"), (4, None, "same\r\n\r\nWARC/1.1\r\n"), (7, "bad url [", None), (8, "u\r\nx: y", ""), (9, "again", "other"), (2**60 + 1, "z", "x" * 300_000), (None, "n", "no id")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"record_type": F.lit("x"), "run": F.lit(1), "payload_digest": F.lit("y")})
    index = warc.archive_index(df).orderBy("range", "position").collect()
    keys = [(r["url_key"], r["captured"], r["record_id"]) for r in index]
    assert keys == sorted(keys) and len(index) == len(pages)
    ids = [r["record_id"].removeprefix("urn:page:") for r in index]
    assert sorted(ids) == sorted("" if p is None else str(p) for p, _, _ in pages)
    for r in index:
        same = [h for p, u, h in pages if ("" if p is None else str(p)) == r["record_id"].removeprefix("urn:page:")]
        assert r["payload_digest"] in {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for h in same}
    kinds = {(r["record_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in index}
    assert kinds["urn:page:9", 18] == kinds["urn:page:4", 18] == ("revisit", "urn:page:3") and kinds["urn:page:3", 18] == ("response", None)
    assert kinds["urn:page:8", 0] == ("revisit", "urn:page:7")
    assert warc.archive_index(df.limit(0)).count() == 0
    assert {r["record_type"] for r in warc.archive_index(df, least_bytes=10**9).collect()} == {"response"}


def test_capture_histories_in_small_ranges(spark):
    """Repeated URLs on several days, repeated lines, and lines that all agree: in order, none lost, ranges of any size."""
    r = random.Random(4)
    pages = [(k, f"http://h{r.randrange(3)}.org/{r.randrange(4)}", f"p{r.randrange(50)}", f"2024-0{r.randrange(1, 9)}-01T00:00:00Z") for k in range(300)] + [(1000, "http://same.org/", "x", None)] * 200
    df = spark.createDataFrame(pages, "page_id long, url string, html string, day string").repartition(6)
    where = warc.write_archives(warc.revisits(warc.with_digests(df, key="page_id", url="url", html="html", captured="day")), warc.scratch(spark, "test"))
    runs = warc.sorted_runs(warc.index_lines(spark, where))
    found = warc.merged_index(runs, range_rows=40).orderBy("range", "position").collect()
    keys = [(x["url_key"], x["captured"], x["record_id"]) for x in found]
    assert keys == sorted((warc.url_key(u), d or warc.FIRST_CAPTURE, f"urn:page:{p}") for p, u, _, d in pages)
    assert max(collections.Counter(x["range"] for x in found).values()) < 160
    assert sorted((x["record_id"], x["payload"]) for x in warc.read_archives(spark, where).where("record_type = 'response'").collect())[0][1].startswith(b"p")


def test_query_with_a_page_without_an_id(spark, tmp_path):
    from millrace.llm import queries

    spark.createDataFrame([(None, "http://a.org", "x"), (2, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {(r["page_id"], r["record_type"]) for r in queries.op9_warc(spark, str(tmp_path)).collect()} == {(None, "response"), (2, "response")}


def test_broken_archives():
    import io

    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert len(list(warc.parse_records(io.BytesIO(good * 2)))) == 2
    for bad in (good[:-2], b"x" + good, good[:-8]):
        with pytest.raises(ValueError):
            list(warc.parse_records(io.BytesIO(bad)))


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/A?b=C#d") == "com,example)/a?b=c"
    assert warc.url_key("https://x.example.com:8443") == "com,example,x:8443)/"
    assert warc.url_key(None) == ")/"


# --- quality --------------------------------------------------------------------------------------------------------


def test_quality_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality.fit(docs.where(~held), labels.where(~held))
    told = quality.score(docs.where(held), model).join(labels, "doc_id")
    assert told.where("(score >= 0.7) = (quality = 1)").count() >= 0.9 * told.count()
    odd = docs_of(spark, ODD, extra=True)
    found = quality.score(odd, model).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    none = quality.fit(docs.limit(0), labels)
    assert {r["score"] for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(odd.limit(0), model).count() == 0


def test_dual_descent_separates():
    r = np.random.default_rng(0)
    rows = [np.sort(r.choice(50, 8, replace=False)).astype(np.int32) for _ in range(200)]
    y = np.array([1.0 if (row < 25).mean() > 0.5 else -1.0 for row in rows])
    values = [np.ones(len(row)) for row in rows]
    w = quality.dual_descent(rows, values, y, 50, cost=np.full(200, 10.0))
    assert np.mean([np.sign(w[row].sum() + w[50]) == t for row, t in zip(rows, y)]) > 0.97


def test_languages_of_a_batch_are_told_in_little_memory():
    """A batch of texts is worked on in groups, so that several workers fit beside the heap; before, 60 MB at once."""
    import tracemalloc

    import numpy as np
    from millrace.llm import langid

    model = langid.LanguageFilters(["a", "b"], np.arange(1 << 20, dtype=np.uint64).reshape(-1, 1) % 4, 20, 2, (3, 4))
    texts = [f"some words of text number {i} " * 20 for i in range(1500)]
    alone = [langid.score_texts(model, [t]) for t in texts[:5]]
    tracemalloc.start()
    names, scores = langid.score_texts(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6 and [(n, s) for n, s in zip(names[:5], scores[:5])] == [(n[0], s[0]) for n, s in alone]
