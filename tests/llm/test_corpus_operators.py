"""Corpus operators against brute force, the public libraries and edge cases."""
import collections
import hashlib
import itertools
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

public_tokenizers = pytest.importorskip("public_tokenizers")

from losslens.llm import (  # noqa: E402
    byte_bpe, chat_format, decontaminate, exact_substrings, html_extract, pseudonyms, quality_rules, simhash,
    suffix_array, token_files, toxicity)

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [None, "", " ", "\n\n", "a", "x" * 3000, "é" * 1200, "one two", "a\x00b", "don't they'll", "\t\x0b tab"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and long texts, null and repeated ids, clashing column names."""
    rows = [(i, t, "t", 1, 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None), (4, "a", "t", 1, 0), (4, "another text", "t", 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, t string, h long, row int") \
        .selectExpr("doc_id", "text", "t AS lang", "t", "h", "row", "h AS w", "row AS found")


# 1 quality rules ---------------------------------------------------------------------------------------------------

def base_brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n, covered = collections.Counter(windows), set()
    for k, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def test_quality_measures(spark, documents, odd):
    rows = [(i, t) for i, t in enumerate(["a b c d e a b c d e", "x " * 40, "l\nl\n \nl", "f\fv\x0bw # <", None, "é ü z"])]
    for df in (documents, odd, spark.createDataFrame(rows, "doc_id long, text string")):
        texts = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r.doc_id].append(base_brute(r.text))
        got = collections.defaultdict(list)
        for r in quality_rules.text_measures(df, stratum_col=None).collect():
            got[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}


def test_binomial_tail(spark):
    from math import comb
    cases = [(0, 10, 0.3), (2, 20, 0.5), (5, 1000, 0.02), (0, 0, 0.1), (30, 40, 0.1), (100, 3000, 0.05)]
    for k, n, p in cases:
        got = spark.sql(f"SELECT {quality_rules.binomial_tail('k', 'n', f'{p}D')} AS x "
                        f"FROM (SELECT {k}L AS k, {n}L AS n)").first().x
        want = 1.0 if n == 0 or k >= n * p else sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert got == pytest.approx(want, rel=1e-9)


def test_quality_cutoffs_are_certified(spark):
    """A rule that separates is used; a stratum with few labels certifies nothing."""
    good, bad = " ".join(f"w{i}" for i in range(30)), " ".join(f"%%{i}#" for i in range(30))
    rows = [(i, good if i % 5 else bad, "aa") for i in range(2500)] + [(9000 + i, good if i % 5 else bad, "bb") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[1] == good), 0) for r in rows], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    assert all(out[i].kept == bool(i % 5) for i in range(2500))
    assert all(r.kept for i, r in out.items() if i >= 9000)
    kept = quality_rules.keep(docs.withColumn("kept", docs["lang"]), labels)
    assert kept.columns == ["doc_id", "text", "lang", "kept"] and kept.count() == sum(r.kept for r in out.values())
    assert quality_rules.quality_rules(docs.limit(0), labels).count() == 0
    none = quality_rules.quality_rules(docs, labels.limit(0))
    assert none.where("kept").count() == len(rows)


# 2 html ------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="page-with-sidebar">
<div class="content-12"><article><h1>Head &amp; line</h1><p>First&nbsp; paragraph <b>bold.<br>next<p>Second<div class="ad">BUY</div>
<form><p>Mail</form><ul><li>one<li>two</ul><!-- c <p>no</p> --><section id=comments><article><p>I like it</article></section>
</article></div><aside class=x>Side</aside></div><div class="cookie-notice">We</div><footer>F</footer></body></html>"""


def test_html_extracts_the_article():
    text, _ = html_extract.extract(PAGE, [])
    assert text == "Head & line\nFirst paragraph bold. next\nSecond\none\ntwo"
    assert html_extract.extract("", []) == ("", None)
    assert html_extract.extract("no markup  at all", [])[0] == "no markup at all"
    assert html_extract.extract("<p>a<!-- open", [])[0] == "a"


def test_html_host_consensus(spark):
    """A page whose article is short follows its host, not its longest box."""
    page = "<body><div class='main-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, "http://h.example/%d" % i, page.format(i, "word " * 40, "x y")) for i in range(20)]
    rows += [(99, "http://h.example/99", page.format(99, "short", "long " * 50)), (None, None, None), (5, "nohost", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {(r.page_id, r.url): r for r in html_extract.extract_pages(df).collect()}
    assert out[99, "http://h.example/99"].text == "short" and out[None, None].text == ""
    assert len(out) == len(rows) and html_extract.extract_pages(df.limit(0)).count() == 0


def html_texts(spark, bodies):
    """Texts of pages of one host with short and long variants of the same layout."""
    df = spark.createDataFrame([(i, "http://h.example/%d" % i, b) for i, b in enumerate(bodies)],
                               "page_id long, url string, html string")
    return [r.text for r in html_extract.extract_pages(df).orderBy("page_id").collect()]


@pytest.mark.parametrize("layout", [
    "<article><header><h1>{a}</h1><p>{b}</p></header><div class=entry><p>{c}</p></div></article>",
    "<article><section class=lead><p>{a}</p><p>{b}</p></section><section class=rest><p>{c}</p></section></article>",
    "<article><section class=a><div class=x><p>{a}</p></div><div class=x><p>{b}</p></div></section>"
    "<section class=b><div class=y><p>{c}</p></div></section></article>",
    "<div class=post><div class=one><p>{a}</p><p>{b}</p></div><div class=two><p>{c}</p></div></div>"])
def test_html_whole_article(spark, layout):
    """No part of an article goes, however its text is spread over boxes."""
    parts = [("head " * 4, "lead " * 8, "body " * (40 + k)) for k in range(12)]
    pages = ["<body><div class=extra><p>x y</p></div>" + layout.format(a=a, b=b, c=c) + "</body>" for a, b, c in parts]
    assert html_texts(spark, pages) == ["\n".join(" ".join(x.split()) for x in p) for p in parts]


@pytest.mark.parametrize("layout", [
    "<body class='single comments-open'><div class=post><p>{a}</p><p>{b}</p></div></body>",
    "<article class='post has-comments'><p>{a}</p><p>{b}</p></article>",
    "<main id=search><p>{a}</p><p>{b}</p></main>",
    "<article><h2 id='related-work'>{a}</h2><p id='notice-1' class=reply>{b}</p></article>",
    "<div class='content ad-free'><p>{a}</p><p>{b}</p></div>",
    "<div class='content sponsor'><p>{a}</p><p>{b}</p></div>",
    "<div class='post comments-open'><p>{a}</p><p>{b}</p></div>",
    "<article><p>{a}</p><section id='search-methods'><div class=x><p>{b}</p></div></section></article>",
    "<div class=post><p>{b}</p><section id='search-methods'><p>{a}</p></section></div>"])
def test_html_words_of_class_do_not_discard_the_article(spark, layout):
    """Nor do comments, adverts and side boxes come in."""
    parts = [("some words " * 12, "other text " * (20 + k)) for k in range(12)]
    rest = ("<div class=sidebar><p>" + "side " * 40 + "</p></div><div id=comments><article class=comment><p>" + "reply " * 300 +
            "</p></article></div><ul class=social><li>share it</ul>")
    pages = []
    for a, b in parts:
        page = layout.format(a=a, b=b).replace("</article>", "<div class=ad>Buy</div><ol class=commentlist><li><p>"
                                               + "mine " * 300 + "</p></ol></article>")
        pages.append(page.replace("</body>", rest + "</body>") if "</body>" in page else f"<body>{page}{rest}</body>")
    first, second = ("b", "a") if layout.index("{b}") < layout.index("{a}") else ("a", "b")
    want = ["\n".join(" ".join({"a": a, "b": b}[x].split()) for x in (first, second)) for a, b in parts]
    assert html_texts(spark, pages) == want
    assert [html_extract.extract(p, [])[0] for p in pages] == want  # without a host's votes


def test_html_query_pages(spark):
    import html
    from losslens.llm import queries
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op2_html(spark, SF).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?p>|</?h1>", body)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


# 3 token files -----------------------------------------------------------------------------------------------------

def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        h = np.unique(rng.integers(-2**62, 2**62, n))
        slots = token_files.mph_slots(token_files.build_mph(h), h)
        assert sorted(slots.tolist()) == list(range(len(h)))


def test_word_encoder_is_the_library():
    from tokenizers import Tokenizer
    library, rnd = Tokenizer.from_file(WORD_BPE), random.Random(1)
    alphabet = "ab eiéß\n\t  '1٣日本🙂\x1c\x85  sthe.,!|%ΑΣ́̈<|"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["", "  ", "a <|endoftext|> b<|startoftext|>", "It's 12th. DON'T"]
    flat, sizes = token_files.WordEncoder(WORD_BPE).encode(texts)
    for got, e in zip(np.split(flat, np.cumsum(sizes)[:-1]), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == e.ids + [token_files.END_ID]


def test_token_files_round_trip(spark, odd, documents):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD_BPE)
    for df in (odd, documents, odd.limit(0)):
        folder = token_files.new_folder(spark)
        token_files.write_token_files(df, WORD_BPE, folder)
        out = token_files.read_tokens(token_files.keys_of(df), folder)
        got = sorted((r.start, r.n_tokens, zlib.crc32(r.ids)) for r in out.collect())
        digests = token_files.read_tokens(token_files.keys_of(df), folder, digest=True)
        assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in digests.collect()) == got
        want = []
        rows = df.select("doc_id", "text").collect()
        for r in rows:
            ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
            want.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        assert sorted(g[1:] for g in got) == sorted(want)
        starts = list(itertools.accumulate((g[1] for g in got), initial=0))
        assert [g[0] for g in got] == starts[:-1]
        ids = [r.doc_id for r in out.orderBy("start").select("doc_id").collect()]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_unknown_key_raises(spark, documents):
    folder = token_files.new_folder(spark)
    token_files.write_token_files(documents, WORD_BPE, folder)
    with pytest.raises(Exception, match="not in index"):
        token_files.read_tokens(spark.sql("SELECT 10000000L AS doc_id, 0L AS ordinal"), folder).collect()


# 4 byte-level BPE --------------------------------------------------------------------------------------------------

def test_byte_bpe_is_tiktoken(spark, odd, documents):
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(BPE),
                                special_tokens={})
    rnd = random.Random(2)
    alphabet = "ab eiéß\n\t  '1٣日本🙂\x1c\x85  sthe.,!|%"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["", "a" * 3000, " " * 500 + "x", "é" * 1500, "   a", "a   "]
    flat, sizes = byte_bpe.Encoder(BPE, public_tokenizers.PATTERN).encode(texts)
    for got, t in zip(np.split(flat, np.cumsum(sizes)[:-1]), texts):
        assert got.tolist() == library.encode_ordinary(t)
    for df in (odd, documents, odd.limit(0)):
        out = byte_bpe.encode_and_decode(df, BPE, public_tokenizers.PATTERN)
        out = out.select("text", "ids", "decoded", *byte_bpe.digests(out))
        for r in out.collect():
            ids = library.encode_ordinary(r.text or "")
            assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (r.text or "").encode()
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


# 5 chats -----------------------------------------------------------------------------------------------------------

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def test_chat_events_fold(spark):
    log = [(1, 0, 1, "message", "user", "hi"), (1, 1, 2, "delta", "assistant", "he"), (1, 1, 3, "delta", None, "llo"),
           (1, 2, 4, "message", "user", "again"), (1, 1, 5, "regenerate", None, ""), (1, 1, 6, "delta", None, "bye"),
           (1, 0, 7, "edit", None, "hey"), (1, 2, 8, "message", "user", "more"), (2, 0, 1, None, None, None)]
    rnd = random.Random(0)
    rnd.shuffle(log)
    got = {r.conv_id: [tuple(m) for m in r.messages]
           for r in chat_format.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == {1: [("user", "hey"), ("assistant", "bye"), ("user", "more")], 2: [("", "")]}
    assert chat_format.fold_events(spark.createDataFrame([], EVENTS)).count() == 0


def test_chat_round_trip(spark):
    rnd = random.Random(3)
    bits = ["<|", "\\", "<|im_end|>\n", "<", "|", "x", "\n", "<|im_sep|>", "\\|", "🙂"]
    rows = [(i // 5, i % 5, rnd.choice(["user", "assistant", "s<|im_sep|>\\", None]),
             "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat_format.parse(chat_format.format_chats(chat_format.message_events(df))).collect():
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3]) for x in rows if x[0] == r.conv_id]


def test_chat_repeated_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None), (None, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(chat_format.message_events(df))).collect()}
    assert out[1].n_turns == 3 and out[None].n_turns == 1 and out[None].loss_chars == 1


# 6 SimHash ---------------------------------------------------------------------------------------------------------

def test_fingerprint_brute():
    import xxhash
    for t in ["", "One", "a b", "A b c d a b c", "x " * 50 + "É y", None]:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        ones = [sum(xxhash.xxh64_intdigest(x.encode(), 42) >> b & 1 for x in s) for b in range(64)]
        assert simhash.fingerprint(t) % 2**64 == sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def test_masks_cover_the_radius():
    masks = [m % 2**64 for m in simhash.covering_masks(3)]
    assert len(masks) == 15
    rnd = random.Random(0)
    for _ in range(3000):
        bits = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(bits & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [4096, 6])
def test_covering_links_find_all_components(spark, bucket):
    """Balls of fingerprints, with buckets that fit and buckets that must be refined."""
    rnd, fps = random.Random(7), {0, 2**63}
    for _ in range(25):
        at = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 25)):
            fps.add(at)
            at ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
    fps = sorted(fps)
    near = {f: {g for g in fps if (f ^ g).bit_count() <= 3} for f in fps}
    group = {}
    for f in fps:
        todo = [f] if f not in group else []
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = f
                todo += near[x]
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    stars = {r.u % 2**64: r.root % 2**64 for r in
             simhash.star_components(simhash.covering_links(nodes, 3, bucket)).collect()}
    root = {f: stars.get(f, f) for f in fps}
    assert len(set(root.values())) == len(set(group.values()))
    assert len({(root[f], group[f]) for f in fps}) == len(set(group.values()))


def test_simhash_odd_rows_and_keep_one(spark, odd):
    out = simhash.simhash_components(odd).collect()
    assert len(out) == odd.count()
    empty = [r for r in out if r.fp == 0]
    assert {r.component_id for r in empty} == {0} and len(empty) >= 4
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 1 and ids.count(4) == 1 and ids.count(None) == 1 and 1 not in ids
    assert simhash.keep_one(odd.limit(0)).count() == 0


def test_simhash_keeps_one_row_of_each_component_of_a_repeated_id(spark):
    say = lambda x: " ".join(f"{x}{k}" for k in range(60))
    rows = [(1, say("a")), (2, say("a")), (2, say("b")), (3, say("b")), (4, say("c")), (4, say("c")), (5, say("d"))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [rows[0], rows[2], rows[4], rows[6]]


# 7 toxicity --------------------------------------------------------------------------------------------------------

def test_forward_backward_brute():
    rng = np.random.default_rng(0)
    for _ in range(10):
        size, emit, w = [5, 3, 1], rng.normal(size=(5, 3)), rng.normal(size=(2, 2))
        share, counts = toxicity.forward_backward(emit, np.array(size), w, True)
        total = np.zeros((2, 2))
        for k, n in enumerate(size):
            z, marginal, pairs = 0, np.zeros(n), np.zeros((2, 2))
            for y in itertools.product((0, 1), repeat=n):
                s = np.exp(sum(emit[t, k] * y[t] for t in range(n)) + sum(w[y[t - 1], y[t]] for t in range(1, n)))
                z, marginal = z + s, marginal + s * np.array(y)
                for t in range(1, n):
                    pairs[y[t - 1], y[t]] += s
            assert np.allclose(marginal / z, share[:n, k])
            total += pairs / z
        assert np.allclose(total, counts)


def test_background_runs_are_exact():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        emit, w, bias = rng.normal(size=n), rng.normal(size=(2, 2)), -0.7
        active = np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False))
        full = np.full(n, bias)
        full[active] = emit[active]
        share, _ = toxicity.forward_backward(full[:, None], np.array([n]), w)
        got = toxicity.active_marginals(emit[active][:, None], (np.diff(active, prepend=-1) - 1)[:, None],
                                        np.array([n - 1 - active[-1]]), np.array([len(active)]), bias, w)
        assert np.allclose(got[:, 0], share[active, 0])


def test_toxicity_learns(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = [rnd.choice(words) for _ in range(60)]
        if toxic:
            for k in rnd.sample(range(60), 3):
                w[k] = rnd.choice(["vileness,", "zzqrot", "zzqmuck"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows + [(None, None), (2000, ""), (0, rows[0][1])], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score_documents(docs, toxicity.learn(docs, lab)).collect()
    assert len(out) == 903
    for r in out:
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            assert (r.score >= 0.3) == (r.doc_id % 6 == 0 and r.doc_id < 900)
            if r.score >= 0.3:
                text = rows[r.doc_id][1]
                assert any(x in text[s.start:s.end] for s in r.spans for x in ("vile", "zzq"))
    empty = toxicity.learn(docs, lab.limit(0))
    assert all(r.score < 1e-6 for r in toxicity.score_documents(docs, empty).collect())
    assert toxicity.score_documents(docs.limit(0), empty).count() == 0


# 8 pseudonyms ------------------------------------------------------------------------------------------------------

def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_pseudonyms_keep_formats(spark):
    texts = ["call +1 (017) 555-7713 190.137.223.204", "4111111111111111 4111-1111-1111-1111 9807915762804490",
             "97.51.17.173 300.1.1.1", "123-45-6789 000-12-1234", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"!',
             "1999-02-28 24.12.1980 2001-02-30", "GB82 WEST 1234 5698 7654 32", "und.34@mail7.example.com, é", None, "", "1. 4.0"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    out = [r for r in pseudonyms.pseudonymize(df, "key").orderBy("doc_id").collect()]
    new = [r.text for r in out]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+", new[0]) and "555-7713" not in new[0]
    a, b, c = new[1].split(" ")
    assert luhn(a) and a == b.replace("-", "") and a != "4111111111111111" and c == "9807915762804490"
    assert new[2].endswith(" 300.1.1.1") and not new[2].startswith("97.51.17.173")
    assert new[3].endswith(" 000-12-1234") and re.match(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4} ", new[3])
    assert re.fullmatch(r'token = "[0-9a-f]{40}"!', new[4]) and new[4] != texts[4]
    assert new[5].endswith(" 2001-02-30") and not new[5].startswith("1999-02-28")
    assert mod97(new[6]) == 1 and new[6][:2] == "GB" and new[6] != texts[6]
    assert re.fullmatch(r"[a-z]{3}\.\d\d@mail7\.example\.com, é", new[7]) and new[7] != texts[7]
    assert new[8:] == texts[8:] and out[0].found == "x" and [p.kind for p in out[1].private] == ["card", "card"]
    assert pseudonyms.pseudonymize(df.limit(0), "key").count() == 0


@pytest.mark.parametrize("make", ["date_format(date_add(date'1950-01-01', cast(id AS int)), 'yyyy-MM-dd')",
                                  "concat('10.0.', id div 256, '.', id % 256)",
                                  "concat('100-', lpad(id % 99 + 1, 2, '0'), '-', lpad(id % 9999 + 1, 4, '0'))",
                                  "concat('a', id, '@x.org')"])
def test_pseudonyms_are_one_to_one(spark, make):
    df = spark.range(3000).selectExpr("id AS doc_id", f"{make} AS text")
    out = pseudonyms.pseudonymize(df, "key")
    assert out.select("text").distinct().count() == df.select("text").distinct().count()
    assert out.where("size(private) = 1").count() == 3000
    again = pseudonyms.pseudonymize(df, key="other")
    assert out.select("text").intersect(again.select("text")).count() < 600


# 9 decontamination -------------------------------------------------------------------------------------------------

def test_word_hashes(monkeypatch):
    texts = ["One, two\nTWO.. (two)", None, "", "!!", "é ''É''", "a b" * 50, "one", "  x  ", "..\x00"]
    plain = [[w for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")
              if (w := re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), x.strip("".join(
                  chr(c) for c in range(128) if not chr(c).isalnum() and c not in range(9, 14) and c != 32))))] for t in texts]
    for piece in (1 << 20, 16):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        monkeypatch.setattr(decontaminate, "_POWERS", lambda: decontaminate._powers(piece))
        got = decontaminate.hash_texts(pa.array(texts, pa.string()))
        pairs = {(w, int(h)) for ws, hs in zip(plain, got) for w, h in zip(ws, hs)}
        assert [len(x) for x in got] == [len(x) for x in plain]
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def test_common_subsequence():
    def brute(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 20))
        assert decontaminate.common_subsequence(a, b)[0] == brute(a, b)


def test_decontamination_finds_passages_and_paraphrases(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7))) for _ in range(2500)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [say(n) for n in (15, 20, 30, 45, 58)]
    rows, want = [], set()
    for d in range(300):
        body = say(rnd.randint(20, 400))
        if d % 10 == 0:
            i = (d // 10) % len(items)
            leak = list(items[i])
            if d % 20 == 0:  # a paraphrase: one word goes, one is put in
                leak[3:5] = say(1)
            at = rnd.randint(0, len(body))
            body[at:at] = [w.upper() + "," if rnd.random() < 0.2 else w for w in leak]
            want.add((d, i))
        rows.append((d, " ".join(body)))
    rows += [(None, None), (1000, ""), (1001, "... !!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(77, None), (78, "")],
                                  "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == want
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_an_item_in_a_third_of_the_documents(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7))) for _ in range(2500)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [say(n) for n in (1, 15, 36, 38, 59)] + [words[:4] * 5]
    for hot in (2, 3, 5):
        rows, want = [], set()
        for d in range(300):
            body = say(rnd.randint(20, 400))
            if d % 3 == 0 or d == 1:
                i = hot if d != 1 else 1
                at = rnd.randint(0, len(body))
                body[at:at] = items[i]
                want.add((d, i))
            if items[0][0] in body:
                want.add((d, 0))
            rows.append((d, " ".join(body)))
        found = decontaminate.contaminated(
            spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_decontamination_finds_what_brute_force_finds(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    usual = [1 / (k + 1) for k in range(len(words))]
    say = lambda n: rnd.choices(words, usual, k=n)
    items, rows = [say(rnd.randint(15, 59)) for _ in range(30)], []
    for d in range(240):
        leak = list(items[d % 30])
        lost = len(leak) - next(k for k in range(60) if not k < decontaminate.LCS * len(leak))
        if d % 3 == 0:  # one block of edits, the answer kept
            at = rnd.randint(0, len(leak) - 5 - lost)
            leak[at:at + lost] = [f"new{k}" for k in range(lost)]
        else:  # the least usual words changed, or words put in besides
            for at in sorted(range(len(leak) - 5), key=lambda k: -words.index(leak[k]))[:lost]:
                leak[at] = f"new{at}" if d % 3 == 1 else f"new{at} more{at}"
        rows.append((d, " ".join(say(rnd.randint(0, 200)) + leak + say(rnd.randint(0, 200)))))
    hashes = lambda texts: decontaminate.hash_texts(pa.array(texts, pa.string()))
    want = set()
    for (d, _), h in zip(rows, hashes([t for _, t in rows])):
        for i, w in enumerate(hashes([" ".join(w) for w in items])):
            for b in range(0, len(h), decontaminate.STEP):
                near = h[max(0, b - len(w)):b + decontaminate.WINDOW + len(w)]
                if np.isin(w, near).sum() >= decontaminate.LCS * len(w) and decontaminate.confirm(w, near) is not None:
                    want.add((d, i))
                    break
    assert len({d for d, _ in want}) > 220
    found = decontaminate.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


# 10 suffix arrays --------------------------------------------------------------------------------------------------

def test_suffix_array_brute():
    rng = np.random.default_rng(0)
    for k in range(120):
        a = rng.integers(1, rng.integers(2, 6), rng.integers(1, 100))
        if k % 3 == 0:
            a = np.tile(a[:max(1, len(a) // 7)], 8)
        t = np.append(a, 0).astype(np.int32)
        text = t.tolist()
        sa = suffix_array.suffix_array(t)
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        before, common = suffix_array.permuted_lcp(t, sa)
        for i, j in zip(sa[:-1], sa[1:]):
            m = 0
            while max(i, j) + m < len(text) and text[i + m] == text[j + m]:
                m += 1
            assert before[j] == i and common[j] == m


def substrings_brute(docs, length):
    raws, count = [(t or "").encode() for _, t in docs], collections.Counter()
    for r in raws:
        count.update(r[i:i + length] for i in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(docs, raws):
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if count[r[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, f in zip(r, gone) if not f)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("segments", [2048, 3])
def test_repeated_substrings_brute(spark, segments):
    rnd = random.Random(5)
    say = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    common = [say(rnd.randint(80, 900)) for _ in range(12)]
    docs = [(i, say(rnd.randint(0, 500)) + rnd.choice(common) + say(rnd.randint(0, 300)) + rnd.choice(common))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "a" * 3000), (103, "ab" * 900), (104, docs[0][1]), (0, docs[0][1]),
             (None, docs[1][1]), (105, say(200) * 9), (106, say(600))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS t", "2 AS key", "3 AS spans")
    got = exact_substrings.remove_repeats(df, max_segments=segments)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == substrings_brute(docs, 400)
    assert exact_substrings.remove_repeats(df.limit(0)).count() == 0


# queries and pipeline ----------------------------------------------------------------------------------------------

def test_registered_queries(spark):
    import __spark_entry__ as entry
    from losslens.llm import queries
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in queries.QUERIES), key=lambda x: int(x[2:]))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_quality_rules", "op6_simhash", "op7_toxicity", "op8_pseudonyms", "op10_suffix_array"):
        assert entry.queries()[name](spark, SF).count() == docs


def test_chat_query_matches_sql(spark):
    import duckdb
    from losslens.llm import queries
    sql = queries.ORACLE_SQL["op5_chat_format"].replace("FROM conversations", f"FROM '{SF}/conversations.parquet'")
    want = duckdb.sql(sql).df().sort_values("conv_id").reset_index(drop=True)
    got = queries.op5_chat_format(spark, SF).toPandas().sort_values("conv_id").reset_index(drop=True)
    assert all((got[c] == want[c]).all() for c in want.columns)


def test_pipeline_stages_brute(spark):
    """Every stage's decision on what its predecessor kept."""
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii_pseudonyms", "byte_level_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, kept = docs.columns, []
    frame = docs
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF).cache()
        kept.append(frame)
    assert all(f.columns == columns for f in kept[:4])
    first = {r.doc_id for r in kept[0].collect()}
    base = {r.doc_id for r in docs.collect() if (b := base_brute(r.text))[0] >= 10 and 100 * b[4] <= 20 * b[0]}
    assert first <= base
    fps = {r.doc_id: simhash.fingerprint(r.text) % 2**64 for r in kept[0].collect()}
    group = {i: i for i in fps}
    for _ in range(10):  # labels settle
        for a, b in itertools.combinations(fps, 2):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                group[a] = group[b] = min(group[a], group[b])
    assert {r.doc_id for r in kept[1].collect()} == {i for i, g in group.items() if i == g}
    assert {r.doc_id for r in kept[2].collect()} <= {r.doc_id for r in kept[1].collect()}
    hashes = lambda texts: decontaminate.hash_texts(pa.array(texts, pa.string()))
    items = hashes([r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    for r in kept[2].collect():
        words = hashes([r.text])[0].tobytes()
        assert not any(i.tobytes() in words for i in items)
    assert all(r.n_chars == len(r.text) for r in kept[3].collect())
    assert kept[4].count() == kept[2].count()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in kept[4].collect())


def test_pipeline_stages_odd_rows(spark):
    import corpus_pipeline
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD_TEXTS)] + [(None, long, None, None, None), (50, long, "x", "s", 1),
                                                                      (50, long, "x", "s", 1), (51, long + " z", "x", "s", 1)]
    for n in (len(rows), 0):
        docs = spark.createDataFrame(rows[:n], DOC)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        out = docs.collect()
        assert sorted((r.doc_id for r in out), key=str) == ([50, None] if n else [])
