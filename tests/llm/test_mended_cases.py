"""Clashing names, repeated ids, odd letters and independent versions of operators 1, 3, 4, 7 and 8."""
import datetime
import hashlib
import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

public_tokenizers = pytest.importorskip("public_tokenizers")

from losslens.llm import decontaminate as D  # noqa: E402
from losslens.llm import byte_bpe, pseudonyms, quality_rules, token_files, toxicity  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# 1 quality rules ---------------------------------------------------------------------------------------------------

def labelled(spark, strata=3, n=900):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < .7
        w = [f"w{rng.randint(0, 99)}" for _ in range(30)]
        for k in range(0 if good else 12):
            w[k] = "%%#" + w[k]
        rows.append((i, " ".join(w), f"s{i % strata}", "own", 7))
        labels.append((i, int(good), 0))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, label_id string, cut_salt long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_columns_may_clash(spark):
    docs, labels = labelled(spark, 1)
    docs = docs.withColumns({"row": F.lit("r"), "cut": F.lit(1), "stratum": F.lit("x"), "kept": F.lit(False)})
    out = quality_rules.keep(docs, labels)
    assert out.columns == docs.columns
    want = {r.doc_id for r in quality_rules.quality_rules(docs, labels).where("kept").collect()}
    got = out.collect()
    assert {r.doc_id for r in got} == want and 0 < len(want) < 900
    assert all(r.label_id == "own" and r.cut == 1 and r.kept is False for r in got)


def test_many_strata_are_salted(spark, monkeypatch):
    docs, labels = labelled(spark)
    few = {(r.doc_id, r.kept, tuple(r.failed_rules)) for r in quality_rules.quality_rules(docs, labels).collect()}
    monkeypatch.setattr(quality_rules, "STRATA", 0)
    assert {(r.doc_id, r.kept, tuple(r.failed_rules)) for r in quality_rules.quality_rules(docs, labels).collect()} == few


def test_cutoffs_are_those_of_a_plain_loop(spark):
    """Every candidate tested with an exact tail, from the laxest down to the first that fails."""
    from fractions import Fraction
    from math import comb
    docs, labels = labelled(spark, 2, 1600)
    good = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality_rules.quality_rules(docs, labels).collect() if not r.base_failed]
    m = quality_rules.with_base(quality_rules.text_measures(docs))
    got = {(r.stratum, r.rule): r.cutoff for r in quality_rules.certified_cutoffs(m, labels).collect()}
    value = {"symbols": lambda r: r.n_symbols / max(r.word_chars, 1), "repeats": lambda r: r.n_repeat_words / max(r.n_words, 1),
             "dup_lines": lambda r: r.n_dup_lines / max(r.n_lines, 1)}
    strata = sorted({r.stratum for r in rows})
    rate = Fraction(quality_rules.ALPHA / 3)
    want = {}
    for s in strata:
        for rule, (_, step) in quality_rules.RULES.items():
            held = [(value[rule](r), good[r.doc_id]) for r in rows if r.stratum == s]
            n, best = sum(y for _, y in held), None
            for i in range(quality_rules.STEPS - 1, -1, -1):
                beyond = [y for v, y in held if min(quality_rules.STEPS, int(np.ceil(v / step))) > i]
                k, bad = sum(beyond), len(beyond) - sum(beyond)
                tail = 1 if k >= n * rate else sum(comb(n, j) * rate**j * (1 - rate)**(n - j) for j in range(k + 1))
                if tail > quality_rules.DELTA / (3 * len(strata)):
                    break
                gain = bad - quality_rules.GOOD_WEIGHT * k
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, i * step
            if best:
                want[s, rule] = pytest.approx(best[1])
    assert got == want and want


# 3 token files -----------------------------------------------------------------------------------------------------

def test_word_encoder_at_every_letter(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD_BPE)
    letters = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    rnd = random.Random(3)
    texts = [x + m for x in letters for m in (",", "'")] + [f"a{x}{rnd.choice('.,!)')}{rnd.choice('-;')}" for x in letters]
    texts += ["İ,", "İİ.İ", "İstanbul, İ!", "ǅ̇,", "İ̇,;"]
    flat, sizes = token_files.WordEncoder(WORD_BPE).encode(texts)
    for t, got, e in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == e.ids + [token_files.END_ID], t


# 4 byte-level BPE --------------------------------------------------------------------------------------------------

def test_byte_bpe_encodes_once(spark):
    df = spark.createDataFrame([(1, "some text", [5]), (2, None, None)], "doc_id long, text string, ids array<int>")
    out = byte_bpe.encode_and_decode(df, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    out = out.select("doc_id", "decoded", *byte_bpe.digests(out))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("both(text") == 1
    assert {r.doc_id: bytes(r.decoded) for r in out.collect()} == {1: b"some text", 2: b""}


# 7 toxicity --------------------------------------------------------------------------------------------------------

def test_one_row_of_each_id_is_learned(spark):
    rows = [(i, "vile word " + str(i) if i % 2 else "fine word " + str(i)) for i in range(40)]
    ids = [i for i, _ in rows if i % 4]
    docs = spark.createDataFrame(rows + [(1, f"again {k}") for k in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    picked = toxicity.learning_sample(docs, labels)[0]
    assert picked.count() <= len(ids)
    assert picked.count() == labels.where(toxicity.learning_rows()).count()
    assert toxicity.learn(docs, labels) == toxicity.learn(docs.repartition(7), labels)


# 8 pseudonyms ------------------------------------------------------------------------------------------------------

KEY = "it's a \\ key"


def keyed(*parts):
    return int(hashlib.sha256("|".join([KEY, *map(str, parts)]).encode()).hexdigest()[:12], 16)


def residues(a, b, na, nb, kind):
    for r in range(1, 9):
        a, b, na, nb = b, (a + keyed(kind, r, b)) % na, nb, na
    return a, b


def characters(v, start, stop, kind, hexadecimal=False):
    out, at = list(v), [i for i in range(start, stop) if re.match("[A-Za-z0-9]", v[i])]
    cells = []
    for j, i in enumerate(at):
        n, z = (10, 48) if v[i].isdigit() else (6 if hexadecimal else 26, 97 if v[i].islower() else 65)
        cells.append([i, j, n, z, ord(v[i]) - z])
    a, b = cells[:len(cells) // 2], cells[len(cells) // 2:]
    for r in range(1, 9):
        other = ",".join(str(x[4]) for x in b)
        a, b = b, [[i, j, n, z, (x + keyed(kind, r, j, other)) % n] for i, j, n, z, x in a]
    for i, _, _, z, x in a + b:
        out[i] = chr(z + x)
    return "".join(out)


def plain(v, kind):
    if kind == "ip":
        o = list(map(int, v.split(".")))
        a, b = residues(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, kind)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "ssn":
        area = int(v[:3]) - 1 - (int(v[:3]) > 666)
        a, b = residues(area, (int(v[4:6]) - 1) * 9999 + int(v[7:]) - 1, 898, 99 * 9999, kind)
        return f"{a + 1 + (a >= 665):03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    if kind == "date":
        first = datetime.date(1800, 1, 1)
        day = (datetime.date.fromisoformat(v) - first).days
        a, b = residues(day // 773, day % 773, 189, 773, kind)
        return (first + datetime.timedelta(a * 773 + b)).isoformat()
    if kind == "card":
        moved = characters(v, 0, len(v) - 1, kind)[:-1]
        d = [int(c) for c in moved if c.isdigit()][::-1]
        total = sum(x if i % 2 else 2 * x - 9 * (x > 4) for i, x in enumerate(d))
        return moved + str((10 - total % 10) % 10)
    if kind == "iban":
        w = characters(v, 4, len(v), kind)
        n = int("".join(str(int(c, 36)) for c in w[4:].replace(" ", "") + w[:2] + "00"))
        return f"{w[:2]}{98 - n % 97:02}{w[4:]}"
    if kind == "email":
        return characters(v, 0, v.index("@"), kind)
    if kind == "secret":
        start = len(v) - len(re.search(r"[A-Za-z0-9_+/-]+$", v)[0])
        return characters(v, start, len(v), kind, bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", v[start:])))
    head = re.match(r"[+]\d{1,3}(?=[ .(-])|[+]\d", v)
    return characters(v, len(head[0]) if head else 0, len(v), kind)


def test_pseudonyms_are_a_plain_feistel_network(spark):
    rnd = random.Random(8)
    values = [("ip", ".".join(str(rnd.randint(0, 255)) for _ in range(4))) for _ in range(30)]
    values += [("ssn", f"{rnd.choice([1, 123, 665, 667, 899]):03}-{rnd.randint(1, 99):02}-{rnd.randint(1, 9999):04}") for _ in range(30)]
    values += [("date", (datetime.date(1800, 1, 1) + datetime.timedelta(rnd.randint(0, 146096))).isoformat()) for _ in range(30)]
    values += [("email", f"{rnd.choice(['ann', 'B.b', 'x_9'])}{rnd.randint(0, 99)}@host.example") for _ in range(20)]
    values += [("secret", f"token={rnd.choice(['DEADBEEF09', 'abcXYZ123_-', '0a1b2c3d4e'])}{rnd.randint(0, 9)}") for _ in range(20)]
    values += [("phone", f"+49 {rnd.randint(100, 999)} {rnd.randint(1000, 9999)}") for _ in range(20)]
    values += [("card", "4111-1111-1111-1111"), ("card", "5500005555555559"), ("iban", "GB82 WEST 1234 5698 7654 32")]
    df = spark.createDataFrame([(i, f"see {v} now") for i, (_, v) in enumerate(values)], "doc_id long, text string")
    for r in pseudonyms.pseudonymize(df, KEY).collect():
        kind, v = values[r.doc_id]
        assert [p.kind for p in r.private] == [kind], v
        assert r.text == f"see {plain(v, kind)} now"


def test_pseudonyms_and_other_columns(spark):
    df = spark.createDataFrame([(1, "a 123-45-6789", "mine", "also")], "doc_id long, text string, private string, private_ string")
    out = pseudonyms.pseudonymize(df, "k")
    assert out.columns == ["doc_id", "text", "private", "private_", "private__"]
    r = out.first()
    assert r.private == "mine" and r.private_ == "also" and r.private__[0].kind == "ssn" and r.text != "a 123-45-6789"
    assert pseudonyms.pseudonymize(df, "k", found_col=None).columns == df.columns
    with pytest.raises(ValueError, match="key"):
        pseudonyms.pseudonymize(df, "")


# 2 html ------------------------------------------------------------------------------------------------------------

def test_hot_hosts_are_salted(spark, monkeypatch):
    from losslens.llm import html_extract
    page = "<body><div class='main-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, f"http://h{i % 3 // 2}.example/{i}", page.format(i, "word " * (i % 40 + 1), "x y " * (i % 7))) for i in range(90)]
    rows += [(None, None, None), (5, "nohost", ""), (7, "http://h0.example/7", "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("salt", F.lit("own"))
    want = sorted((tuple(r) for r in html_extract.extract_pages(df).collect()), key=repr)
    assert len(want) == len(rows)
    monkeypatch.setattr(html_extract, "PATH_BYTES", 0)
    assert sorted((tuple(r) for r in html_extract.extract_pages(df).collect()), key=repr) == want


# 10 repeated substrings ---------------------------------------------------------------------------------------------

def test_long_runs_of_one_key(spark):
    """Texts of one letter have one key; their segments are counted window by window beyond the bytes of a key."""
    from losslens.llm import exact_substrings
    rnd = random.Random(4)
    texts = ["a" * 3000, "b" + "a" * 1500, "ab" * 400, "a" * 399, "".join(rnd.choice("xyz") for _ in range(900))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(tuple(r) for r in exact_substrings.remove_repeats(df).drop("kept").collect())
    split = sorted(tuple(r) for r in exact_substrings.remove_repeats(df, key_bytes=500).drop("kept").collect())
    assert whole == split
    assert {r[0]: r[2] for r in whole} == {0: 3000, 1: 1500, 2: 800, 3: 0, 4: 0}


def test_planted_passages_by_bytes(spark):
    """Passages of over 50 words in two documents each: those of 400 bytes go whole, shorter ones and clean texts stay."""
    from losslens.llm import exact_substrings
    rnd = random.Random(6)
    say = lambda n: " ".join("".join(rnd.choice("abcdef") for _ in range(rnd.randint(3, 8))) for _ in range(n))
    docs, want = [], []
    for k in range(40):
        size = 399 + k % 2 if k < 20 else rnd.randint(370, 700)
        passage = "x" + say(120)[:size - 2] + "x"
        assert len(passage) == size and len(passage.split()) > 50
        for edge in "<>":  # the bytes around differ
            text = say(30) + edge + passage + edge + say(30)
            docs.append(text)
            want.append((len(text), size if size >= 400 else 0, int(size >= 400),
                         hashlib.sha256((text.replace(passage, "") if size >= 400 else text).encode()).hexdigest()))
    for _ in range(20):
        docs.append(say(200))
        want.append((len(docs[-1]), 0, 0, hashlib.sha256(docs[-1].encode()).hexdigest()))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = exact_substrings.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == [(i, *w) for i, w in enumerate(want)]


# 3 token files, index -----------------------------------------------------------------------------------------------

def test_index_reads_one_key_at_a_time():
    import io
    rng = np.random.default_rng(2)
    for n in (1, 3, 5000):
        h = np.unique(rng.integers(-2**62, 2**62, n))
        values = rng.integers(0, 2**40, (4, len(h)))
        levels = token_files.build_mph(h)
        order = np.argsort(token_files.mph_slots(levels, h))
        raw = token_files.MAGIC + np.array([len(h), len(levels), *map(len, levels)], "<u8").tobytes()
        raw += b"".join(x.tobytes() for x in levels) + b"".join(x.tobytes() for x in token_files.rank_directory(levels))
        raw += b"".join(v[order].astype("<i8").tobytes() for v in values)
        index = token_files.Index(io.BytesIO(raw))
        assert (index.entries(h) == values).all()
        for k in rng.integers(0, len(h), 40):
            assert index.entry(index.slot(int(h[k]))) == values[:, k].tolist()
            if n > 100:
                assert (index.entries(h[k:k + 1])[:, 0] == values[:, k]).all()


def test_one_id_fills_several_shards(spark, monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD_BPE)
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)
    monkeypatch.setattr(token_files, "RUN", 50)
    rows = [(None if i < 60 else 7 if i < 400 else i, f"text {i} of many") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = token_files.new_folder(spark)
    token_files.write_token_files(df, WORD_BPE, folder)
    assert spark.read.parquet(f"{folder}/shards").count() > 3
    keys = token_files.keys_of(df)
    assert keys.count() == 500 and keys.distinct().count() == 500
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in token_files.read_tokens(keys, folder).collect())
    assert [i for _, i, _ in got] == sorted((i for i, _ in rows), key=lambda x: (x is not None, x or 0))
    at = 0
    for start, _, ids in got:
        assert start == at
        at += len(ids) // 4
    want = {np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in rows}
    assert {ids for _, _, ids in got} == want


def test_decontaminate_sums_rows_of_any_size():
    rng = np.random.default_rng(3)
    sizes = [0, 3, 1, D.PLACES + 4500, 0, 8, D.PLACES, D.PLACES + 1] + [5] * 2000
    row = np.repeat(np.arange(len(sizes)), sizes)
    terms = rng.integers(0, 50, len(row))
    table = rng.integers(-9, 9, (50, 6)).astype(np.float32)  # whole numbers: sums are exact
    want = np.zeros((len(sizes), 6), np.float32)
    np.add.at(want, row, table[terms])
    assert np.array_equal(D._project(terms, row, len(sizes), table), want)
    assert not D._project(terms[:0], row[:0], 3, table).any()


def test_decontaminate_sketches_small_batches_together(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 1 << 32, n, dtype=np.uint32) % 3000 for n in rng.integers(0, 90, 64)]
    weight = np.where(np.arange(D.TERMS) % 7, 1.5, 0.0)

    class Sent:
        value = weight

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(D, "TaskContext", Task)
    calls, project = [], D._project
    monkeypatch.setattr(D, "_project", lambda *x: calls.append(1) or project(*x))

    def z(rows):
        batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts[k:k + rows]], pa.binary())], ["words"])
                   for k in range(0, len(texts), rows)]
        out = next(iter(D._sketch(Sent)(iter(batches))))
        return np.concatenate([np.frombuffer(x, np.float32) for x in out.column("z").to_pylist()]).reshape(D.TERMS, -1)

    one = z(1)
    assert len(calls) == 2  # a matrix for all 64 batches, not one for each
    basis, want = D.random_basis() * weight[:, None], np.zeros(one.shape)
    for t in texts:
        for k in range(0, len(t), D.WINDOW):
            on = [w for w in D.terms_of(t[k:k + D.WINDOW]) if weight[w]]
            y = basis[on].sum(0) / (1e-9 + np.sqrt(sum(weight[w] ** 2 for w in on))) ** 2
            for w in on:
                want[w] += y * weight[w]
    assert np.allclose(one, want, rtol=1e-4, atol=1e-4) and np.allclose(one, z(64), rtol=1e-5, atol=1e-5)
