"""The tokenization automaton against brute-force merges and the public library."""
import hashlib
import itertools
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

public_tokenizers = pytest.importorskip("public_tokenizers")

from losslens.llm import merge_automaton, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(WORD_BPE)
    out.no_truncation()
    out.no_padding()
    return out


def merged(symbols, merges):
    """One merge after the other, each from left to right."""
    out = list(symbols)
    for u, v, w in merges:
        i, new = 0, []
        while i < len(out):
            if i + 1 < len(out) and (out[i], out[i + 1]) == (u, v):
                new.append(w)
                i += 2
            else:
                new.append(out[i])
                i += 1
        out = new
    return out


def accepted(symbols, spelled, automaton):
    """All label sequences for the symbols that the automaton accepts."""
    paths = {0: [((), 0)]}
    for end in range(1, len(symbols) + 1):
        paths[end] = []
        for x, s in spelled.items():
            if s == symbols[end - len(s):end] and len(s) <= end:
                for path, state in paths[end - len(s)]:
                    if automaton.has_arc(np.array([state]), np.array([x]))[0]:
                        paths[end].append(((*path, x), int(automaton.after[x])))
    return [list(p) for p, _ in paths[len(symbols)]]


@pytest.mark.parametrize("seed", range(12))
def test_small_merge_lists(seed):
    """Random merges, equal parts and merges that never apply among them."""
    rnd = random.Random(seed)
    spelled = {0: (0,), 1: (1,), 2: (2,)}
    merges = []
    for _ in range(9):
        u, v = rnd.choice(list(spelled)), rnd.choice(list(spelled))
        if len(spelled[u] + spelled[v]) < 7 and spelled[u] + spelled[v] not in spelled.values():
            merges.append((u, v, len(spelled)))
            spelled[len(spelled)] = spelled[u] + spelled[v]
    automaton = merge_automaton.compile_merges(len(spelled), merges)
    for n in range(1, 7):
        for symbols in itertools.product(range(3), repeat=n):
            assert accepted(symbols, spelled, automaton) == [merged(symbols, merges)]


def test_bad_merge_lists_raise():
    with pytest.raises(ValueError, match="two merges"):
        merge_automaton.compile_merges(4, [(0, 1, 3), (1, 2, 3)])
    with pytest.raises(ValueError, match="made later"):
        merge_automaton.compile_merges(5, [(4, 1, 3), (1, 2, 4)])
    with pytest.raises(ValueError, match="kind described"):
        merge_automaton.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def same(texts, library):
    flat, sizes = merge_automaton.encoder(WORD_BPE).encode(texts)
    for t, got, e in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == e.ids, t


def test_encoder_is_the_library(library):
    rnd = random.Random(1)
    alphabet = "ab eiéß\n\t  '1٣日本🙂\x1c\x85  sthe.,!|%ΑΣ́̈<|İǅ᠎​ "
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rnd.choice("abcdefghinorst") for _ in range(rnd.randint(1, 80))) for _ in range(1000)]
    texts += ["", "  ", "a <|endoftext|> b<|startoftext|>'S", "It's 12th. DON'T", "İ,", "ΑΣ ΑΣ.", "é<|endoftext|>́",
              "x" * 3000, "a" * 997 + "!" * 500, "<|endoftext", "́a"]
    same(texts, library)


def test_every_letter_before_a_mark(library):
    letters = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    same([x + m for x in letters for m in ",'"], library)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(merge_automaton, "CACHE", 10)
    rnd = random.Random(5)
    for _ in range(20):
        same(["".join(rnd.choice("abcd é<") for _ in range(40)) for _ in range(5)] + ["<|endoftext|> a"], library)


def test_query_is_the_library(spark, library):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.QUERIES["op12_merge_automaton"](spark, SF).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = library.encode(rows[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    texts = [None, "", " \n ", "same", "same", "<|endoftext|>", "word, Word é. " * 100_000, "9" * 2000]
    rows = [(None if i == 3 else i, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, text2 long")
    out = merge_automaton.encode_and_decode(df, WORD_BPE)
    assert out.columns == ["doc_id", "text", "n_tokens", "text2", "ids", "decoded"]
    got = out.select("text", "ids", "decoded").collect()
    packed = merge_automaton.encode_and_decode(df, WORD_BPE, packed=True).select("text", *merge_automaton.digests())
    assert len(got) == len(rows) == packed.count()
    for r in packed.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    again = out.withColumn("d", merge_automaton.decode_column(merge_automaton.encode_column(out["text"], WORD_BPE), WORD_BPE))
    assert again.where("d <> decoded").count() == 0
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert merge_automaton.encode_and_decode(df.limit(0), WORD_BPE).count() == 0
    clash = merge_automaton.encode_and_decode(df.withColumnRenamed("n_tokens", "ids"), WORD_BPE)
    assert clash.columns == ["doc_id", "text", "text2", "ids", "decoded"] and clash.where("size(ids) > 0").count() == 5
    nulls = spark.sql("SELECT cast(NULL AS array<int>) AS ids")
    assert nulls.select(merge_automaton.decode_column(nulls["ids"], WORD_BPE).alias("t")).first().t == ""
    wrong = spark.sql("SELECT array(70000) AS ids")
    with pytest.raises(Exception, match="outside the vocabulary"):
        wrong.select(merge_automaton.decode_column(wrong["ids"], WORD_BPE)).collect()
