from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from panelmart.llm import nnlspacking as packing

ODD = ["", "a\x1cb", "x  y", "né à Zürich 漢字 🙂", "e ́a Å", "<|endoftext|> in <|endoftext|>text", "ΣΑΣ ς İ'S don't 12",
       " lead", "nbsp 　\x85 end", "ß ﬁ Ǆ 'll", "x" * 3000,
       "DON'T we'LL 'Sup x's's 12a3 <|x|>y a<|startoftext|>b <|ENDOFTEXT|> \x7f \x00 q", "''sss 'd'D'ddd a'm1"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(rows, docs, library, size=4096):
    want, got, bins = defaultdict(list), defaultdict(list), defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append((*library.encode(text or "", add_special_tokens=False).ids, 2))
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
        got[r.doc_id].append((r.doc_tokens, r.start, tuple(ids.tolist())))
        bins[r.sequence_id].append((r.offset, r.length))
    assert got.keys() == want.keys()
    for doc_id, texts in want.items():  # together the pieces are the texts' ids
        assert sorted(x for _, _, ids in got[doc_id] for x in ids) == sorted(x for t in texts for x in t)
        if len(texts) == 1:
            at = 0
            for total, start, ids in sorted(got[doc_id]):
                assert (total, start) == (len(texts[0]), at) and ids == texts[0][at:at + len(ids)]
                at += len(ids)
    for spans in bins.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == size or (at < size and at & (at - 1) == 0)
    assert sum(sum(n for _, n in s) < size for s in bins.values()) <= size.bit_length()


def test_given_table(docs, library):
    rows = packing.pack(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], library)


def test_small_sequences_and_odd_rows(docs, odd_docs, library):
    for table in (docs, odd_docs):
        rows = packing.pack(table, size=256).collect()
        check(rows, [(r.doc_id, r.text) for r in table.collect()], library, 256)


def test_empty_and_clashing(no_docs, clashing):
    assert packing.pack(no_docs).count() == 0
    assert packing.pack(clashing).select("doc_id").distinct().count() == 30


@pytest.mark.parametrize("text", ODD)
def test_ids_of_words_are_those_of_the_text(text, library):
    words = packing.Words("word_bpe_49k.json")
    assert np.frombuffer(words.all_ids([text])[0], words.kind).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(st.characters(codec="ascii"), max_size=40), st.text("aSsTdM'l1 <|.", max_size=40),
                 st.text(st.characters(max_codepoint=0x24f), max_size=40), st.text("aÉéß÷×µª\u0149İıĀāſǅǆΣς\u0301\u00a0 .'s", max_size=30)))
def test_ids_of_any_text(text):
    words = packing.Words("word_bpe_49k.json")
    assert np.frombuffer(words.all_ids([text])[0], words.kind).tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_white_space(library, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 10)
    words, text = packing.Words("word_bpe_49k.json"), "several words in one longtextwithoutblanksatall end " * 20
    assert np.frombuffer(words.all_ids([text])[0], words.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 0)
    assert np.frombuffer(words.all_ids([text])[0], words.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def spots(counts, size):
    p = packing.plan(counts, size)
    return p, [(n, *s) for n in range(1, size + 1) for a in p.address(np.full(counts[n], n), np.arange(counts[n])).tolist()
               for s in p.spans(a, n)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_places_each_token_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    p, placed = spots(counts, 64)
    cells = sorted((s, o + i) for _, _, n, s, o in placed for i in range(n))
    assert len(cells) == len(set(cells)) == sum(lengths) == p.total
    by = defaultdict(int)
    for s, o in cells:
        by[s] = max(by[s], o + 1)
    assert sum(by.values()) == p.total and all(n & (n - 1) == 0 for n in by.values())


def test_lengths_that_combine_are_not_cut():
    counts = np.zeros(4097, int)
    for n, k in ((4096, 5), (3000, 700), (1096, 700), (2048, 10), (100, 90), (300, 90), (112, 90)):
        counts[n] = k
    p, placed = spots(counts, 4096)
    assert p.kept >= 0.97 * counts.sum()
    assert len(placed) - counts.sum() <= 12


def test_solution_is_non_negative_least_squares():
    """Against the solution of the normal equations, where that is positive."""
    counts = np.zeros(9, int)
    counts[[8, 5, 3]] = 40, 30, 30
    mixes = np.array([[8, 0, 0], [5, 3, 0]])
    assert np.allclose(packing.solve(mixes, counts), [40, 30], rtol=0.05)


def test_sequence_length_must_be_a_power_of_two():
    with pytest.raises(ValueError, match="power of two"):
        packing.plan(np.ones(11, int), 10)
