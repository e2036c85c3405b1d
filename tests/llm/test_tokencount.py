import public_tokenizers
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from panelmart.llm.tokencount import Counter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
OURS = Counter(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def brute(rows):
    return sorted(((r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 1024)
                   for r in rows), key=str)


def test_given_table(docs):
    assert sorted(map(tuple, count_tokens(docs).collect()), key=str) == brute(docs.collect())


def test_odd_rows(odd_docs, no_docs, clashing):
    assert sorted(map(tuple, count_tokens(odd_docs).collect()), key=str) == brute(odd_docs.collect())
    assert count_tokens(no_docs).count() == 0
    assert count_tokens(clashing).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    assert OURS.counts(texts) == [library(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r  ab'sé1.,<|>"), max_size=30))
def test_blanks_and_marks(text):
    assert OURS.counts([text]) == [library(text)]


def test_runs():
    texts = ["a" * n for n in range(70)] + [" " * n + "b" for n in range(20)] + ["ab" * 3000, "<|endoftext|>x"]
    assert OURS.counts(texts) == [library(t) for t in texts]
