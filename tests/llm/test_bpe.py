import hashlib
import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from docs import awkward, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm import bpe, units, words
from tickbars.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def loaded():
    return bpe.loaded(bpe.file_content(vocabulary()))


def ids_of(loaded, texts):
    _, encoder = loaded
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    return [found[a:b].tolist() for _, _, found, edges in encoder.texts(data, offsets) for a, b in zip(edges[:-1], edges[1:])]


CASES = [
    "", " ", "  a", "a  ", " a  b ", "\n\n x\t y  ", "it's we'll  don't 'S", "日本語 テキスト　です", "a  b   c", "🙂🙂 🙂", "x" * 5000,
    " !" * 300, "abc  <|endoftext|>  def<|endoftext|>", "a <b> <c", "<|endoftext", "\r\n\r\n  z", "÷ × é", "1234567 89a", "a" * 257 + " b",
]


def test_cases(loaded, tokenizer):
    assert ids_of(loaded, CASES) == [tokenizer.encode(t, add_special_tokens=False).ids for t in CASES]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aethr  '\n\t1é日<|>#x.  s"), max_size=60), min_size=1, max_size=8))
def test_random_texts(loaded, tokenizer, texts):
    got = ids_of(loaded, texts)
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    vocabulary_, _ = loaded
    assert [vocabulary_.decode(np.array(g, np.int64)).decode() for g in got] == texts


def test_pairs_are_compatible_exactly_if_merging_gives_them_back(loaded):
    v, _ = loaded
    rnd = random.Random(7)
    tokens = list(v.proposed.values())
    some = rnd.sample(tokens, 80) + [v.proposed[t] for t in (b"a", b"aa", b"aaa", b"the", b" the", b"s", b"ing", b" in", b"er")]
    a, b = (np.array(x) for x in zip(*[(x, y) for x in some for y in rnd.sample(some, 25)]))
    merged = [v.merge(v.tokens[x] + v.tokens[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert v.compatible(a, b).tolist() == merged and 0 < sum(merged) < len(merged)


def test_memory_for_pieces_is_bounded(loaded, monkeypatch):
    monkeypatch.setattr(units, "HELD_PIECES", 50)
    texts = [prose(i, 40) for i in range(20)]
    v, _ = loaded
    small = units.Encoder(v.encode_pieces)
    for text in texts:
        data, offsets = words.text_bytes(pa.array([text]))
        small(data, offsets)
        assert len(small.keys) <= 50 or len(small.keys) <= len(set(text.split(" ")))


def test_digests_and_columns(spark, tokenizer):
    rows = awkward()
    want = Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    docs = frame(spark, rows, clashes=True)
    assert Counter(map(tuple, bpe.digests(docs, vocabulary()).collect())) == want
    encoded = bpe.encode(docs, vocabulary(), keep_text=True)
    assert set(encoded.columns) == set(docs.columns)  # the column named ids is replaced
    assert all(tokenizer.decode(r["ids"], skip_special_tokens=False) == (r["text"] or "") for r in encoded.collect())
    assert bpe.digests(frame(spark, []), vocabulary()).count() == 0 and bpe.encode(frame(spark, []), vocabulary()).count() == 0
    assert np.array([v.isascii() for v in bpe.byte_alphabet()]).sum() == 94


def test_long_words_are_proposed_and_verified_like_short_ones(loaded, tokenizer, monkeypatch):
    v, _ = loaded
    rnd = random.Random(3)
    long = ["".join(rnd.choice(["the", "ing", "er", "x", "é", "日"]) for _ in range(n)) for n in (90, 300, 2000)] + ["the" * 400, "-" * 999]
    got = ids_of(loaded, long)
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in long]
    found = [t.encode() for t in CASES + long if t]
    ids, counts = v.encode_words(found)
    for step in (0, 4, 1 << 20):
        monkeypatch.setattr(bpe, "STEP_BYTES", step)
        again, lengths = v.encode_words(found)
        assert again.tolist() == ids.tolist() and lengths.tolist() == counts.tolist()
    redone = []
    monkeypatch.setattr(v, "merge", lambda word: redone.append(word) or [])
    monkeypatch.setattr(bpe, "STEP_BYTES", 8)
    pairs = ([a, b] for a in range(300, 900) for b in range(300, 900) if len(v.tokens[a] + v.tokens[b]) > 8)
    good = (p for p in pairs if v.propose_one(v.tokens[p[0]] + v.tokens[p[1]]) == p and v.compatible(*np.array(p)[:, None])[0])
    a, b = next(good)
    ids, _ = v.encode_words([v.tokens[a] + v.tokens[b]])
    assert ids.tolist() == [a, b] and redone == []


def test_pairs_are_forgotten_when_they_are_many(loaded, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_PAIRS", 20)
    texts = [prose(i, 60) for i in range(6)]
    v, _ = loaded
    small = units.Encoder(v.encode_pieces)
    for text in texts:
        data, offsets = words.text_bytes(pa.array([text]))
        ids = [found.tolist() for _, _, found, _ in small.texts(data, offsets)]
        assert ids == [tokenizer.encode(text, add_special_tokens=False).ids]


@pytest.mark.parametrize(
    "change",
    [
        lambda f: f.update(normalizer={"type": "NFC"}), lambda f: f["pre_tokenizer"].update(add_prefix_space=True),
        lambda f: f.update(pre_tokenizer={"type": "Whitespace"}), lambda f: f["model"].update(ignore_merges=True),
        lambda f: f["model"].update(dropout=0.1), lambda f: f["added_tokens"][0].update(lstrip=True),
        lambda f: f["model"]["vocab"].pop("a"), lambda f: f["model"].update(type="Unigram"), lambda f: f.update(decoder=None),
    ],
)
def test_other_files_are_an_error(change):
    content = bpe.file_content(vocabulary())
    bpe.check_file(content)
    spec = json.loads(content)
    change(spec)
    with pytest.raises(ValueError, match="not a plain byte-level BPE file"):
        bpe.check_file(json.dumps(spec))
