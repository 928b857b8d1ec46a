import hashlib
import json
import random

import numpy as np
import pytest
from helixframe.llm import bpe
from helixframe.llm.queries import default_tokenizer

from .helpers import documents, empty

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = "aaab  \n\n\t'sdll.,#1234éßÄ中文 \x85\x1c\x1d 　\U0001f600<|endoftext|>²Ⅷ٣\x00\x7f\r\x0b\x0c"


def random_texts(n=3000):
    rng = random.Random(1)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    return out + ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", " <|endoftext|> \n", "a" * 5000, "ab" * 20_000, "it's we'll I'd", "\n\n  \n x"]


def test_ids_are_the_librarys():
    ours = bpe.Bpe(open(default_tokenizer(), encoding="utf-8").read())
    theirs = tokenizers.Tokenizer.from_file(default_tokenizer())
    texts = random_texts()
    for packed, e in zip(ours.encode(texts), theirs.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == e.ids
        assert ours.decode(packed) == theirs.decode(e.ids, skip_special_tokens=False)


def naive(ranks, ids):
    """One word: the lowest rank, leftmost, again and again."""
    while True:
        found = [(ranks[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        if not found:
            return ids
        _, k = min(found)
        ids = [*ids[:k], ranks[ids[k], ids[k + 1]][1], *ids[k + 2 :]]


@pytest.mark.parametrize("seed", range(6))
def test_rules_in_any_order(seed):
    """Also where a merge wakes a lower rank."""
    rng = random.Random(seed)
    letters = {b: c for c, b in bpe.byte_letters().items()}
    vocab = {letters[b]: b for b in range(256)}
    tokens, merges = ["a", "b", "c"], []
    while len(merges) < 25:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if [a, b] not in merges and len(a + b) < 7:
            vocab.setdefault(a + b, len(vocab))
            merges.append([a, b])
            tokens.append(a + b)
    rng.shuffle(merges)
    ours = bpe.Bpe(json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []}))
    ranks = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(400)] + ["aaaaaaa", ""]
    for w, packed in zip(words, ours.merge(words), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == naive(ranks, [ord(c) for c in w])


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 50)
    monkeypatch.setattr(bpe, "MOST_WORDS", 20)
    file = open(default_tokenizer(), encoding="utf-8").read()
    small, large = bpe.Bpe(file), bpe.Bpe(file)
    texts = random_texts(300)
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)
    assert len(small.pieces) < 5000


def test_digests(spark):
    docs = documents(spark)
    theirs = tokenizers.Tokenizer.from_file(default_tokenizer())
    want = []
    for r in docs.collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_and_decode(docs, default_tokenizer()).collect()), key=str) == sorted(want, key=str)
    assert bpe.encoded(docs, default_tokenizer()).count() == docs.count()
    assert bpe.encode_and_decode(empty(spark), default_tokenizer()).count() == 0


def test_other_settings_are_refused(spark):
    with open(default_tokenizer(), encoding="utf-8") as f:
        data = json.load(f)
    bpe.refused(data)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": None}, {"added_tokens": [{"id": 1, "content": "x", "lstrip": True}]}):
        with pytest.raises(ValueError):
            bpe.refused(data | change)
    with pytest.raises(ValueError):
        bpe.refused(data | {"model": data["model"] | {"dropout": 0.1}})
