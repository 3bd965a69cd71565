"""What workers keep between tasks."""

import random

import public_tokenizers
import pyarrow as pa

from tallyfold.llm import common, packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def test_encoders_go_when_a_worker_turns_to_other_work():
    """An encoder with its words must not stay beside the tasks of other operators; for packing it stays."""
    first = packing._encoder(PATH)
    list(common.lean(lambda batches: iter(batches), "encoders")(iter([])))
    assert packing._encoder(PATH) is first
    list(common.lean(lambda batches: iter(batches))(iter([])))
    assert packing._encoder(PATH) is not first


def test_few_words_are_remembered_and_ids_stay(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéß", k=rng.randrange(1, 9))) for _ in range(900)] + ["İstanbul", "ΑΣ.", "e-mail", "Foo,", "foo", "12,5", "!", "SS"]
    words = [w.title() if i % 3 == 0 else w + "," if i % 7 == 0 else w for i, w in enumerate(words)]
    texts = pa.array([" ".join(rng.choices(words, k=60)) for _ in range(200)] + ["", None])
    want = packing.WordEncoder(PATH).encode(texts, 2)
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    monkeypatch.setattr(packing, "RUN_WORDS", 7)
    small = packing.WordEncoder(PATH)
    got = small.encode(texts, 2)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    assert len(small.words) <= 50 and len(small.older) <= 50
    plain = small.tokenizer
    for i, text in enumerate(texts.to_pylist()[:20]):
        assert got[0][got[1][i] : got[1][i + 1]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]
