"""What a worker remembers of the words it has tokenized."""

import public_tokenizers

from shelfmark.llm import packing


def test_words_in_use_are_tokenized_once(monkeypatch):
    """Rare words make the memory of a worker full again and again; one that every text has stays in it."""
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    made, tokenize = [], packing.Encoder.part
    encoder.known.clear()
    encoder.parts.clear()
    monkeypatch.setattr(packing.Encoder, "part", lambda self, p: made.append(p) or tokenize(self, p))
    encoder.parts.function = encoder.part
    texts = [f"Common, {'abcdefghij'[i % 10] * (i + 2)} naïve\n\n{i} it's!" for i in range(30)]
    for text in texts:
        assert list(encoder.encode([text])) == [encoder.whole(text)]
    assert len(set(made)) > 20 and made.count("common") == 1
