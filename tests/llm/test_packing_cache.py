"""The tokenizer's cache stays within its bound, which the pipeline sets for its own workers."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from daymatrix.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_bounded_cache_gives_the_same_ids():
    words, plain = packing.WordTokenizer(PATH, cache_words=50), Tokenizer.from_file(PATH)
    for k in range(40):
        text = " ".join(f"word{chr(97 + i % 26)}{i * k} the" for i in range(30))
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text), "<u4").tolist() == ids
        known = len(set(text.split()))
        assert len(words.parts) <= 50 + known and len(words.runs) <= 50 + 11 * known


def test_pipeline_bounds_the_cache(monkeypatch):
    seen = {}
    monkeypatch.setattr(corpus_pipeline.queries, "ship", lambda spark: None)
    monkeypatch.setattr(packing, "pack_documents", lambda docs, path, **given: seen.update(given))
    corpus_pipeline.best_fit_packing(None, None, "")
    assert seen["cache_words"] <= packing.CACHE_WORDS // 5
