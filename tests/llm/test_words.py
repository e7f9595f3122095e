import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.words import byte_kinds, word_spans, words

from .plainwords import WORD

PIECES = st.sampled_from(["alpha", "\u201calpha\u201d", " ", "\u2014", "naïve", "東京都に住む", "สวัสดี", "हिन्दी", "2024年", "한국어", "x2", "\U0001f600", "\U00020001", "e\u0301", "\u00a0", "-", "\n", "ﾃｽﾄ"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=8).map("".join), min_size=1, max_size=5))
def test_words_are_those_of_the_pattern(texts):
    hashes, cuts = words(pa.array(texts))
    for i, t in enumerate(texts):
        spans = [m.span() for m in WORD.finditer(t)]
        assert word_spans(t) == spans
        own = hashes[cuts[i] : cuts[i + 1]]
        assert len(own) == len(spans)
        for (a, b), h in zip(spans, own):
            assert words(pa.array([t[a:b]]))[0].tolist() == [h]


def test_signs_make_no_words_and_quotes_no_other_word():
    one, two = (words(pa.array([t]))[0].tolist() for t in ("alpha beta", "\u201cAlpha\u201d \u2014 beta\u2026"))
    assert one == two


def test_scripts_without_spaces():
    t = "我们今天去公园散步。天气非常好,大家都很高兴。"
    assert len(words(pa.array([t]))[0]) == 20


def test_long_texts_nulls_and_no_texts():
    rng = random.Random(1)
    t = " ".join(rng.choice(["größe", "über", "w", "語"]) for _ in range(600_000))
    h, c = words(pa.array([None, t, "", t]))
    assert c.tolist() == [0, 0, 600_000, 600_000, 1_200_000] and (h[:600_000] == h[600_000:]).all()
    assert len(words(pa.array([], pa.string()))[0]) == 0 and byte_kinds(np.zeros(0, dtype=np.uint8))[0].tolist() == []
