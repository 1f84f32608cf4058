"""Tokens of benchmark leaks, read from arrays of characters."""

import random

import numpy as np

from pedalpath.llm import decontaminate


def test_tokens_of_arrays_are_those_of_the_pattern():
    """Arrays of characters give the tokens, kinds and hashes that the pattern and its table give, on odd texts too."""
    rng = random.Random(8)
    bits = ["a", "Z", "USA", "Kg", "kg", "CM", "days", "I", "iPhone", "7", "12", "3.5", ".", ",", ":", "/", "!?", "\n", "%", "$", "$$", "_", " ",
            "  ", "\x00", "\x7f", "-", "'s", "é", "É", "ǅ", "中", "²", "½", "٣", "€", "£", "¥", "°", "\u212a", "ß", "ς", "𝐀", "\u0301", "。", "ª", "Ⓐ"]
    texts = ["", " ", "5%", "$5", "5$$3%", "%5", "1..2", "1.2.3,", ".5", "5.", "a1b2", "$", "x$ 5", "A" * 40_000 + " b", "Hi. The U.S.A. is 3:45/7, ok?"]
    texts += ["5€", "€5", "5°", "°5", "5²", "² m", "ÉA", "Éa", "A中", "\u212ag", "٣.٣"]
    texts += ["".join(rng.choices(bits[:28] if i % 2 else bits, k=rng.randrange(60))) for i in range(6000)]
    known, arrays = decontaminate._Known(), decontaminate._Codes()
    for text in texts:
        for raw in [np.array([*map(ord, text)], dtype=np.uint32)] + [np.frombuffer(text.encode(), dtype=np.uint8)] * text.isascii():
            code, start, end = arrays.of(raw)
            tokens = decontaminate._TOKEN.findall(text)
            assert [text[s:e] for s, e in zip(start, end)] == tokens, text
            assert code.tolist() == [known[t] for t in tokens], text


def test_reading_texts_makes_no_object_a_token(monkeypatch):
    """The pattern is for texts with letters whose lower case is odd; both ways agree."""
    both = [decontaminate.Templates().of(f"Zoë has 12 apples and 3 km to go. Yes {c}".encode()) for c in ("é", "\u0130")]
    assert both[0][0][:-1].tolist() == both[1][0][:-1].tolist() and both[0][1][:-1].tolist() == both[1][1][:-1].tolist()
    assert [both[0][2][i] for i in range(9)] == [both[1][2][i] for i in range(9)]

    class Never:
        def findall(self, text):
            raise AssertionError("read by the pattern")

    monkeypatch.setattr(decontaminate, "_TOKEN", Never())
    assert decontaminate.Templates().of("Zoë has 12 apples".encode())[2][3] == "apples"
    assert decontaminate.Templates().of(b"Ben has 12 apples")[2][0] == "Ben"


def test_short_lines_of_arrays():
    """Lines with as many tokens as a short item, also after long and empty lines, as when each line is read alone."""
    text = "one two\n\nthree. Four\nfive six seven eight\n 9,5 \n\u00e9t\u00e9 a\n12\n3%"
    templates = decontaminate.Templates()
    for t in (text, text.replace("\u00e9", "e")):
        found = list(decontaminate.short_lines(templates, t.encode(), {1, 2}))
        odd = list(decontaminate.short_lines(templates, (t + "\n\u0130 a b c d").encode(), {1, 2}))
        assert found == odd and [(n, at) for n, at, _ in found] == [(2, 0), (2, 2), (1, 8), (2, 9), (1, 11), (2, 12)]
