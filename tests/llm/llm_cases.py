"""Texts that operators must survive, shared by the tests of this folder."""

import random

_rng = random.Random(3)
_WORDS = ["the", "of", "grün", "élan", "mañana", "naïve", "don't", "we'll", "日本語", "x1", "42", "über", "end"]


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(_WORDS) + rng.choice(["", "", "", ".", ",", "!"]) for _ in range(words))


ODD = [None, "", " ", "\n\n", "a", "two words", "  lead and trail  ", "  　", "it's 'tis she'll ''s 's",
       "tabs\tand\r\nlines end", "🙂🙂 emoji 👩‍👩‍👧", "İstanbul ΑΣΣ Ångström é", "١٢٣ ⅷ ½ 1234",
       "<|endoftext|> <s>", "x" * 3000, "ab " * 2000, prose(4000, 1)]
