"""Made-up texts for the tests."""

import random

SF01 = "/root/testdata/sf0.01"


def words(rng, n, stems=("lo", "ra", "mi", "ten", "su", "ke", "va", "Do", "pri", "é")):
    return ["".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(n)]


def sample_texts(seed=1):
    """Texts with NULL, empty, blank, very long, repeated and near-copy rows, a
    shared passage and odd characters."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = " ".join(words(rng, 60))
    out = [None, "", " \t\n", "one", "Two words", "a b c d", "a b c d e", "A B C D E",
           "tab\tand\x0bline\x0cbreaks\r\n", "▁mark and  two  spaces", "你好 мир 𠀀𠀀 \u0000 nul",
           "x" * 9000, " ".join(words(rng, 6000))]
    for k in range(12):
        copy = list(base)
        for _ in range(k // 3):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(9))
        out.append(" ".join(copy))
    for k in range(8):
        out.append(" ".join(words(rng, 20 + k)) + ".\n" + passage + "\n" + " ".join(words(rng, 9)))
    for k in range(25):
        out.append(". ".join(" ".join(words(rng, rng.randint(3, 40))).capitalize() for _ in range(3)))
    out += [out[-1], out[-1], out[-2]]
    return out
