"""Made-up prose for tests of this folder."""

WORDS = "the of and river stone window garden letter market silver winter people moment answer number colour little always before between".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "er", "ing"]) for _ in range(n))


def edited(rng, text, every):
    words = text.split(" ")
    for i in range(rng.randrange(every), len(words), every):
        words[i] = rng.choice(WORDS).upper()
    return " ".join(words)
