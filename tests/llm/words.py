"""Made-up text for the tests."""


def sentence(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))
