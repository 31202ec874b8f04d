"""Texts for tests."""


def prose(n, seed=0):
    """n words without a pattern, in short sentences."""
    words, state = [], seed * 7919 + 17
    for k in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        words.append("w" + str(state >> 40) + ("." if k % 7 == 6 else ""))
    return " ".join(words)
