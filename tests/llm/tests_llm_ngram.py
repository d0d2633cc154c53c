"""Brute force and planted texts shared by the near-duplicate tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted((doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(rows))


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"q{rng.randrange(10**6)}"
    return " ".join(words)


def planted(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}é"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):  # groups of edited copies round the threshold
        base = [word() for _ in range(rng.choice([12, 40, 90, 150]))]
        texts += [edited(rng, base, rng.randrange(0, 4)) for _ in range(18)]
    for _ in range(25):  # a passage that many share without being near
        texts.append(" ".join([word() for _ in range(rng.choice([5, 20, 60]))] + passage))
    texts += [" ".join(word() for _ in range(rng.randrange(0, 8))) for _ in range(30)]
    texts += [texts[0]] * 5 + [texts[0].upper(), "", None, " \t\n", "a b", "A  b", "a b c", "x" * 5000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def thue_morse(n, letters="ab", turned=False):
    """Words over two letters on which sums of powers modulo 2**64 agree, for any odd base."""
    return "".join(letters[(i.bit_count() + turned) % 2] for i in range(n))
