"""Small corpora with the awkward cases, and plain versions of the operators."""

import random
import re

DOCUMENTS = "doc_id BIGINT, text STRING, source STRING, row INT, size STRING, position DOUBLE"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def corpus(n=120, seed=1):
    """Random texts with copies, near copies, shared passages, nulls, blanks, a very long
    text, rows that repeat whole, and an id with two texts."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "ΣΑΣ", "don't", "42"]
    passage = " ".join(chance.choices(vocabulary, k=60))
    texts = []
    for i in range(n):
        kind = i % 8
        if kind == 1 and texts:
            texts.append(texts[-1].replace(" ", "  \n") if texts[-1] else texts[-1])
        elif kind == 2 and texts and texts[-1]:
            near = words(texts[-1])
            near[chance.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
        elif kind == 3:
            texts.append(" ".join([*chance.choices(vocabulary, k=20), passage, *chance.choices(vocabulary, k=5)]))
        else:
            texts.append(" ".join(chance.choices(vocabulary, k=chance.randint(1, 150))))
    texts += [None, None, "", " \t\n\x0b", "a", "A", "a b", "b a", passage, passage.upper(), "x" * 50_000]
    texts.append(" ".join(chance.choices(vocabulary, k=20_000)))
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, 1, "9", 0.5) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (7, texts[0], "s1", 1, "9", 0.5), (None, texts[1], "s2", 1, "9", 0.5)]
    chance.shuffle(rows)
    return rows


def components(nodes, links):
    """The least node that each reaches."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least
