"""Small tables with every awkward case, and brute-force versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_texts() -> list[str | None]:
    """Nulls, blanks, long texts, odd white space, copies, marks of tokenizers."""
    pick = random.Random(5)
    vocabulary = ["the", "of", "café", "naïve", "Übung", "x1", "don't", "42", "日本語", "🙂", "a-b"]
    texts: list[str | None] = [
        None, "", " ", "\n", "\n\n\n", "  two  spaces ", "tab\tand\r\nline", "a \n b", "trail ",
        "<|endoftext|> is text", "'s 'll don't", " no-break em", "x" * 5000,
        "no\u0000nul", "line\n\nline\n", "A b C", "a B c", "end\n ",
    ]
    for n in (1, 2, 3, 10, 60, 400):
        texts.append(" ".join(pick.choice(vocabulary) for _ in range(n)))
    long = " ".join(f"w{pick.randrange(5000)}" for _ in range(20_000))
    return [*texts, long, long + " more", *texts[:8]]


def documents(spark, texts=None, start=0):
    """A documents table; every seventh source and language is null."""
    texts = awkward_texts() if texts is None else texts
    rows = [
        (start + i, t, None if i % 7 == 3 else "en", None if i % 7 == 5 else f"src{i % 3}", i)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC)


def empty(spark):
    return spark.createDataFrame([], DOC)


def shingle_set(text: str | None, words: int) -> frozenset:
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False))


def brute_components(texts: dict, words: int, percent: int) -> dict:
    """Least linked id of every document, comparing all pairs."""
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}
