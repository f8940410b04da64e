"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns, some named as operators name theirs.
EXTRA = ("row", "_doc", "size", "score", "ids", "gone", "kept", "copies", "cluster")


def documents(seed: int = 5, n: int = 60) -> list[tuple]:
    """Copies, near copies, shared passages and lines, repeats inside a text, nulls, blanks, repeated rows, a long text."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8))) for _ in range(400)]
    words = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    passage, line, base = words(90), "  Shared Line " + words(12) + "\t", words(300)
    rows: list[tuple] = []
    for i in range(n):
        text = words(rnd.randint(1, 250))
        if i % 5 == 0:
            text += "\n" + passage + " " + words(20)
        if i % 4 == 0:
            text += "\n" + (line if i % 8 else line.upper()) + "\n" + words(5) + "\n"
        if i % 7 == 0:
            w = base.split()
            w[rnd.randrange(300)] = words(1)
            text = " ".join(w)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    rows += [
        (100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \n\t ", "en", None, 4), (103, "one", "de", "s1", 3), (104, "One", "de", "s1", 3),
        (105, "a b c", "de", "s2", 5), (106, words(9000), "en", "s3", 1), (107, " ".join(["x"] * 80), "en", "empty", 1), (108, rows[3][1], "en", "s3", 1),
        (108, rows[3][1], "en", "s3", 1), (109, "é" * 900, "fr", "s0", 900), (None, rows[3][1], "en", "s1", 1), (-5, rows[2][1], "en", "s1", 1),
    ]
    return rows


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, size):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k : k + size] for _, b in texts for k in range(len(b) - size + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), sha(kept)))
    return out


def brute_words(rows, size):
    texts = [(i, tuple((t or "").encode().split())) for i, t, *_ in rows]
    seen = Counter(w[k : k + size] for _, w in texts for k in range(len(w) - size + 1))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[w[k : k + size]] > 1:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    w = lower(text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_jaccard(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t, *_ in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for b in range(a):
            j, y = sets[b]
            if i is not None and j is not None and x and y and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        least[find(a)].append(i)
    return [(i, len(x), None if i is None else min(v for v in least[find(a)] if v is not None)) for a, (i, x) in enumerate(sets)]


def brute_lines(rows, min_chars, min_docs):
    key = lambda line: lower(line.strip(SPACE))
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out
