"""Small corpora and brute-force versions of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
#: Columns whose names the operators also use inside.
EXTRA = "k1 long, k2 long, w string, cls string, `a.b` string, row int, salt string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def corpus(seed=1, n=60, words=80):
    """(doc_id, text): invented prose with copies, near copies, shared passages, odd white space and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "Ru", "té", "zu", "ß") for b in ("n", "t", "rr", "sol", "x", "ÉE", "p", "q", "vu")]
    texts = []
    for _ in range(n):
        texts.append(" ".join(rng.choice(vocabulary) + (rng.choice(".,") if rng.random() < 0.1 else "") for _ in range(rng.randint(1, words))))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(0, n, 7):
        texts[i] = f"{texts[i]} {passage}\n{texts[(i + 1) % n]}"
    for i in range(3, n, 9):
        near = texts[i - 3].split(" ")
        near[len(near) // 2] = "changed"
        texts[i] = " ".join(near)
    texts[4] = texts[5] = texts[6]
    texts += [None, "", "  \t\n", "one", "One", "x y\x1cz  w", "the " * 90, "ab cd " * 60, (passage + "\n") * 2]
    return list(enumerate(texts))


def frame(spark, rows, extra=True):
    """A table `documents` of (doc_id, text), with a null id, repeated rows and clashing columns if `extra`."""
    schema = "doc_id long, text string"
    if extra:
        rows = [*rows, (None, "no id of mine, but words"), rows[0], rows[0]]
        rows = [(*r, 1, 2, "w", "c", "dot", 3, "s") for r in rows]
        schema += f", {EXTRA}"
    return spark.createDataFrame(rows, schema)


def near_duplicates(rows, width, percent):
    """doc_id -> (shingles, component): links of all pairs."""
    sets = []
    for doc, text in rows:
        w = WORD.findall(lower(text or ""))
        grams = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
        sets.append((doc, grams))
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {doc: (len(grams), find(doc)) for doc, grams in sets}


def without_repeats(rows, window):
    """(n_words, n_removed, kept) of each row, in order."""
    words = [WORD.findall(text or "") for _, text in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def decontamination(rows, items, span):
    """doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated)."""
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for item, text in items:
        w = pattern.findall(lower(text or ""))
        for i in range(max(1, len(w) - span + 1)) if w and item is not None else ():
            windows[tuple(w[i : i + span])].add(item)
    out = {}
    for doc, text in rows:
        w = pattern.findall(lower(text or ""))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if at := windows.get(tuple(w[i : i + size])):
                    found |= at
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def periodic_runs(words, min_words, exponent):
    """(start, length, period) of the runs of a list of words, period by period."""
    least = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(min_words, exponent * q) and i > start:
                least.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in least.items()), key=lambda r: (r[0], r[2]))


def prefix_trie(seqs):
    """Rows of the trie of conv_id -> list of (turn's content, words), from the sets of all prefixes."""
    members = defaultdict(list)
    for conv, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c in convs if len(seqs[c]) == len(prefix))
        out.append(
            (
                min(convs),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(convs),
                sum(len(p) == len(prefix) + 1 for p in below),
                sum(not any(len(o) == len(p) + 1 and o[:-1] == p for o in below) for p in below),
                sum((len(members[p]) - 1) * p[-1][1] for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)
