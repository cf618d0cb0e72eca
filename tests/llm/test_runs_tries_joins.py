"""Periodic runs, prefix tries and the n-gram join against brute force, and on odd input."""

import random
import zlib

import numpy as np
import pytest
from llm_cases import EXTRA, WORD, corpus, frame, near_duplicates, periodic_runs, prefix_trie
from tablegauge.llm import periodic_runs as runs_op
from tablegauge.llm import prefix_join, prefix_trie as trie_op


def _repetitive(rng, alphabet, length):
    words = [rng.randrange(alphabet) for _ in range(length)]
    for _ in range(rng.randint(0, 3)):
        piece = [rng.randrange(alphabet) for _ in range(rng.randint(1, 30))]
        at = rng.randint(0, len(words))
        words[at:at] = (piece * rng.randint(2, 9))[: rng.choice([None, -1])]
    return words


@pytest.mark.parametrize(("min_words", "exponent"), [(24, 3), (6, 3), (9, 5)])
def test_runs_equal_brute_force(min_words, exponent):
    rng, found = random.Random(min_words), 0
    for _ in range(80):
        texts = [_repetitive(rng, rng.choice([1, 2, 3, 10, 50]), rng.choice([0, 1, 23, 24, 60, 200])) for _ in range(rng.randint(1, 6))]
        got = runs_op.runs_of([np.array(t, dtype=np.int64) for t in texts], min_words, exponent)
        for text, run in zip(texts, got):
            want = periodic_runs(text, min_words, exponent)
            assert list(zip(*(x.tolist() for x in run))) == want
            found += len(want)
    assert found > 100


def test_common_words_are_exact():
    rng = random.Random(4)
    for alphabet in (1, 2, 5):
        body = [rng.randrange(alphabet) for _ in range(300)] * 2
        grammar = runs_op.Grammar(np.array([90, *body, 91]))
        i = np.array([rng.randrange(1, 600) for _ in range(200)])
        j = np.array([rng.randrange(x + 1, 602) for x in i.tolist()])
        text = [90, *body, 91]
        for step in (1, -1):
            got = grammar.common(i, j, step)
            for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
                want = 0
                while text[a + want if step > 0 else a - 1 - want] == text[b + want if step > 0 else b - 1 - want]:
                    want += 1
                assert n == want
    # Levels get shorter by a constant factor, or the climb would be long.
    grammar = runs_op.Grammar(np.array([10**6, *(rng.randrange(1000) for _ in range(20_000)), 10**6 + 1]))
    assert len(grammar.level(20)[1]) < 2000


def _collapsed(text, min_words=24):
    words = WORD.findall(text or "")
    runs = periodic_runs(words, min_words, 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_odd_texts(spark):
    rows = corpus(seed=3, n=30, words=120)
    rows += [(900 + i, t) for i, t in enumerate(["no " * 24, "no " * 23, "a b " * 12 + "a", "é ü é ü\t" * 20, "x" * 1_000_000])]
    # One long text: the repeated part is found whole.
    rows.append((990, " ".join(f"w{i}" for i in range(5000)) + " ab cd ef" * 30_000))
    got = runs_op.periodic_runs(frame(spark, rows)).collect()
    assert len(got) == len(rows) + 3
    want = {}
    for doc, text in [*rows[:-1], (None, "no id of mine, but words")]:
        want[doc] = _collapsed(text)
    want[990] = [(5000, 90_000, 3)], " ".join(f"w{i}" for i in range(5000)) + " ab cd ef"
    for row in got:
        assert ([(r.start, r.length, r.period) for r in row.runs], row.kept_text) == tuple(want[row.doc_id])
    assert sum(bool(r.runs) for r in got) == 6
    assert runs_op.periodic_runs(frame(spark, [], extra=False)).collect() == []
    white = frame(spark, [(1, " " * 3_000_000)], extra=False)
    assert runs_op.periodic_runs(white).collect()[0].asDict() == {"doc_id": 1, "runs": [], "kept_text": ""}


def _conversations(rng, n):
    """(conv_id, turn, role, text) with shared beginnings, copies, null fields and turns of equal number."""
    rows = []
    for conv in rng.sample(range(n * 2), n):
        for turn in range(rng.choice([1, 2, 3, 3, 5, 9])):
            rows.append((conv, turn or None, rng.choice(["user", "bot", None]) if turn > 2 else "user", rng.choice(["hi", "hi there", None, "well  then\nyes"])))
    rows.append((rows[0][0], 1, "bot", "twice"))
    return rows


def _own(rows):
    """conv_id -> turns in order; turns of equal number by the digest of their content."""
    import hashlib

    out = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        out.setdefault(conv, []).append((turn is not None, turn or 0, name, len(WORD.findall(text))))
    return {c: [(name, words) for _, _, name, words in sorted(turns)] for c, turns in out.items()}


def _trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 7), (3, 40)])
def test_trie_equals_brute_force(spark, seed, parts):
    rows = _conversations(random.Random(seed), 60)
    rows += [(500 + i, 1, "user", "hi") for i in range(40)]  # one very common conversation
    frame_of = spark.createDataFrame([(*r, 1, 2, "w", "c", "d", 3, "s") for r in rows + rows[:2] + [(None, 1, "user", "lost")]], f"conv_id long, turn long, role string, text string, {EXTRA}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        own = trie_op.sequences(frame_of)
        want = _own(rows + rows[:2])
        assert _trie_rows(trie_op.prefix_trie(own)) == prefix_trie(want)
        built = {}
        for conv, turns in want.items():
            h = zlib.crc32(str(conv).encode()) % 4
            built[conv] = want.get(conv - conv % 20, [])[:h] + turns[h:]
        assert any(not t for t in built.values())
        assert _trie_rows(trie_op.prefix_trie(trie_op.rebuilt(own, block=20, most=4))) == prefix_trie(built)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_nothing_and_of_a_long_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie_op.prefix_trie(trie_op.sequences(spark.createDataFrame([], schema))).collect() == []
    rows = [(c, t, "user", "a b") for c in (1, 2) for t in range(3000)] + [(3, 0, None, "z " * 400_000)]
    got = trie_op.prefix_trie(trie_op.sequences(spark.createDataFrame(rows, schema))).collect()
    assert len(got) == 3002
    root = next(r for r in got if r.depth == 0)
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens, root.parent_conv_id) == (3, 2, 2, 6000, None)


def _family(rng, n, words, changes):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.choice(changes)):
            text[rng.randrange(words)] = f"x{rng.randrange(40)}"
        texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (1, 60)])
def test_join_equals_brute_force(spark, words, percent):
    rng = random.Random(words)
    rows = corpus(seed=5, n=70, words=60)
    # Families of near copies; one without the text that it stems from.
    texts = _family(rng, 50, 70, [0, 1, 1, 2, 3]) + _family(rng, 40, 60, [1, 2])
    rows += [(1000 + i, t) for i, t in enumerate(texts)]
    got = prefix_join.similar_documents(frame(spark, rows), words, percent).collect()
    want = near_duplicates(rows, words, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len(got) == len(rows) + 3
    assert 10 < len({c for _, c in want.values()}) < len(want) - 30


def test_join_of_nothing_and_of_long_texts(spark):
    assert prefix_join.similar_documents(frame(spark, [], extra=False)).collect() == []
    assert prefix_join.similar_documents(frame(spark, [(1, None), (2, ""), (3, " \n")], extra=False)).count() == 3
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, long), (4, long + " more"), (3, "z" * 1_000_000), (2, " " * 2_000_000), (1, "z" * 1_000_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.similar_documents(frame(spark, rows, extra=False)).collect()}
    assert got == {5: (59_997, 4), 4: (59_998, 4), 3: (1, 1), 2: (0, 2), 1: (1, 1)}


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefix_bounds(spark, percent):
    """`needed` is the least overlap, and a prefix leaves room for just one n-gram fewer."""
    from pyspark.sql import functions as F

    sizes = spark.range(1, 60).select(F.col("id").alias("n")).join(spark.range(1, 60).select(F.col("id").alias("m")), F.col("m") >= F.col("n"))
    cols = [prefix_join.needed(F.col("n"), F.col("m"), percent), prefix_join.probe_length(F.col("m"), percent), prefix_join.index_length(F.col("n"), percent)]
    for n, m, least, probe, index in sizes.select("n", "m", *cols).collect():
        enough = [o for o in range(m + n + 1) if 100 * o >= percent * (n + m - o)]
        assert least == enough[0]
        if least <= n:  # a pair that can be similar
            assert m - least + 1 <= probe and n - least + 1 <= index <= n
