"""Operators on documents against brute force, with nulls, empty and repeated rows and clashing columns."""

import math
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import llm_cases as cases  # noqa: E402
import public_tokenizers  # noqa: E402
from tablegauge.llm import bbit_minhash, disclosure, recompression, toxicity, training_order, vector_packing, winnowing  # noqa: E402
from tablegauge.llm.queries import RANKS  # noqa: E402

ROWS = cases.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return cases.frame(spark, ROWS).limit(0)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(docs, width):
    rows = bbit_minhash.near_duplicates(docs, words=width).collect()
    assert len(rows) == docs.count()
    expected = cases.near_duplicates(ROWS, width, 80)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (*expected[r.doc_id], expected[r.doc_id][1] == r.doc_id)
    assert sum(e[1] != d for d, e in expected.items()) >= 7  # the corpus does hold copies


def test_one_row_of_each_group_stays(docs):
    kept = bbit_minhash.deduplicated(docs, words=5)
    assert kept.columns == docs.columns
    expected = cases.near_duplicates(ROWS, 5, 80)
    ids = sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect())
    assert ids == sorted(d for d, e in expected.items() if e[1] == d)


def test_near_duplicates_of_a_family_without_a_common_leader(spark):
    """Copies that differ among themselves more than from their origin, and chains of small changes."""
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):
        copy = list(base)
        for j in (3 * i, (7 * i) % 120, (11 * i) % 120, (13 * i) % 120):
            copy[j % 120] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join([*base[: 60 + i], *(f"y{i}_{j}" for j in range(30))])) for i in range(20)]
    found = bbit_minhash.near_duplicates(cases.frame(spark, rows, extra=False), words=2).collect()
    expected = cases.near_duplicates(rows, 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)] + [(100, 99), (100, 100)], "a long, b long")
    found = {r.node: r.root for r in bbit_minhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 65)}, 100: 99}


def test_estimate_is_near_the_similarity(spark):
    rows = [(0, " ".join(f"w{i}" for i in range(400))), (1, " ".join(f"w{i}" for i in range(44, 444)))]
    signed = bbit_minhash.signatures(cases.frame(spark, rows, extra=False), 1, 32, 4)
    a, b = signed.filter("doc_id = 0"), signed.filter("doc_id = 1").select(F.col("sig").alias("other"))
    value = a.crossJoin(b).select(bbit_minhash.estimate(F.col("sig"), F.col("other"), 128).alias("e")).first().e
    assert abs(value - 356 / 444) < 0.15


@pytest.mark.parametrize("window", [35, 12])
def test_repeated_passages_equal_brute_force(spark, docs, window):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = sorted(((d is None, d), *e) for (d, _), e in zip(rows, cases.without_repeats(rows, window)))
    found = recompression.repeated_passages_removed(docs, window).collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in found) == expected
    assert sum(e[2] > 0 for e in expected) > 10


def test_equal_passages_keep_equal_names_inside():
    rng = np.random.default_rng(3)
    rounds, margin = recompression.rounds_for(35)
    shared = rng.integers(0, 2**63, 35).astype(np.uint64)
    parsed = []
    for n in (5, 9):
        words = np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), shared, rng.integers(0, 2**63, n).astype(np.uint64)])
        names, starts = words, np.arange(len(words))
        for k in range(rounds):
            names, starts = recompression.compress_round(names, starts, k)
        ends = np.append(starts[1:], len(words))
        inside = (starts >= n + margin) & (ends <= n + 35 - margin)
        parsed.append([(int(a) - n, int(x)) for a, x in zip(starts[inside], names[inside])])
    assert parsed[0] == parsed[1] and parsed[0]


def test_equal_periodic_passages_keep_equal_names_inside():
    """As above, where the words before the passage decide whether its period is a run of two or of three."""
    rng = np.random.default_rng(4)
    rounds, margin = recompression.rounds_for(35)
    for _ in range(1000):
        a, b, x, *rest = rng.integers(0, 2**63, 32).astype(np.uint64)
        shared, parsed = [a, b, a, b, a, b, *rest], []
        for before in ([x, a], [x]):
            names, starts, n = np.array(before + shared, dtype=np.uint64), np.arange(len(before) + 35), len(before)
            for k in range(rounds):
                names, starts = recompression.compress_round(names, starts, k)
            ends = np.append(starts[1:], n + 35)
            inside = (starts >= n + margin) & (ends <= n + 35 - margin)
            parsed.append([(int(p) - n, int(q)) for p, q in zip(starts[inside], names[inside])])
        assert parsed[0] == parsed[1] and parsed[0]


ITEMS = [
    (1, " ".join(ROWS[10][1].split()[2:24])),
    (2, " ".join(ROWS[12][1].upper().split()[:14])),
    (3, ROWS[63][1]),
    (4, "two words!"),
    (5, None),
    (6, " ... "),
    (None, "no item"),
    (7, " ".join(ROWS[10][1].split()[2:24])),
    (10, " ".join(ROWS[14][1].split()[:70])),
]


@pytest.mark.parametrize("span", [13, 7])
def test_decontamination_equals_brute_force(spark, docs, span, monkeypatch):
    if span == 7:
        monkeypatch.setattr(winnowing, "BLOCK_BYTES", 4000)  # several blocks of the benchmark
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = winnowing.decontamination(docs, items, k=4, span=span).collect()
    assert len(found) == docs.count()
    expected = cases.decontamination(ROWS, ITEMS, span)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == expected[r.doc_id]
    clean = winnowing.clean_documents(docs, items, k=4, span=span)
    assert clean.columns == docs.columns
    ids = {r.doc_id for r in clean.collect()} - {None}
    assert ids == {d for d, e in expected.items() if not e[4]} and 0 < len(ids) < len(expected)


def test_winnowing_stays_in_the_jvm(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = winnowing.decontamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_decontamination_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert winnowing.decontamination(empty, items).count() == 0
    none = winnowing.decontamination(docs, items.limit(0)).collect()
    assert len(none) == docs.count() and not any(r.n_hit or r.contaminated for r in none)


def test_packing_is_an_exact_cut_of_the_ids(docs):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = vector_packing.pack(docs, RANKS, vector_packing.Capacities(tokens=64, attention=64 * 64), group_pieces=50).collect()
    texts = dict(ROWS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == {*texts, None}
    for doc, text in ROWS[1:]:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, p in enumerate(sorted(by_doc[doc], key=lambda p: p.piece)):
            raw = np.array(ids[at : at + p.length], dtype="<u4").tobytes()
            assert (p.piece, p.start, p.ids_crc32) == (k, at, zlib.crc32(raw)) and (k == 0 or p.length == 64)
            at += p.length
        assert at == len(ids)
    assert len(by_doc[ROWS[0][0]]) % 3 == 0  # a row that is there three times
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64


def test_ids_of_added_tokens_equal_tokenizers():
    from tablegauge.llm.tokens import document_ids, encoder
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert document_ids(encoder(RANKS), "a <|endoftext|> b").tolist() == [64, 220, 50256, 275, 2]
    for text in ("<|endoftext|>", "x<|endoftext|><|endoftext|>  y ", "<|endoftext|", "a  \n<|endoftext|>\n b", "<|ENDOFTEXT|>"):
        assert document_ids(encoder(RANKS), text).tolist() == [*reference.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    whole = np.random.default_rng(5).integers(1, 65, 3000)
    limits = vector_packing.Capacities(tokens=64, documents=3, attention=2400, weights=(1, 0.2, 0.5))
    lengths = np.minimum(whole, limits.piece)
    sequence, offset = vector_packing.best_fit(lengths, limits, rule)
    for s in np.unique(sequence):
        of = lengths[sequence == s]
        assert of.sum() <= 64 and len(of) <= 3 and (of**2).sum() <= 2400
    plain = vector_packing.Capacities(tokens=64, documents=64, attention=64 * 64)
    sequence, _ = vector_packing.best_fit(whole, plain, rule)
    assert len(np.unique(sequence)) <= 1.02 * np.ceil(whole.sum() / 64)


def test_the_permutation_hits_every_slot_once():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        slots = training_order.permuted(np.arange(n), n, key=9)
        assert sorted(slots) == list(range(n))
    assert list(training_order.permuted(np.arange(1000), 1000, 9)) != list(training_order.permuted(np.arange(1000), 1000, 10))


def test_training_order_is_a_round_trip(docs, tmp_path):
    import tiktoken  # noqa: F401
    from tablegauge.llm.tokens import document_ids, encoder

    ordered = training_order.training_order(docs, RANKS, key=7, length=32, shard_slots=16)
    rows = sorted(ordered.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all((r.shard, r.place) == divmod(r.slot, 16) and len(r.record) == 64 for r in rows)
    # Only the last sequence of a part is not full.
    assert sum(r.n_ids < 32 for r in rows) <= docs.rdd.getNumPartitions()
    parts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(bytes(r.record), "<u2")
        assert r.offsets[0] == 0 and (ids[r.n_ids :] == 0).all()
        for doc, piece, start, stop in zip(r.doc_ids, r.pieces, r.offsets, [*r.offsets[1:], r.n_ids]):
            if doc not in (None, ROWS[0][0]):
                assert piece not in parts[doc]
                parts[doc][piece] = ids[start:stop]
    for doc, text in ROWS[1:]:
        ids = np.concatenate([parts[doc][k] for k in range(len(parts[doc]))])
        assert ids.tolist() == document_ids(encoder(RANKS), text).tolist()
    assert sum(r.doc_ids.count(ROWS[0][0]) for r in rows) >= 3  # its row and two repeated ones
    written = training_order.write_shards(ordered, str(tmp_path / "shards"), length=32, shard_slots=16).collect()
    assert sum(w.n_slots for w in written) == len(rows)
    for start in (0, 37):
        read = list(training_order.read_slots(str(tmp_path / "shards"), start, length=32, shard_slots=16))
        assert [x.tobytes() for x in read] == [bytes(r.record) for r in rows[start:]]


def test_very_long_texts(spark):
    """A long text that is copied goes whole, but for words that are its own; white space and a long word are no problem."""
    words = [f"w{i % 90_001}" for i in range(150_000)]
    texts = {1: " ".join(words), 2: " ".join([*words, "own", "end"]), 3: " " * 2_000_000, 4: "x" * 1_000_000, 5: "the " * 100_000}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in recompression.repeated_passages_removed(table).collect()}
    assert [(found[d].n_words, found[d].n_removed, found[d].kept_text) for d in (1, 2, 3, 5)] == [
        (150_000, 150_000, ""), (150_002, 150_000, "own end"), (0, 0, ""), (100_000, 100_000, "")
    ]
    assert (found[4].n_words, found[4].n_removed) == (1, 0)
    ordered = training_order.training_order(table, RANKS, key=3, length=512, shard_slots=64).collect()
    assert sorted({d for r in ordered for d in r.doc_ids}) == [1, 2, 3, 4, 5]
    lengths = defaultdict(int)
    for r in ordered:
        for d, a, b in zip(r.doc_ids, r.offsets, [*r.offsets[1:], r.n_ids]):
            lengths[d] += b - a
    assert lengths[3] == 2_000_001


def test_records_of_wide_ids(spark, tmp_path):
    """Ids of 65536 and more take four bytes each."""
    path = f"file:{tmp_path}/wide"
    table = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string").coalesce(1)
    ordered = training_order.training_order(table, RANKS, key=7, length=8, shard_slots=2, end_id=70_000, path=path)
    (row,) = ordered.collect()
    ids = np.frombuffer(bytes(row.record), "<u4")
    assert row.doc_ids == [1, 2] and ids[row.n_ids - 1] == 70_000 and len(ids) == 8
    (read,) = training_order.read_slots(path, 0, length=8, shard_slots=2, width=4)
    assert read.tolist() == ids.tolist()


def test_training_order_writes_its_shards(docs, tmp_path):
    path = f"file:{tmp_path / 'order'}"
    rows = sorted(training_order.training_order(docs, RANKS, key=7, length=32, shard_slots=16, path=path).collect(), key=lambda r: r.slot)
    read = list(training_order.read_slots(path, 0, length=32, shard_slots=16))
    assert [x.tobytes() for x in read] == [bytes(r.record) for r in rows] and len(rows) > 32
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.record)[: 2 * r.n_ids]) for r in rows)
    names = {p.name for p in (tmp_path / "order").iterdir()}
    assert names == {f"{k}.bin" for k in range(-(-len(rows) // 16))}


@pytest.mark.parametrize("n_ids", [1, 40, 256, 4_000, 60_000, 200_000])
def test_squeezed_ids_come_back(n_ids):
    """Whatever the vocabulary, ids beyond those counted too."""
    rng = np.random.default_rng(1)
    order, width = rng.permutation(n_ids), 2 if n_ids <= 1 << 16 else 4
    squeezer = training_order._Squeezer(order, width)
    for ids in (order[:1024], order[-1024:], rng.integers(0, n_ids, 1024), np.array([0, 2 ** (8 * width) - 1])):
        record = ids.astype(f"<u{width}").tobytes()
        assert squeezer.restored(squeezer.squeezed(record)) == record


def test_sequences_move_squeezed_by_frequency(spark, monkeypatch):
    """Ids are few and uneven, as in natural texts; they take less than four fifths of what deflated byte places take."""
    seen = []
    frequent = training_order._frequent
    monkeypatch.setattr(training_order, "_frequent", lambda *args: seen.append(frequent(*args)) or seen[-1])
    words = "the quick brown fox jumps over a lazy dog while seven wizards quietly judge boxing matches near frozen harbours".split()
    rng = np.random.default_rng(2)
    texts = [" ".join(words[min(int(k), len(words) - 1)] for k in rng.geometric(0.15, 800) - 1) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = training_order.training_order(table, RANKS, key=7, length=512, shard_slots=16).collect()
    records = [np.frombuffer(bytes(r.record)[: 2 * r.n_ids], "<u2") for r in rows]
    n = np.bincount(np.concatenate(records))
    (ids,) = seen
    assert sorted(ids) == np.flatnonzero(n).tolist() and (np.diff(n[ids]) <= 0).all()
    squeezer = training_order._Squeezer(ids, 2)
    planes = [zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 2).T).tobytes(), 1) for x in records]
    assert sum(len(squeezer.squeezed(x.tobytes())) for x in records) < 0.8 * sum(map(len, planes))


def test_ids_of_long_white_space():
    """Cut out or not, the ids are those of the tokenizer library; beyond a million characters too."""
    from tablegauge.llm.tokens import document_ids, encoder, text_ids
    from tokenizers import Tokenizer

    encoding, plain = encoder(RANKS), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    pieces = [" ", "  ", "\n", "\t", "\u3000", "\x1c", "\x85", "a", "bc", "1", ".", " the", "\u00e9", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert text_ids(encoding, text, long_space=3) == plain.encode(text, add_special_tokens=False).ids
    for text, n in ((" " * 2_000_000, 2_000_000), (" \n" * 1_000_000 + "word", 2_000_001)):
        assert len(document_ids(encoding, text)) == n + 1


PRIVATE = [
    (1, "mail a.b@c.example.com, a@b no, x@y.z@q.r.s end"),
    (2, "ip 1.2.3.4 and 300.1.1.1 and 1.2.3.4.5.6.7.8 and 0001.02.3.255"),
    (3, "card 4041894974608795 and 4041-8949 7460 8795, not 4041894974608796"),
    (4, "call +1 (988) 555-2485 or +1 (269) 555-3296 4524132264652876 or +12"),
    (5, None),
    (6, ""),
    (7, "é" * 5 + " a@b.c " + "9" * 3000 + " @" * 50 + "x" * 3000 + "@"),
]


def test_personal_data_equals_plain_patterns(spark):
    import hashlib
    import re

    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    order = list(kinds)
    found = {r.doc_id: r for r in disclosure.personal_data(cases.frame(spark, PRIVATE, extra=True)).collect()}
    for doc, text in PRIVATE:
        spans = []
        for kind, pattern in kinds.items():
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
                good = {
                    "email": True,
                    "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn,
                    "phone": 10 <= len(digits) <= 15,
                }
                if good[kind]:
                    spans.append((m.start(), order.index(kind), m.end()))
        listed = ",".join(f"{order[k]}:{a}:{b}" for a, k, b in sorted(spans))
        r = found[doc]
        assert r.spans == listed and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
    assert found[1].n_email == 2 and found[2].n_ip == 4 and found[3].n_card == 2 and found[4].n_phone == 1


def test_disclosing_terms_are_found_and_removed(spark):
    kind = ("tea", "cups", "milk", "bread", "salt", "corn")
    rows = [(i, f"note {i} from Quillfeather at q@x.example.org about {kind[i]} today") for i in range(6)]
    rows += [(50 + i, f"note {i} from someone about {kind[i % 6]} today") for i in range(60)]
    docs = cases.frame(spark, rows, extra=True).withColumn("n_chars", F.char_length("text").cast("long"))
    r = {r.doc_id: r for r in disclosure.personal_data(docs).collect()}
    term = rows[1][1].index("Quillfeather")
    assert f"term:{term}:{term + 12}" in r[1].spans.split(",") and r[1].n_term == 1 and r[55].spans == ""
    clean = disclosure.sanitised(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    one = clean.filter("doc_id = 1").first()
    assert one.text == "note 1 from [TERM] at [EMAIL] about cups today" and one.n_chars == len(one.text)
    assert clean.filter("doc_id = 55").first().text == rows[11][1]


@pytest.mark.parametrize("n", [1, 2])
def test_terms_of_entities_in_few_documents(spark, n):
    """A rare name beside an address in one or two texts discloses it; exact copies are one text."""
    rows = [(i, f"note {i} from Quillfeather at q@x.example.org about tea today") for i in range(n)]
    rows += [(50 + i, f"note {i} from someone about tea today") for i in range(60)]
    copied = [*rows, *[(200 + i, rows[0][1]) for i in range(30)], *[(300 + i, "note from someone about milk today") for i in range(30)]]
    for table in (rows, copied):
        found = {r.doc_id: r for r in disclosure.personal_data(cases.frame(spark, table, extra=False)).collect()}
        for doc, text in table:
            name = text.find("Quillfeather")
            spans = [x for x in found[doc].spans.split(",") if x.startswith("term")]
            assert spans == ([f"term:{name}:{name + 12}"] if name >= 0 else [])


def test_disclosing_terms_far_from_their_entity(spark):
    """A name at the top and an address at the bottom meet, and every occurrence of the name goes, in any case."""
    filler = " ".join(f"some words stand here in the middle {i}" for i in range(20))
    rows = [(i, f"Quillfeather {i} says {filler} QUILLFEATHER and {filler} q@x.example.org") for i in range(4)]
    rows += [(50 + i, f"someone {i} says {filler} and {filler}") for i in range(60)]
    clean = {r.doc_id: r.text for r in disclosure.sanitised(cases.frame(spark, rows, extra=False)).collect()}
    for doc, text in rows:
        assert clean[doc] == text.replace("QUILLFEATHER", "[TERM]").replace("Quillfeather", "[TERM]").replace("q@x.example.org", "[EMAIL]")


@pytest.mark.parametrize("n", [60, 2000])
def test_ordinary_rare_words_stay(spark, n):
    """Words of one text beside an entity of one text are no names of it where there are several, at any size of the corpus."""
    rare = "zanverol quimbast tolfrex mabrindle"
    rows = [(1, f"note from {rare} at q@x.example.org about tea today")]
    rows += [(2 + i, f"note {i} from Quillfeather {'ox elk yak'.split()[i % 3]} at w@y.example.org") for i in range(6)]
    # A word of two texts, one of which holds the entity.
    rows += [(10, "shared brontide at e@z.example.org"), (11, "shared brontide again")]
    rows += [(100 + i, f"note {i} from someone about tea today, ox elk yak shared again") for i in range(n)]
    found = {r.doc_id: r for r in disclosure.personal_data(cases.frame(spark, rows, extra=False)).collect()}
    assert [found[d].n_term for d in (1, 2, 7, 10, 11, 100)] == [0, 1, 1, 0, 0, 0]


def test_names_among_many_rare_words_go(spark):
    """However many words meet an entity in one text only, each that is written as a name goes; the others stay."""
    import re

    text = "Brontide again. It is Zanverol Quimbast, of Tolfrex, or Dr. Mabrindle, in vornish ulmery at q@x.example.org about tea today"
    rows = [(1, text)]
    rows += [(100 + i, f"note {i}. It is about tea today, again, and of ink, or in milk") for i in range(60)]
    docs = cases.frame(spark, rows, extra=False)
    names = ("Zanverol", "Quimbast", "Tolfrex", "Mabrindle")
    spans = [f"term:{text.index(x)}:{text.index(x) + len(x)}" for x in names]
    (found,) = disclosure.personal_data(docs).filter("doc_id = 1").collect()
    assert [x for x in found.spans.split(",") if x.startswith("term")] == spans and found.n_term == 4
    (clean,) = disclosure.sanitised(docs).filter("doc_id = 1").collect()
    assert clean.text == re.sub("|".join(names), "[TERM]", text).replace("q@x.example.org", "[EMAIL]")


def _plain_ftrl(rows, p):
    """Weights of FTRL-proximal, coordinate by coordinate, over rows of (features, label)."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, l1):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    for features, label in rows:
        at = [*features, "bias"]
        w = {i: weight(i, 0 if i == "bias" else p.l1) for i in at}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in at:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / p.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    return {i: weight(i, 0 if i == "bias" else p.l1) for i in list(z)}


def test_scores_equal_plain_ftrl_for_any_partitions_and_batches(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["you", "vile", "grub", "kind", "soul", "tea", f"w{i % 50}"]) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    labels = [(i, int("vile" in t and "grub" in t)) for i, t in rows]
    labels += [(7, 0), (7, 1), (8, 1 - labels[8][1]), (9, None), (10**6, 1), labels[11], labels[11]]
    parameters = toxicity.Ftrl(max_rows=100)
    # The documented sample: ids with one label outside the holdout, the first of either label by a hash.
    one = {d: {y for e, y in labels if e == d and y is not None} for d, _ in rows}
    usable = [(d, min(one[d])) for d, _ in rows if d not in HELD and len(one[d]) == 1]
    order = {r.d: (r.a, r.b) for r in spark.createDataFrame([(d,) for d, _ in usable], "d long").select("d", F.xxhash64("d").alias("a"), F.xxhash64("d", F.lit(1)).alias("b")).collect()}
    chosen = [x for k in (0, 1) for x in sorted((x for x in usable if x[1] == k), key=lambda x: order[x[0]][0])[:100]]
    chosen.sort(key=lambda x: order[x[0]][1])
    texts, features = dict(rows), toxicity.Features(parameters)
    learned = [(features.of(texts[d]).tolist(), y) for d, y in chosen] * parameters.passes
    w = _plain_ftrl(learned, parameters)
    share = [min(n, 100) / n for n in (sum(y == k for _, y in usable) for k in (0, 1))]
    bias = w["bias"] + math.log(share[0] / share[1])
    want = {d: 1 / (1 + math.exp(-bias - sum(w.get(i, 0.0) for i in features.of(t).tolist()))) for d, t in rows}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for parts, size in ((1, 10_000), (5, 7)):
        spark.conf.set(batch, size)
        try:
            docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
            table = spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts)
            got = {r.doc_id: r.score for r in toxicity.toxicity(docs, table, parameters).collect()}
        finally:
            spark.conf.unset(batch)
        assert all(abs(got[d] - want[d]) < 1e-5 for d in want) and max(got.values()) > 0.6


def test_a_repeated_id_gives_one_document_to_learn_from(spark):
    rows = [(i, "you vile grub" if i % 2 else "you kind soul") for i in range(100)] + [(1, f"other text {i}") for i in range(500)]
    table = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    score = {n: toxicity.toxicity(spark.createDataFrame(rows[:n], "doc_id long, text string"), table).filter("doc_id = 3").first().score for n in (101, 600)}
    assert score[101] == score[600] > 0.5


#: Columns that are named as the operators name some of theirs.
INNER = "_score double, score string, _row_key int, _text_key int, key string, `row` int, _clean string, clean int, _terms string, terms int, _base int"


def test_inner_names_do_not_clash(spark):
    mine = (0.5, "s", 1, 2, "k", 3, "c", 4, "t", 5, 6)
    rows = [(i, f"note {i} from someone at a{i % 3}@x.example.org", *mine) for i in range(12)] + [(20, None, *mine), (21, "", *mine)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {INNER}")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    items = spark.createDataFrame([("b", "nothing of these")], "item_id string, text string")
    for out in (
        toxicity.not_toxic(docs, labels.limit(0)),
        bbit_minhash.deduplicated(docs, words=20),
        winnowing.clean_documents(docs, items),
        disclosure.sanitised(docs),
    ):
        assert out.columns == docs.columns
        for r in out.collect():
            assert tuple(r)[2:] == mine
    assert disclosure.sanitised(docs).count() == 14


def test_a_work_folder_is_found_where_none_is_set(tmp_path):
    """In a session of its own, without spark.checkpoint.dir and without the settings of the installation."""
    code = """
import math
import random
import sys
from pyspark.sql import SparkSession
from tablegauge.llm import bbit_minhash
from tablegauge.llm.common import shared_dir
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert shared_dir(spark) == shared_dir(spark)
docs = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")
assert bbit_minhash.near_duplicates(docs).filter("kept").count() == 1
print("fine")
"""
    import os
    import subprocess
    from pathlib import Path

    (tmp_path / "conf").mkdir()
    root = str(Path(__file__).resolve().parents[2])
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_toxicity_learns_without_the_holdout(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 1
        rows.append((i, f"plain words number {i % 7} and more of them {'you vile grub' if bad else 'you kind soul'} at the end"))
        labels.append((i, 1 if bad != (i in HELD and i % 3 == 0) else 0))  # wrong labels in the holdout must not matter
    rows += [(1000, None), (1001, ""), (1002, "Unseen." * 20_000)]
    docs = cases.frame(spark, rows, extra=True)
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, table).collect()}
    assert all(found[d].held_out == (d in HELD) for d, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    assert all(found[i].predicted == int(i % 5 == 1) for i in range(400))
    kept = toxicity.not_toxic(docs, table)
    assert kept.columns == docs.columns and kept.filter("doc_id < 400").count() >= 320
    assert {r.score for r in toxicity.toxicity(docs, table.limit(0)).collect()} == {0.5}


def test_scores_follow_the_odds_of_all_labels(spark):
    """Clean labels beyond the bound leave the rate of predicted = 1 as it is; texts without a cue score the base rate."""
    rows = [(i, "" if i % 2 else "you vile grub" if i % 4 == 0 and i % 20 < 8 else "you kind soul") for i in range(6000)]
    table = spark.createDataFrame([(i, int(i % 20 in (0, 4, 5, 15))) for i, _ in rows], "doc_id long, toxic int")
    docs = cases.frame(spark, rows, extra=False)
    whole, bound = (
        toxicity.toxicity(docs, table, toxicity.Ftrl(max_rows=n)).groupBy("doc_id").agg(F.first("score").alias("s"), F.first("predicted").alias("p")).toPandas()
        for n in (100_000, 900)
    )
    for found in (whole, bound):
        assert found.p.mean() == 0.1
        assert abs(found.s[found.doc_id % 2 == 1].mean() - 0.2) < 0.1


HELD = {i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_empty_tables_give_no_rows(spark, empty):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for out in (
        bbit_minhash.near_duplicates(empty),
        bbit_minhash.deduplicated(empty),
        recompression.repeated_passages_removed(empty),
        vector_packing.pack(empty, RANKS),
        training_order.training_order(empty, RANKS, key=1),
        disclosure.personal_data(empty),
        disclosure.sanitised(empty),
        toxicity.toxicity(empty, labels),
    ):
        assert out.count() == 0
