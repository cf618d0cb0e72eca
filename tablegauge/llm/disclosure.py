"""Personal data: patterns, and terms that the corpus shows to disclose what the patterns protect.

1. Patterns find protected entities: e-mail and IP addresses, card and phone numbers.
2. For each entity the texts that hold it are counted, for each term of these texts the texts that hold
   both, and those that hold the term at all. Exact copies of a text count once. A pair is only counted
   where the counts of its two sides leave room for the rule.
3. A term discloses an entity when their pointwise mutual information reaches `bits` and comes within
   `-log2(certainty)` bits of the entity's own information: PMI(term; entity) >= IC(entity) + log2(certainty),
   so that a text with the term holds the entity with that probability, however large the corpus. PMI is smoothed by `prior`
   texts in which entity and term are independent, so few texts tell less than many. Terms that meet the
   entity in one text only tell the least, and their counts are all alike: where a text has more than
   `few` of them, each is judged by how the text writes it. Those that it writes as names (see `_named`)
   count, however many; the others are ordinary rare words. All occurrences of a disclosing term in the
   texts that hold the entity are spans too, generalised or removed with the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tablegauge.llm.common import boxed, broadcast_if_small, saved, text_keys

#: The kinds of the base, in their order; `term` spans are added by the method.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number starts where its run of digits starts: from a later digit it would fail or end alike.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
#: What stands before a word inside a sentence: a word, a comma and the like, or a short title or initial (Dr. J.).
_INSIDE = re.compile(r"""(?:[\w,&/)'\u2019-]|(?<!\w)[A-Z][a-z]{0,2}\.)[^\S\r\n]*["'\u201c\u2018\xab(\[]*\Z""")
#: Size of the filter for terms to count: 2 MB, whatever the corpus.
_FILTER_BITS = 24


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain, searched from each @, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all pattern matches that hold, in this order."""
    if not text:
        return []
    found = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # No part beyond 255; int() of very long parts is refused by Python and not needed.
            if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m.groups()):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _term_hash(term: str) -> int:
    return xxh64_intdigest(term.encode("utf-8", "surrogatepass")) - (1 << 63)


def _terms_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """The terms (lower case, start, end) that overlap none of the sorted `spans`."""
    k = covered = 0
    for m in _TERM.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            covered = max(covered, spans[k][2])
            k += 1
        if covered <= m.start():
            yield m[0].lower(), m.start(), m.end()


def _named(text: str, start: int) -> bool:
    """Whether the word at `start` has a capital letter where neither a sentence nor a line starts, as names have."""
    return text[start].isupper() and _INSIDE.search(text[max(0, start - 16) : start]) is not None


def _held(docs: DataFrame) -> DataFrame:
    """k1, k2, entities, terms, names (hashes): the distinct ones of every different text that holds an entity.

    Names are the terms that the text writes as names at least once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, entities, terms, names = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                if spans := base_spans(text):
                    row.append(i)
                    entities.append(sorted({_term_hash(f"{KINDS[kind]}:{text[s:e].lower()}") for s, kind, e in spans}))
                    named: dict[str, bool] = {}
                    for w, start, _ in _terms_outside(text, spans):
                        named[w] = named.get(w) or _named(text, start)
                    terms.append([_term_hash(w) for w in sorted(named)])
                    names.append([_term_hash(w) for w in sorted(named) if named[w]])
            row, kind = pa.array(row, pa.int64()), pa.list_(pa.int64())
            lists = [pa.array(x, kind) for x in (entities, terms, names)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(row), batch.column("k2").take(row), *lists],
                names=["k1", "k2", "entities", "terms", "names"],
            )

    kind = "k1 long, k2 long, entities array<long>, terms array<long>, names array<long>"
    return docs.select(*text_keys(F.col("text")), "text").mapInArrow(emit, kind).dropDuplicates(["k1", "k2"])


def _copies(docs: DataFrame) -> DataFrame:
    """k1, k2, n: the texts that occur n times, more than once."""
    keys = docs.filter("text IS NOT NULL").select(*text_keys(F.col("text")))
    return saved(keys.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))


def _document_counts(docs: DataFrame, terms: DataFrame, copies: DataFrame) -> DataFrame:
    """term, n_docs: the different texts that hold each of `terms`."""
    bit = F.shiftrightunsigned("term", 64 - _FILTER_BITS)
    word = terms.select(F.shiftright(bit, 6).alias("word"), F.expr("1L").alias("one"), bit.bitwiseAND(63).cast("int").alias("place"))
    # A bit array of fixed size on the driver; a full one only lets more terms be counted.
    rows = word.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, place)")).alias("bits")).toPandas()
    bits = np.zeros(1 << (_FILTER_BITS - 6), dtype=np.int64)
    bits[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    wanted = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            counts: Counter[tuple[int, int]] = Counter()
            for text, n in zip(batch.column("text"), batch.column("n").to_pylist()):
                words = {w.lower() for w in set(_TERM.findall(text.as_py() or ""))}
                h = np.fromiter(map(_term_hash, words), dtype=np.int64, count=len(words))
                h = h[passes[h.view(np.uint64) >> np.uint64(64 - _FILTER_BITS)]]
                counts.update((x, n) for x in h.tolist())
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array([h for h, _ in counts], pa.int64()),
                    "n": pa.array([n for _, n in counts], pa.int64()),
                    "rows": pa.array(list(counts.values()), pa.int64()),
                }
            )

    # A text that occurs n times is met n times, and counts 1 / n each time.
    keyed = docs.filter("text IS NOT NULL").select(F.struct(*text_keys(F.col("text"))).alias("key"), "text")
    repeated = broadcast_if_small(copies.select(F.struct("k1", "k2").alias("key"), "n"), 40)
    met = keyed.join(repeated, "key", "left").select("text", F.coalesce("n", F.lit(1)).alias("n"))
    counted = met.mapInArrow(count, "term long, n long, rows long").groupBy("term", "n").agg(F.sum("rows").alias("rows"))
    return counted.groupBy("term").agg(F.sum(F.expr("rows div n")).alias("n_docs")).join(terms, "term", "left_semi")


def _n_texts(docs: DataFrame, copies: DataFrame) -> int:
    """The different texts; a null is none."""
    rows = docs.filter("text IS NOT NULL").count()
    return rows - (copies.agg(F.sum(F.col("n") - 1)).first()[0] or 0)


def disclosing_terms(docs: DataFrame, certainty: float = 0.7, bits: float = 3, prior: float = 1 / 3, few: int = 2) -> DataFrame:
    """k1, k2, terms (hashes): the terms that disclose an entity of the text, for every text that has some."""
    held, copies = saved(_held(docs)), _copies(docs)
    n = F.lit(float(max(_n_texts(docs, copies), 1)))
    entities = held.select("k1", "k2", F.explode("entities").alias("entity"))
    # Written, so that the join has a plain exchange on either side, which adaptive execution can split.
    entities = entities.join(saved(entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))), "entity")
    # Entities of one text have equal counts with every term: one stands for all of them in that text.
    entity = F.when(F.col("n_entity") == 1, F.col("k1")).otherwise(F.col("entity"))
    entities = saved(entities.select("k1", "k2", entity.alias("entity"), "n_entity").distinct())
    terms = held.select("k1", "k2", F.explode("terms").alias("term"))
    counts = _document_counts(docs, terms.select("term").distinct(), copies)

    def discloses(n_both: Column) -> Column:
        # PMI - IC is the logarithm of the share of the term's texts that hold the entity.
        given_term = (n_both + F.lit(prior) * F.col("n_entity") / n) / (F.col("n_docs") + F.lit(prior))
        return (given_term >= certainty) & (given_term * n >= F.lit(2.0**bits) * F.col("n_entity"))

    # No pair occurs more often than either side, so that count gives an upper bound of PMI.
    most = float(entities.agg(F.max("n_entity")).first()[0] or 0)
    able = F.least(F.lit(most), F.col("n_docs")) + prior >= F.lit(certainty) * (F.col("n_docs") + prior)
    rare = terms.join(saved(counts.filter(able)), "term")
    pairs = saved(rare.join(entities, ["k1", "k2"]).filter(discloses(F.least("n_entity", "n_docs"))))
    both = pairs.groupBy("entity", "term", "n_entity", "n_docs").agg(F.count(F.lit(1)).alias("n_both"))
    strong = saved(both.filter(discloses(F.col("n_both"))).select("entity", "term", "n_both"))
    met = pairs.join(strong, ["entity", "term"]).groupBy("k1", "k2", "term").agg(F.max("n_both").alias("n_both"))
    once = F.collect_list(F.when(F.col("n_both") == 1, F.col("term")))
    often = F.collect_list(F.when(F.col("n_both") > 1, F.col("term")))
    of_text = met.groupBy("k1", "k2").agg(once.alias("once"), often.alias("often"))
    of_text = of_text.join(held.select("k1", "k2", "names"), ["k1", "k2"])
    counting = F.when(F.size("once") <= few, F.col("once")).otherwise(F.array_intersect("once", "names"))
    found = F.concat("often", counting)
    return of_text.select("k1", "k2", F.sort_array(found).alias("terms")).filter(F.size("terms") > 0)


_SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("stop", T.LongType())])
)


@F.pandas_udf(_SPANS)
def _base(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"start": s, "kind": k, "stop": e} for s, k, e in base_spans(t)] for t in texts])


def _listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


@F.pandas_udf(_SPANS)
def _of_terms(texts: pd.Series, terms: pd.Series) -> pd.Series:
    """Spans of all occurrences of `terms` (hashes) in each text, outside the base spans."""
    kind = KINDS.index("term")

    def one(text: str | None, found: np.ndarray | None) -> list[dict]:
        if not text or found is None:
            return []
        found = set(map(int, found))
        return [{"start": s, "kind": kind, "stop": e} for w, s, e in _terms_outside(text, base_spans(text)) if _term_hash(w) in found]

    return pd.Series([one(t, x) for t, x in zip(texts, terms)], dtype=object)


def _known_terms(docs: DataFrame, key: str, **parameters: float) -> DataFrame:
    """`key` (k1, k2) and _terms, for the texts with disclosing terms; broadcast if small, else whole rows are shuffled."""
    found = saved(disclosing_terms(docs, **parameters))
    return broadcast_if_small(found.select(F.struct("k1", "k2").alias(key), F.col("terms").alias("_terms")), 100 + 8 * F.size("_terms"))


def personal_data(docs: DataFrame, certainty: float = 0.7, bits: float = 3, prior: float = 1 / 3, few: int = 2) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, n_term, spans for every row of `docs`.

    Null and empty texts have no spans. Repeated rows get equal results. Spans of one kind do not overlap;
    those of two kinds may. Other columns are ignored; an empty table gives no rows.
    """
    keyed = docs.select("doc_id", F.struct(*text_keys(F.col("text"))).alias("key"), "text")
    terms = _known_terms(docs, "key", certainty=certainty, bits=bits, prior=prior, few=few)
    out = keyed.join(terms, "key", "left").select("doc_id", _base("text").alias("base"), _of_terms("text", "_terms").alias("terms"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id",
        *map(number, KINDS[:4]),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "terms"))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def one(text: str | None, found: list[dict]) -> str | None:
        out, done = [], 0
        for x in found if text else ():
            if x["start"] >= done:  # an overlapping later span extends the gap, without a mark of its own
                out += [text[done : x["start"]], f"[{KINDS[x['kind']].upper()}]"]
            done = max(done, x["stop"])
        return "".join([*out, text[done:]]) if out else text

    return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)


def sanitised(docs: DataFrame, certainty: float = 0.7, bits: float = 3, prior: float = 1 / 3, few: int = 2) -> DataFrame:
    """`docs` with every span of personal data replaced by its kind, as in [EMAIL]; no row is left out.

    n_chars, where there is such a column, follows the new text. Cases as in `personal_data`.
    """
    keyed = boxed(docs, key=F.struct(*text_keys(F.col("text"))), text=F.col("text"))
    joined = keyed.join(_known_terms(docs, "key", certainty=certainty, bits=bits, prior=prior, few=few), "key", "left")
    spans = F.array_sort(F.concat(_base("text"), _of_terms("text", "_terms")))
    out = joined.select("row", _without(F.col("text"), spans).alias("clean"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("clean").alias("text"))
        elif c == "n_chars":
            columns.append(F.char_length("clean").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col("row")[c].alias(c))
    return out.select(*columns)
