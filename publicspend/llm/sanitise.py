"""Personal data, and the terms that give it away.

Patterns find the protected entities. A term *discloses* an entity if seeing the term says nearly
all there is to say about it: the pointwise mutual information of term and entity, over the
corpus, reaches a share of the entity's own information,

    log(N df(t, e) / (df(t) df(e)))  >=  share * log(N / df(e)).

A term counts as seen with an entity if it stands within a few words of a mention. All four figures
count distinct texts, and a term has to meet its entity in several different contexts, so that
copying a document neither proves nor hides anything.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import mapped, slices, stored, take

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "term")

_EMAIL_CHARS = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, str]


@dataclass(frozen=True)
class Disclosure:
    """A term discloses an entity if it meets it in ``support`` different contexts of ``window``
    words to each side, and tells ``share`` of the entity's information."""

    window: int = 5
    support: int = 3
    share: float = 0.9


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of a local part, an at sign and a dotted domain, in linear time.

    A run of the characters an address may have is cut at its at signs: whatever character of
    a part a match starts at, the same domain has to follow, so the first decides.
    """
    at = text.find("@")
    while at >= 0:
        start = at
        while start and _EMAIL_CHARS.match(text, start - 1, start):
            start -= 1
        run = _EMAIL_CHARS.match(text, start)
        end = run.end()
        local = start
        while 0 <= at < end:
            found = _DOMAIN.match(text, at + 1, end) if at > local else None
            if found:
                yield local, found.end()
                local = found.end()
            else:
                local = at + 1
            at = text.find("@", at + 1, end)
        at = text.find("@", end)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _IP_CHAIN.finditer(text):
        parts, place = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in four):
                yield place, place + size
            place += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 14:
            digits = _NO_DIGIT.sub("", found[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGIT.sub("", found[0])) <= 15:
                yield found.span()


def base_spans(text: str) -> list[Span]:
    """All pattern matches, each kind by itself, by start and then kind."""
    found = [(a, b, "email") for a, b in _emails(text)]
    if _DIGITS.search(text):
        for kind, finder in (("ip", _ips), ("card", _cards), ("phone", _phones)):
            found += [(a, b, kind) for a, b in finder(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _entity(text: str, span: Span) -> str:
    """A mention in one spelling."""
    start, end, kind = span
    value = text[start:end]
    value = value.lower() if kind in ("email", "ip") else _NO_DIGIT.sub("", value)
    return f"{kind}:{value}"


def _around(text: str, span: Span, window: int) -> list[str]:
    """The terms within ``window`` words of a mention, however long, without the mention itself."""
    before = _last_words(text, span[0], window)
    after = _first_words(text, span[1], window)
    terms = _TERM.findall(" ".join([*before, "0", *after]).lower())
    return sorted(set(terms))


def _last_words(text: str, end: int, n: int) -> list[str]:
    """Looks back in growing steps, until the first of the words is known to be whole."""
    reach = 40 * n
    while True:
        found = text[max(0, end - reach) : end].split()
        if len(found) > n or reach >= end:
            return found[-n:]
        reach *= 4


def _first_words(text: str, start: int, n: int) -> list[str]:
    reach = 40 * n
    while True:
        found = text[start : start + reach].split()
        if len(found) > n or start + reach >= len(text):
            return found[:n]
        reach *= 4


def mentions(docs: DataFrame, window: int) -> DataFrame:
    """(entity, context, text_hash, term): every term near every mention; 64-bit hashes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        entities, contexts, hashes, terms = [], [], [], []
        for text, of_text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            for span in base_spans(text or ""):
                entity, near = _entity(text, span), _around(text, span, window)
                context = xxhash.xxh64_intdigest(" ".join(near)) - (1 << 63)
                entities += [entity] * len(near)
                contexts += [context] * len(near)
                hashes += [of_text] * len(near)
                terms += near
        return pa.RecordBatch.from_arrays(
            [
                pa.array(entities, pa.string()),
                pa.array(contexts, pa.int64()),
                pa.array(hashes, pa.int64()),
                pa.array(terms, pa.string()),
            ],
            ["entity", "context", "text_hash", "term"],
        )

    schema = "entity string, context bigint, text_hash bigint, term string"
    return mapped(docs.select("text", F.xxhash64("text")), "text", schema, run)


def _frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term``, ``df``: in how many distinct texts each of ``terms`` stands.

    Only texts whose hash occurs again are shuffled, to keep one of each. A task adds up its own
    texts first and keeps a bounded number of counts.
    """
    hashed = docs.select("text", F.xxhash64("text").alias("text_hash"))
    times = hashed.groupBy("text_hash").agg(F.count("*").alias("n"))
    again = stored(times.where("n > 1").select("text_hash"), "repeated_texts")
    single = hashed.join(again, "text_hash", "left_anti").select("text")
    copied = hashed.join(again, "text_hash", "left_semi").select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            keys = pa.array(list(counts), pa.string())
            return pa.RecordBatch.from_arrays([keys, pa.array(counts.values(), pa.int64())], ["term", "n"])

        for piece in slices(batches, "text"):
            for text in piece.column("text").to_pylist():
                counts.update(set(_TERM.findall((text or "").lower())))
            if len(counts) > 500_000:
                yield out()
                counts.clear()
        yield out()

    partial = single.union(copied).mapInArrow(run, "term string, n bigint")
    return partial.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))


def disclosing_terms(docs: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """``term``, ``entity`` and ``told``, the share of the entity's information, at the threshold.

    Of all terms near mentions only those in enough contexts need their frequency in the corpus.
    """
    seen = stored(mentions(docs, rules.window).distinct(), "mentions")
    both = seen.groupBy("entity", "term").agg(
        F.count_distinct("context").alias("contexts"), F.count_distinct("text_hash").alias("both")
    )
    often = stored(both.where(F.col("contexts") >= rules.support), "co_occurrence")
    if often.isEmpty():
        return often.select("term", "entity", F.lit(0.0).alias("told"))
    alone = (
        seen.join(often.select("entity").distinct(), "entity", "left_semi")
        .select("entity", "text_hash")
        .distinct()
        .groupBy("entity")
        .agg(F.count("*").alias("entity_df"))
    )
    wide = _frequencies(docs, often.select("term").distinct())
    total = docs.select(F.xxhash64("text")).distinct().count()
    n = F.greatest(F.lit(float(total)), F.col("entity_df") + F.lit(1.0))
    shared = F.log(n * F.col("both") / (F.greatest("df", "both") * F.col("entity_df")))
    told = shared / F.log(n / F.col("entity_df"))
    return (
        often.join(alone, "entity")
        .join(wide, "term")
        .select("term", "entity", told.alias("told"))
        .where(F.col("told") >= rules.share)
    )


def _spans(docs: DataFrame, shared: frozenset[str] | None) -> DataFrame:
    """Per document its spans, base and added ones, as columns.

    The terms are ``shared``, or those in each row's column ``terms``.
    """
    ints = pa.list_(pa.int32())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        own = batch.column(2).to_pylist() if shared is None else [shared] * len(texts)
        found = [
            spans_of(text or "", frozenset(terms or ()))
            for text, terms in zip(texts, own, strict=True)
        ]
        columns = [pa.array([[s[i] for s in spans] for spans in found], ints) for i in (0, 1)]
        kinds = pa.array([[s[2] for s in spans] for spans in found], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *columns, kinds],
            ["doc_id", "text", "starts", "ends", "kinds"],
        )

    schema = "doc_id bigint, text string, starts array<int>, ends array<int>, kinds array<string>"
    return mapped(docs, "text", schema, run)


def spans_of(text: str, terms: frozenset[str]) -> list[Span]:
    """Base spans, and the ``terms`` that stand outside them."""
    spans = base_spans(text)
    if not terms:
        return spans
    inside = bytearray(len(text))
    for start, end, _ in spans:
        inside[start:end] = b"x" * (end - start)
    added = [
        (found.start(), found.end(), "term")
        for found in _TERM.finditer(text)
        if found[0].lower() in terms and not any(inside[found.start() : found.end()])
    ]
    return sorted(spans + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _term_lists(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(_llm_of_id, terms): the disclosing terms that the documents of an id hold."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, found = [], []
        for doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            here = set(_TERM.findall((text or "").lower()))
            ids += [doc_id] * len(here)
            found += here
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["_llm_of_id", "term"]
        )

    held = mapped(docs, "text", "_llm_of_id bigint, term string", run)
    return (
        held.join(terms, "term", "left_semi")
        .groupBy("_llm_of_id")
        .agg(F.collect_set("term").alias("terms"))
    )


def _known_terms(
    docs: DataFrame, rules: Disclosure, most: int
) -> tuple[frozenset[str] | None, DataFrame]:
    """The disclosing terms, also as a set if they are at most ``most``."""
    terms = stored(disclosing_terms(docs, rules).select("term").distinct(), "terms")
    few = terms.limit(most + 1).collect()
    return (frozenset(row[0] for row in few) if len(few) <= most else None), terms


def find_spans(
    docs: DataFrame,
    rules: Disclosure = Disclosure(),
    broadcast_terms: int = 50_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``text``, ``starts``, ``ends`` and ``kinds`` of all spans, one row a document.

    Offsets are code points, the end is exclusive. Spans of one kind never overlap; those of
    different kinds may. Added spans have the kind ``term`` and lie outside base spans. Null and
    empty texts have no spans. Repeated rows, rows with null ids and rows that share an id are
    handled row by row; other columns are left out. Up to ``broadcast_terms`` disclosing terms
    are handed to all tasks; more are joined to the documents that hold them.
    """
    rows = take(docs, doc_id=id_column, text=text_column)
    shared, terms = _known_terms(rows, rules, broadcast_terms)
    if shared is None:
        lists = _term_lists(rows, terms)
        same = rows["doc_id"].eqNullSafe(lists["_llm_of_id"])
        rows = rows.join(lists, same, "left").select("doc_id", "text", "terms")
    return _spans(rows, shared)


def span_text(kinds: tuple[str, ...]) -> F.Column:
    """The spans of these kinds as kind:start:end, comma-joined."""
    all_spans = F.arrays_zip("kinds", "starts", "ends")
    chosen = F.filter(all_spans, lambda s: s["kinds"].isin(*kinds))
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(
                ":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string")
            ),
        ),
        ",",
    )


def digest(spans: DataFrame) -> DataFrame:
    """Counts by kind, and the spans as text."""
    counts = [
        (F.size("kinds") - F.size(F.array_remove("kinds", kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    base = F.sha2(span_text(BASE_KINDS), 256).alias("base_sha256")
    return spans.select("doc_id", *counts, base, span_text(KINDS).alias("spans"))


def sanitised_documents(
    docs: DataFrame, rules: Disclosure = Disclosure(), broadcast_terms: int = 50_000
) -> DataFrame:
    """The documents with every span replaced by its kind, as in ``<EMAIL>``, and ``n_chars`` anew.

    Where spans overlap, the whole stretch takes the kind of the first. Null text stays null.
    ``docs`` must have ``doc_id``, ``text`` and ``n_chars``; other columns are passed on unless their
    names start with ``_llm_``. Repeated rows, shared and null ids are handled row by row; an empty
    table stays empty.
    """
    shared, terms = _known_terms(take(docs, doc_id="doc_id", text="text"), rules, broadcast_terms)
    text, chars = docs.columns.index("text"), docs.columns.index("n_chars")
    width = len(docs.columns)
    rows = docs
    if shared is None:
        lists = _term_lists(take(docs, doc_id="doc_id", text="text"), terms)
        same = docs["doc_id"].eqNullSafe(lists["_llm_of_id"])
        rows = docs.join(lists, same, "left").drop("_llm_of_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text).to_pylist()
        own = [shared] * len(texts) if shared is not None else batch.column(width).to_pylist()
        clean = [
            value and replaced(value, spans_of(value, frozenset(terms or ())))
            for value, terms in zip(texts, own, strict=True)
        ]
        columns = list(batch.columns)[:width]
        columns[text] = pa.array(clean, columns[text].type)
        sizes = [None if value is None else len(value) for value in clean]
        columns[chars] = pa.array(sizes, pa.int64()).cast(columns[chars].type)
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

    return mapped(rows, "text", docs.schema, run)


def replaced(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
