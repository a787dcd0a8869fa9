"""Quality rules, line first: drop failing lines, then judge what is left of the document."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from publicspend.llm.common import mapped, take

SYMBOLS = b"#*$%&|<>"
TERMINAL = tuple(".!?…:;\"'”’»)。！？")
PHRASES = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "lorem ipsum",
    "enable javascript",
    "javascript is disabled",
    "log in to",
    "sign up for",
    "subscribe to our",
    "click here",
    "share this",
    "skip to content",
)
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)))
_SEPARATOR = re.compile(r"[|›»•→·]| > | / ")
_MARK = re.compile(r"[!?#*$%&|<>=_~^+\\{}\[\]]")

METRICS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_nav_lines bigint, n_punct_lines bigint, "
    "n_boiler_lines bigint, lost_chars bigint, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules.

    A line is navigation if it has ``separators`` or more separators and at most
    ``nav_words`` words between them, or at most ``short_words`` words and no terminal mark.
    It fails punctuation if over ``mark_share`` of its characters are marks that prose seldom
    has. It is boilerplate if it holds a known phrase and at most ``boiler_words`` words.
    A document goes if its lines that fail hold over ``lost_share`` of its characters in words.
    """

    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    separators: int = 2
    nav_words: float = 3.0
    short_words: int = 2
    mark_share: float = 0.15
    boiler_words: int = 25
    lost_share: float = 0.5

    def failing(self, line: str, words: int) -> str | None:
        """Which kind of rule a line with words fails, if any."""
        text = line.strip()
        parts = len(_SEPARATOR.findall(text))
        if parts >= self.separators and words <= self.nav_words * (parts + 1):
            return "nav"
        if words <= self.short_words and not text.endswith(TERMINAL):
            return "nav"
        if len(_MARK.findall(text)) > self.mark_share * (len(text) - text.count(" ")):
            return "punct"
        if words <= self.boiler_words and _PHRASE.search(text.lower()):
            return "boiler"
        return None


def repeated_words(words: list[bytes], window: int) -> int:
    """How many words lie in windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words)
    )
    if len(numbers) > len(words) - window:  # each word of a second window has come before
        return 0
    width = 1
    while width < window:  # ranks of longer windows from pairs of shorter ones
        step = min(width, window - width)
        pairs = rank[:-step] * (len(words) + 1) + rank[step:]
        _, rank = np.unique(pairs, return_inverse=True)
        width += step
    found = np.bincount(rank)[rank] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += found
    edges[window : window + n] -= found
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def judge(text: str | None, rules: LineRules) -> tuple[list, str]:
    """The figures of one text, in the order of METRICS, and the text without failing lines."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    breaks = sum(map(text.count, " \t\n\r\x0b\x0c"))
    word_chars = len(text) - breaks
    symbols = sum(raw.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    duplicates = lost = lines = 0
    failed = {"nav": 0, "punct": 0, "boiler": 0}
    left = []
    for line in text.split("\n"):
        count = len(line.encode().split())
        if count:
            lines += 1
            duplicates += line in seen
            seen.add(line)
            kind = rules.failing(line, count)
            if kind:
                failed[kind] += 1
                lost += len(line) - sum(map(line.count, " \t\r\x0b\x0c"))
                continue
        left.append(line)
    repeats = repeated_words(words, rules.window)
    base_failed = len(words) < rules.min_words or 100 * repeats > rules.repeat_percent * len(words)
    kept = not base_failed and lost <= rules.lost_share * word_chars
    figures = [len(words), word_chars, symbols, duplicates, repeats, lines, *failed.values(), lost]
    return [*figures, base_failed, kept], "\n".join(left)


def clean_lines(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    with_text: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: figures, verdict ``kept`` and ``cleaned``, its text without failing lines.

    Words are runs without ASCII white space. Null text counts as empty; empty texts fail.
    Repeated rows and null ids are judged row by row. Other columns are left out. A document is
    judged by itself: no shuffle, and memory grows with the longest text only.
    """
    schema = METRICS + (", cleaned string" if with_text else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, cleaned = [], []
        for text in batch.column(1).to_pylist():
            row, left = judge(text, rules)
            rows.append(row)
            cleaned.append(left)
        columns = [batch.column(0), *(pa.array(c) for c in zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(
            columns + ([pa.array(cleaned, pa.string())] if with_text else []), names
        )

    return mapped(take(docs, doc_id=id_column, text=text_column), "text", schema, run)


def cleaned_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with all their columns; failing lines are gone from ``text``.

    ``docs`` must have ``text`` and ``n_chars``, which is set anew; other columns, of whatever
    names, are passed on. Null and empty texts fail. Repeated rows and rows without an id are judged
    each by itself; an empty table stays empty. Memory grows with the longest text only.
    """
    text, chars = docs.columns.index("text"), docs.columns.index("n_chars")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [judge(value, rules) for value in batch.column(text).to_pylist()]
        texts = [left for _, left in judged]
        columns = list(batch.columns)
        columns[text] = pa.array(texts, columns[text].type)
        columns[chars] = pa.array(map(len, texts), columns[chars].type)
        kept = pa.array([figures[-1] for figures, _ in judged], pa.bool_())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(kept)

    return mapped(docs, "text", docs.schema, run)
