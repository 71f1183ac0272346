"""Quality rules as a short-circuit cascade.

Every rule rejects or passes one document.  The rules are timed on a bounded
sample (`sample_rows` documents of at most SAMPLE_TEXT bytes, those with the
smallest hash of their id) and
ordered by rejections per second of cost; a document leaves the cascade at the
first rule that rejects it.  A document is kept when no rule rejects it, so
the verdict does not depend on the order; only the time does.

NULL text counts as empty text.  Empty texts have no words and fail the base
rules.  Repeated rows are judged one by one."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sample

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
LETTER = re.compile(r"[^\W\d_]")
SAMPLE_TEXT = 64 * 2**10
MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Doc:
    """One text; each measure is computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "replace").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by three-word windows that occur twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, end = 0, 0
        for i, x in enumerate(windows):
            if counts[x] > 1:
                covered += i + 3 - max(end, i)
                end = i + 3
        return covered

    @cached_property
    def n_plain_words(self) -> int:
        """Words without any letter."""
        return sum(1 for w in self.text.split() if not LETTER.search(w))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


#: The base rules of the query's contract.
BASE = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
#: Further rules, all with wide margins so that plain prose passes.
EXTRA = (
    Rule("symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("duplicate_lines", lambda d: len(d.lines) >= 4 and 2 * d.n_dup_lines > len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("no_letters", lambda d: 10 * d.n_plain_words > 4 * d.n_words),
)


def sample_texts(docs: DataFrame, rows: int) -> list[str]:
    return [r["text"] for r in sample(docs, rows, SAMPLE_TEXT).collect()]


def order_rules(rules, texts: list[str]) -> list[Rule]:
    """Rules by rejections per second on the sample, best first."""
    scored = []
    for k, rule in enumerate(rules):
        docs = [Doc(t) for t in texts]
        began = time.perf_counter()
        rejected = sum(map(rule.rejects, docs))
        spent = time.perf_counter() - began
        scored.append((-rejected / max(spent, 1e-9), k, rule))
    return [rule for *_, rule in sorted(scored, key=lambda x: x[:2])]


def passes(doc: Doc, ordered: list[Rule]) -> bool:
    return not any(rule.rejects(doc) for rule in ordered)


def measure(docs: DataFrame, sample_rows: int = 512) -> DataFrame:
    """One row per document: the measures, `base_failed` and `kept`.  The
    cascade runs for documents that pass the base rules."""
    extra = order_rules(EXTRA, sample_texts(docs, sample_rows))

    def judge(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                d = Doc(text)
                base = any(r.rejects(d) for r in BASE)
                out.append((doc_id, d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words,
                            base, not base and passes(d, extra)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 8, [pa.int64()] * 6 + [pa.bool_()] * 2)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        judge, MEASURES + ", base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, sample_rows: int = 512, column: str = "text") -> DataFrame:
    """The rows of `docs` that the whole cascade keeps, all columns unchanged."""
    ordered = order_rules(BASE + EXTRA, sample_texts(docs, sample_rows))

    def judge(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            yield batch.filter(pa.array([passes(Doc(t), ordered) for t in texts], pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
