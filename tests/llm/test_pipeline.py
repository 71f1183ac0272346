"""The stages one by one against brute force, each on its own input."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeforge.llm import quality
from lakeforge.sources.tables import read_table

from ..conftest import SF_SMALL
from . import test_decontam, test_lines, test_simhash
from .fixtures import same

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each of the first four."""
    docs = read_table(spark, SF_SMALL, "documents")
    out = [docs]
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs, _ = corpus_pipeline.store(f(spark, docs, SF_SMALL), "test")
        assert docs.columns == COLUMNS
        out.append(docs)
    return [rows_of(df) for df in out] + [corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)]


def test_names():
    assert len(corpus_pipeline.STAGES) == 5


def test_quality(stages):
    kept = [r for r in stages[0] if not any(rule.rejects(quality.Doc(r[1])) for rule in quality.BASE + quality.EXTRA)]
    assert 0 < len(kept) < len(stages[0])
    same(stages[1], kept)


def test_lines_keep_documents(stages):
    wanted = {d: t for d, _, _, t in test_lines.brute([r[:2] for r in stages[1]])}
    same(stages[2], [(d, wanted[d], lang, source, len(wanted[d])) for d, _, lang, source, _ in stages[1]])


def test_one_of_each_group(stages):
    kept = {d for d, _, c in test_simhash.brute([r[:2] for r in stages[2]]) if d == c}
    assert len(kept) < len(stages[2])
    same(stages[3], [r for r in stages[2] if r[0] in kept])


def test_contaminated_go(spark, stages):
    items = [tuple(r) for r in read_table(spark, SF_SMALL, "benchmark", "item_id", "text").collect()]
    hit = {r[0] for r in test_decontam.brute([r[:2] for r in stages[3]], items)}
    same(stages[4], [r for r in stages[3] if r[0] not in hit])


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for d, t, *_ in stages[4]:
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((d, len(ids), ids, hashlib.sha256(text.encode()).hexdigest()))
    same(stages[5].collect(), wanted)


def test_run(spark, stages):
    same(corpus_pipeline.run(spark, SF_SMALL).collect(), stages[5].collect())


@pytest.mark.parametrize("data", [[], [(None, None, None, None, None)] * 2 + [(3, "", "en", "s", 0)]])
def test_stages_without_text(spark, data):
    docs = spark.createDataFrame(data, read_table(spark, SF_SMALL, "documents").schema)
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, docs, SF_SMALL).collect()
        assert len(out) <= len(data)
