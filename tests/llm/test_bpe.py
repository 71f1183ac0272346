import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeforge.llm import bpe
from lakeforge.llm.queries import op4_bpe

from ..conftest import SF_SMALL
from .fixtures import frame, rows, same

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Hello  world's 12<|endoftext|> x<|startoftext|>y", "\u0130stanbul \u0391\u03a3 \u03a3 a\u0308 \u0308x e\u0301\x1cq\x85z\u2003w", "a" * 300 + " 12345'll don't \x00\x07 \u200b\ufeff x",
       "<|ENDOFTEXT|> <|endoftext|>", "\u65e5\u672c\u8a9e \U0001f600\U0001f44d\U0001f3fd \u01c5 \u00df", "x\x0by\x0cz\x1dk \u2028l\u2029m\u3000n", "it\u2019s '\u0301s 'S 'LL",
       "\u212a\u017f \u017fs '\u017f \u00e9a\n\r\t\u00e9\x7f~", "x" * 65 + "yz" * 31 + " " + "\u00e9" * 200, "ab" * 3000]


def brute(data):
    library, out = Tokenizer.from_file(PATH), []
    for d, t in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        out.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    return out


def test_awkward_rows(spark):
    data = rows() + [(2000 + i, t) for i, t in enumerate(ODD)]
    same(bpe.encode(frame(spark, data), PATH).collect(), brute(data))
    assert bpe.encode(frame(spark).limit(0), PATH).collect() == []


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    same(op4_bpe(spark, SF_SMALL).collect(), [(d, len(i), sha(" ".join(map(str, i))), sha(t)) for d, i, t in brute(docs)])


@pytest.mark.parametrize("word", [b"a", b"the", b"aaaaaaaaaaaaaaaaa", b"therefore", b"zzzzqqqqxxxx", b"x" * 64, b"ab" * 32])
def test_long_and_short_words_follow_the_same_tree(word):
    b = bpe.load(PATH)
    width = max(2, 1 << (len(word) - 1).bit_length())
    assert b.merge_rows([word, b"q", word], width)[0] == b.merge_long(word) == b.merge_rows([word], width)[0]


def test_forgetting_changes_nothing(monkeypatch):
    texts = [t or "" for t in ODD + [t for _, t in rows()]]
    whole = bpe.Bpe(PATH).encode_batch(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    small = bpe.Bpe(PATH)
    assert [x for t in texts for x in small.encode_batch([t])] == whole
