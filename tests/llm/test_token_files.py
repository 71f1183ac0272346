import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakeforge.llm import token_files
from lakeforge.llm.common import new_path
from lakeforge.llm.queries import op3_token_files

from ..conftest import SF_SMALL
from .fixtures import frame, key, rows, same

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["  two  blanks ", "tab\t x \n y  \n", "a <|endoftext|> b", "\xa0x \xa0y \x85z", " \x1cq \x1c", "it's  'll  don't\n\n z ", "日本 語 😀 é", " ",
       "  x 　 y"]


def brute(data):
    library, out, at = Tokenizer.from_file(PATH), [], 0
    coded = [(key(d), library.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in data]
    for d, ids in sorted(coded, key=lambda x: x[0]):
        out.append((None if d == key(None) else d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def digest(df):
    return [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in df.collect()]


def test_awkward_texts_round_trip(spark):
    data = [(i, t) for i, (_, t) in enumerate(rows())] + [(1000 + i, t) for i, t in enumerate(ODD)]
    path = new_path(spark, "test")
    token_files.write(frame(spark, data[::-1]), path, PATH)
    same(digest(token_files.read(spark, path)), brute(data))
    some = dict(data)[1003]
    one = token_files.read(spark, path, 1003).collect()
    ids = Tokenizer.from_file(PATH).encode(some, add_special_tokens=False).ids + [0]
    assert [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in one] == [ids]


def test_repeated_and_null_ids(spark):
    path = new_path(spark, "test")
    token_files.write(frame(spark), path, PATH)
    found, wanted = digest(token_files.read(spark, path)), brute(rows())
    same([(d, n, c) for d, _, n, c in found], [(d, n, c) for d, _, n, c in wanted])
    ends = sorted((s, s + n) for _, s, n, _ in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_empty_table_and_tiny_sample(spark):
    for data in ([], [(1, None)], [(4, "x"), (2, "y")]):
        path = new_path(spark, "test")
        token_files.write(frame(spark, data or [(1, "x")]).limit(len(data) or 0), path, PATH)
        same(digest(token_files.read(spark, path)), brute(data))


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op3_token_files(spark, SF_SMALL).collect(), brute(docs))


def test_dictionary_shortens_short_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    size = {}
    for rows_ in (400, 0):
        path = new_path(spark, "test")
        token_files.write(docs, path, PATH, sample_rows=rows_)
        size[rows_] = sum(len(r[0]) for r in spark.read.parquet(f"{path}/blocks").select("payload").collect())
    assert size[400] < size[0]


def test_new_words_go_to_the_model_alone(monkeypatch):
    library = Tokenizer.from_file(PATH)
    words = [" word", " Übergrößenträger", " x", " ÿþý", " zzqxv", " naïveté", " ªº", " 日本", " ß"]
    texts = ["".join(words), *words, *ODD]
    wanted = [np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u2").tobytes() for t in texts]
    encoder = token_files.Encoder(PATH)
    encoder.plain = False
    assert encoder.encode(texts, 0) == wanted
    joined = []
    monkeypatch.setattr(token_files.Encoder, "_joined", lambda self, some: joined.extend(some) or self._library(some))
    encoder = token_files.Encoder(PATH)
    assert encoder.plain and encoder.encode(texts, 0) == wanted
    assert joined and all(max(w) > "\xff" for w in joined)
    assert encoder._model(words) == encoder._library(words)


def test_other_tokenizers_do_not_bypass_their_steps(tmp_path):
    from tokenizers import normalizers
    library = Tokenizer.from_file(PATH)
    library.normalizer = normalizers.Lowercase()
    library.save(str(tmp_path / "lower.json"))
    encoder = token_files.Encoder(str(tmp_path / "lower.json"))
    assert not encoder.plain
    ids = library.encode(" Some WORDS here", add_special_tokens=False).ids + [0]
    assert encoder.encode([" Some WORDS here"], 0) == [np.array(ids, "<u2").tobytes()]
