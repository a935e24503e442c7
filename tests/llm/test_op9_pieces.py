import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tallyloom.llm import op9_pieces as op
from tests.llm.tables import awkward_documents, empty_documents, write

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(library, text):
    ids = library.encode(text or "")
    return len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))


def test_random_texts(library):
    rng, table = random.Random(11), op.PrefixTable(public_tokenizers.path(MODEL))
    pieces = [library.id_to_piece(i).replace(op.MARK, " ") for i in range(259, 32000)]
    signs = list("ab  \n\t▁漢😀é\x00.,1") + ["  ", "    ", "<s>", "</s>", "<unk>", "<0x41>", "ing", "th"]
    for i in range(6000):
        text = "".join(rng.choices(signs if i % 2 else pieces, k=rng.randint(0, 24)))
        if i % 3 == 0:
            text = text.replace(" ", "")
        ids = np.frombuffer(table.encode(text), "<i4")
        assert ids.tolist() == library.encode(text), text
        assert table.decode(ids) == library.decode(ids.tolist()), text


def test_broken_bytes_decode_as_in_the_library(library):
    rng, table = random.Random(12), op.PrefixTable(public_tokenizers.path(MODEL))
    for _ in range(1000):
        ids = [rng.choice([rng.randint(3, 258), rng.randint(131, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(1, 8))]
        assert table.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_documents(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op.query(spark, sf_dir).collect()}
    assert got == {k: want(library, t) for k, t in texts.items()}


def test_awkward_and_empty(spark, tmp_path, library):
    docs = awkward_documents(spark)
    got = sorted(map(str, op.query(spark, write(docs, tmp_path)).collect()))
    rows = [(r.doc_id, *want(library, r.text)) for r in docs.collect()]
    assert len(got) == len(rows)
    coded = op.encode(docs, MODEL)
    back = op.decode(coded, MODEL).where("doc_id = 9").first().decoded
    assert back == library.decode(library.encode(docs.where("doc_id = 9").first().text))
    assert {(r.doc_id, len(r.ids)) for r in coded.collect()} == {(i, n) for i, n, _, _ in rows}
    assert op.encode(empty_documents(spark), MODEL, decode_too=True).count() == 0
